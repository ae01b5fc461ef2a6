"""Mixing sources to target weights by a low-discrepancy schedule.

Slots of equally many words are dealt to sources: slot i takes the point
``frac(i * golden ratio)`` and falls to the source in whose share of the cumulative
targets it lies, so every stretch of the schedule holds each source close to its share.
A source's n-th slot takes the n-th block of its shuffled words, starting anew after the
last block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanloom.llm.common import checkpointed, running_start, word_count

WEIGHTS = (5, 2, 1)
#: The golden ratio's fraction in units of 2**-32; odd, so all 2**32 points differ.
GOLDEN = 2654435769
POINTS = 1 << 32


def source_targets(
    sizes: DataFrame, share: float = 1.5, weights: tuple[int, ...] = WEIGHTS, most: float = 2.0
) -> DataFrame:
    """Per source its words, weight and target.

    ``sizes`` has one row per source (``source``, ``words``). Sources take the weights
    in turn by code point, null last. All targets together are ``share`` of all words;
    none exceeds ``most`` times its source, and what is cut off goes to the others by
    weight, until none is above. That end point is found at once: ordered by how soon
    they fill up, full sources stand first, and the level of the rest follows from
    what these leave over.
    """
    by_name = Window.orderBy(
        F.col("source").isNull(), F.col("source").cast("binary")
    )
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int"))
    listed = sizes.select(
        "source",
        "words",
        weight.alias("weight"),
        (F.col("words") * F.lit(float(most))).alias("limit"),
    )
    every = Window.partitionBy(F.lit(1))
    filling = Window.partitionBy(F.lit(1)).orderBy(
        F.col("limit") / F.col("weight"), F.col("source").isNull(), "source"
    )
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    on = filling.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("words").over(every) * F.lit(float(share)) - F.coalesce(
        F.sum("limit").over(before), F.lit(0.0)
    )
    levels = listed.select("*", (left / F.sum("weight").over(on)).alias("level"))
    # The level of the first source that does not fill up holds for all after it.
    open_level = F.max(
        F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))
    ).over(every)
    return levels.select("*", open_level.alias("open")).select(
        "source",
        "words",
        "weight",
        F.coalesce(
            F.least(F.col("limit"), F.col("open") * F.col("weight")), F.col("limit")
        ).alias("target"),
    )


def _never_null(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("")).otherwise(F.concat(F.lit("="), source))


def schedule(targets: DataFrame, block_words: int, chunk_slots: int = 1 << 14) -> DataFrame:
    """The mix in order: ``slot``, ``source`` and ``nth``, the slot's rank in its source.

    There are as many points as the targets fill blocks. A source keeps the slots that
    its target fills; where its points are a few short of that, the missing slots
    follow at the end. A source with most of the slots is ranked in chunks.
    """
    shares = targets.filter("target > 0")
    along = Window.partitionBy(F.lit(1)).orderBy(F.col("source").isNull(), "source")
    every = Window.partitionBy(F.lit(1))
    through = F.sum("target").over(along)
    bounds = shares.select(
        "source",
        (F.round((through - F.col("target")) / F.sum("target").over(every) * POINTS))
        .cast("long")
        .alias("low"),
        (F.round(through / F.sum("target").over(every) * POINTS)).cast("long").alias("high"),
        (F.lit(1)).alias("one"),
    )
    total = shares.agg(F.sum("target")).first()[0] or 0.0
    slots = int(-(-total // block_words))
    spark = targets.sparkSession
    # Points meet their source by an equality join on the leading bits of the point:
    # a source covers a run of cells, and only cells on a border hold several.
    cell_bits = 20
    high, low = "(id div 65536L) % 65536L", "id % 65536L"
    points = spark.range(slots).select(
        F.col("id").alias("slot"),
        F.expr(
            f"(({high}) * {GOLDEN}L % {POINTS}L * 65536L + ({low}) * {GOLDEN}L) % {POINTS}L"
        ).alias("point"),
    )
    covered = bounds.filter("high > low").withColumn(
        "cell",
        F.explode(
            F.sequence(F.shiftright("low", cell_bits), F.shiftright(F.col("high") - 1, cell_bits))
        ),
    )
    dealt = (
        points.withColumn("cell", F.shiftright("point", cell_bits))
        .join(covered, "cell")
        .filter("point >= low and point < high")
        .select(
            "slot",
            "source",
            "one",
            _never_null(F.col("source")).alias("of"),
            F.expr(f"slot div {chunk_slots}").alias("chunk"),
        )
    )
    ranked = checkpointed(
        running_start(dealt, ["of"], "chunk", ["slot"], "one", "nth").select(
            "slot", "source", "nth"
        )
    )
    needed = shares.select(
        F.col("source").alias("_source"),
        F.expr(f"(cast(floor(target) as bigint) + {block_words - 1}) div {block_words}").alias(
            "needed"
        ),
    )
    same = F.col("source").eqNullSafe(F.col("_source"))
    kept = ranked.join(needed, same).filter("nth < needed").select("slot", "source", "nth")
    held = ranked.groupBy("source").agg(F.count("slot").alias("held"))
    short = (
        needed.join(held, same, "left")
        .withColumn("held", F.coalesce("held", F.lit(0).cast("long")))
        .filter("held < needed")
    )
    closing = short.select(
        F.lit(slots).cast("long").alias("slot"),
        F.col("_source").alias("source"),
        F.explode(F.sequence(F.col("held"), F.col("needed") - 1)).alias("nth"),
    )
    return kept.unionByName(closing)


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    share: float = 1.5,
    weights: tuple[int, ...] = WEIGHTS,
    most: float = 2.0,
    block_words: int = 256,
    buckets: int = 1024,
) -> tuple[DataFrame, DataFrame]:
    """Per row what the mix takes of it; and the mix's pieces in order.

    The first table has ``doc_id, size, source_size, target, taken`` and ``copy``, the
    second ``slot, doc_id, source, copy, first_word, words``, in the order of ``slot``
    and ``source`` (slots at the end may share a number). Sizes are words; null
    texts have none and are never taken. Null is a source of its own. Rows alike in id,
    source and text are told apart by ``copy``, counted from 0, and each counts in full.
    No row gives more than ``most`` times its words. A source is shuffled by a hash of
    id and text, so reruns agree; one with most of the rows is laid out in ``buckets``
    pieces. An empty table gives empty results. Other columns are not looked at.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = (
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.col(f"`{source_col}`").cast("string").alias("source"),
            word_count(text).alias("size"),
            F.xxhash64(F.col(f"`{id_col}`").cast("long"), text).alias("place"),
        )
        .groupBy("doc_id", "source", "size", "place")
        .count()
        .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("count") - 1)))
        .drop("count")
    )
    rows = checkpointed(rows)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("words"))
    targets = checkpointed(source_targets(sizes, share, weights, most))
    slots = schedule(targets, block_words)

    # Each row's words lie at [start, start + size) of its source's shuffled words,
    # and a whole round further on for each time the source begins anew.
    laid = running_start(
        rows.filter("size > 0")
        .withColumn("of", _never_null(F.col("source")))
        .withColumn("bucket", F.pmod("place", F.lit(buckets))),
        ["of"],
        "bucket",
        ["place", "doc_id", "size", "copy"],
        "size",
        "start",
    )
    wanted = targets.select(
        F.col("source").alias("_source"), "words", F.floor("target").cast("long").alias("wanted")
    )
    of_source = F.col("source").eqNullSafe(F.col("_source"))
    rounds = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(int(-(-most // 1)) - 1)))
    turns = (
        laid.join(wanted, of_source)
        .withColumn("round", rounds)
        .withColumn("from", F.expr("round * words + start"))
        .withColumn("to", F.expr("least(round * words + start + size, wanted)"))
        .filter(F.col("from") < F.col("to"))
    )
    pieces = turns.withColumn(
        "block",
        F.explode(F.expr(f"sequence(from div {block_words}, (to - 1) div {block_words})")),
    ).drop("_source")
    slots = slots.select("slot", F.col("source").alias("_source"), "nth")
    begin = f"greatest(from, block * {block_words})"
    mixed = pieces.join(slots, of_source & (F.col("block") == F.col("nth"))).select(
        "slot",
        "doc_id",
        "source",
        "copy",
        "size",
        "place",
        "block",
        F.expr(f"{begin} - from").alias("first_word"),
        F.expr(f"least(to, (block + 1) * {block_words}) - {begin}").alias("words"),
    )
    key = ["doc_id", "source", "size", "place", "copy"]
    taken = mixed.groupBy(*key).agg(F.sum("words").alias("taken"))
    taken = taken.select(*[F.col(k).alias(f"_{k}") for k in key], "taken")
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    by_source = targets.select(
        F.col("source").alias("_of"), F.col("words").alias("source_size"), "target"
    )
    report = (
        rows.join(by_source, F.col("source").eqNullSafe(F.col("_of")))
        .join(taken, same, "left")
        .select(
            "doc_id",
            "source",
            "place",
            "copy",
            "size",
            "source_size",
            "target",
            F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
        )
    )
    return report, mixed.drop("size", "place", "block")


def resampled(docs: DataFrame, report: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows as often as the mix takes them, to the nearest whole time.

    Rows alike in id, source and text take the report's copies in any order. Texts
    without words, null ones too, have no size and go; null ids and null sources are
    values like any other. All columns come back as they are; no rows give none.
    """
    key = ["_id", "_source", "_place"]
    times = report.filter("size > 0").select(
        F.col("doc_id").alias("_of_id"),
        F.col("source").alias("_of_source"),
        F.col("place").alias("_of_place"),
        F.struct("copy", F.round(F.col("taken") / F.col("size")).cast("int").alias("times")).alias("each"),
    )
    times = times.groupBy("_of_id", "_of_source", "_of_place").agg(
        F.array_sort(F.collect_list("each")).alias("_each")
    )
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
        F.col(f"`{id_col}`").cast("long").alias("_id"),
        F.col(f"`{source_col}`").cast("string").alias("_source"),
        F.xxhash64(F.col(f"`{id_col}`").cast("long"), text).alias("_place"),
    )
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"_of{k}"))
    alike = Window.partitionBy(*key).orderBy(F.lit(1))
    taken = rows.withColumn("_nth", F.row_number().over(alike)).join(times, same)
    often = F.element_at(F.col("_each"), F.col("_nth"))["times"]
    return (
        taken.select("_row", F.explode(F.array_repeat(F.lit(1), often)))
        .select("_row.*")
    )
