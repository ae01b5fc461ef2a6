"""Sharding along a Hilbert curve over several metadata dimensions.

Each dimension is quantised to a few bits; the cell's index on the Hilbert curve orders
the rows, and runs of that order become shards. Rows that are near in all dimensions
share a shard, so the minimum and maximum of each dimension prune files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanloom.llm.common import checkpointed, running_start

LAW = "rows"


# -- quantisers ------------------------------------------------------------------


def by_value(column: Column, bits: int) -> Column:
    """A category's bucket; null is bucket 0."""
    return F.when(column.isNull(), 0).otherwise(
        F.pmod(F.xxhash64(column.cast("string")), F.lit(1 << bits)).cast("int")
    )


def by_logarithm(column: Column, bits: int, largest: int = 1 << 40) -> Column:
    """Equal steps of the logarithm from 1 to ``largest``; null and below are 0."""
    cells = 1 << bits
    step = F.log2(F.greatest(column.cast("double"), F.lit(1.0))) * (
        cells / (largest.bit_length() - 1)
    )
    return F.coalesce(F.least(F.floor(step).cast("int"), F.lit(cells - 1)), F.lit(0))


def by_range(column: Column, low: int | None, high: int | None, bits: int) -> Column:
    """Equal steps between the two values; null is 0."""
    if low is None or high is None or low == high:
        return F.lit(0)
    cells = 1 << bits
    share = (column.cast("double") - float(low)) / (float(high) - float(low))
    inside = F.greatest(F.lit(0), F.least(F.floor(share * cells).cast("int"), F.lit(cells - 1)))
    return F.coalesce(inside, F.lit(0))


# -- the curve -------------------------------------------------------------------


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Position on the Hilbert curve of a cell given by its coordinates.

    The coordinates are turned into the transposed index by undoing the curve's
    reflections and exchanges from the highest bit down; a Gray code and interleaving
    finish it. Any number of dimensions with ``bits`` each, up to 62 bits in all.
    """
    n = len(cells)
    if not 2 <= n * bits <= 62 or n < 2:
        raise ValueError("two or more dimensions and at most 62 bits in all")
    dims = F.sequence(F.lit(0), F.lit(n - 1))

    def put(x: Column, at: Column, value: Column) -> Column:
        return F.transform(x, lambda v, i: F.when(i == at, value).otherwise(v))

    def undo(x: Column, q: Column, i: Column) -> Column:
        below = q - 1
        exchanged = x[0].bitwiseXOR(x[i]).bitwiseAND(below)
        return F.when(
            x[i].bitwiseAND(q) != 0, put(x, F.lit(0), x[0].bitwiseXOR(below))
        ).otherwise(
            F.transform(
                x,
                lambda v, k: F.when(
                    (k == 0) | (k == i), v.bitwiseXOR(exchanged)
                ).otherwise(v),
            )
        )

    bit_values = F.array(*[F.lit(1 << b) for b in range(bits - 1, -1, -1)])
    start = F.array(*[c.cast("int") for c in cells])
    # Undo the excess work of the curve, highest bit first (bit 0 needs none).
    turned = F.aggregate(
        F.filter(bit_values, lambda q: q > 1),
        start,
        lambda x, q: F.aggregate(dims, x, lambda y, i: undo(y, q, i)),
    )
    # Gray code: each coordinate takes in the one before it.
    gray = F.aggregate(
        F.sequence(F.lit(1), F.lit(n - 1)),
        turned,
        lambda x, i: put(x, i, x[i].bitwiseXOR(x[i - 1])),
    )
    last = F.aggregate(
        F.filter(bit_values, lambda q: q > 1),
        F.struct(F.lit(0).alias("t"), gray.alias("x")),
        lambda s, q: F.struct(
            F.when(s["x"][n - 1].bitwiseAND(q) != 0, s["t"].bitwiseXOR(q - 1))
            .otherwise(s["t"])
            .alias("t"),
            s["x"].alias("x"),
        ),
        lambda s: F.transform(s["x"], lambda v: v.bitwiseXOR(s["t"])),
    )
    # Interleave: bit b of every coordinate in turn, highest bit first.
    return F.aggregate(
        bit_values,
        F.struct(F.lit(0).cast("long").alias("h"), last.alias("x")),
        lambda s, q: F.struct(
            F.aggregate(
                s["x"],
                s["h"],
                lambda h, v: F.shiftleft(h, 1)
                + F.when(v.bitwiseAND(q) != 0, F.lit(1).cast("long")).otherwise(
                    F.lit(0).cast("long")
                ),
            ).alias("h"),
            s["x"].alias("x"),
        ),
        lambda s: s["h"],
    )


# -- shards ----------------------------------------------------------------------


def hilbert_shards(
    rows: DataFrame,
    dimensions: list[Column],
    order: list[str],
    shards: int = 40,
    bits: int = 4,
    buckets: int = 1024,
) -> DataFrame:
    """Adds ``curve``, ``shard`` and ``slot``; shards differ by one row at most.

    ``dimensions`` are quantised columns below ``2**bits``. Rows of one cell are
    ordered by a hash of the columns in ``order`` and then by those columns, so reruns
    agree. A cell that holds most rows is counted and numbered in ``buckets`` pieces.
    The curve is worked out once per occupied cell, of which there are at most
    ``2**(bits * dimensions)``.

    Rows alike in all of ``order`` are interchangeable and take neighbouring slots in
    any order. Nulls in ``order`` come first. An empty table gives no rows. Columns
    named ``curve``, ``shard`` or ``slot`` are replaced, all others are kept.
    """
    kept = [F.col(f"`{c}`") for c in rows.columns if c not in ("curve", "shard", "slot")]
    keys = [F.col(f"`{c}`") for c in order]
    cell = F.lit(0).cast("long")
    for q in dimensions:
        cell = F.shiftleft(cell, bits).bitwiseOR(q.cast("long"))
    # The row travels as one value, so its column names clash with none used here.
    placed = rows.select(
        F.struct(*kept).alias("row"),
        *[k.alias(f"key{i}") for i, k in enumerate(keys)],
        cell.alias("cell"),
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket"),
        F.lit(1).cast("long").alias("one"),
    )
    n, mask = len(dimensions), (1 << bits) - 1
    coordinates = [
        F.shiftright(F.col("cell"), bits * (n - 1 - i)).bitwiseAND(F.lit(mask))
        for i in range(n)
    ]
    # Bounded by the number of cells, whatever the number of rows.
    cells = checkpointed(
        placed.groupBy("cell")
        .agg(F.count("one").alias("held"))
        .withColumn("curve", hilbert_index(coordinates, bits))
    )
    total = cells.agg(F.coalesce(F.sum("held"), F.lit(0))).first()[0]
    starts = cells.select(
        F.col("cell").alias("of_cell"),
        "curve",
        (F.sum("held").over(Window.orderBy("curve")) - F.col("held")).alias("before"),
    )
    ranked = running_start(
        placed, ["cell"], "bucket", [f"key{i}" for i in range(len(keys))], "one", "rank"
    )
    position = F.col("before") + F.col("rank")
    placed = ranked.join(F.broadcast(starts), F.col("cell") == F.col("of_cell")).select(
        "row",
        "curve",
        position.alias("position"),
        F.expr(f"cast((before + rank) * {shards} div {max(total, 1)} as int)").alias("shard"),
    )
    first = F.expr(f"(shard * {total}L + {shards - 1}) div {shards}")
    return placed.select(
        "row.*", "curve", "shard", (F.col("position") - first).alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """Parquet files by shard, rows in slot order, for pruning by any dimension.

    What stood at the path is replaced; rows alike keep a slot each, other columns come
    along as they are, and a table without rows writes no file.
    """
    dealt = sharded.repartition("shard").sortWithinPartitions("shard", "slot")
    dealt.write.mode("overwrite").partitionBy("shard").parquet(path)
