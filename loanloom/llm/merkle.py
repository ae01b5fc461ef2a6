"""Merkle manifest of a dataset: a stored DAG of digests, read from the root down.

Rows are leaves. Within a group every ``arity`` consecutive nodes are hashed into one
until one is left; the groups' roots are the leaves of one more such tree. The inner
nodes are stored as records from a digest to its children, bundled by ``levels`` tree
levels under the digest of their topmost node, so that a descent of a tree with 2**36
leaves takes six joins instead of thirty-six.

A proof is found by content alone: a request starts with the root's digest, looks up the
children, takes the one that its rank's next digit names and keeps the others, down to
its leaf. Reversed, what it kept leads from the leaf to the root. Requests are distinct
prefixes of ranks on each level, so the root is asked once and not once a leaf, and no
group's size matters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanloom.llm.common import checkpointed

ARITY = 2
#: Tree levels in one record; arity ** levels children hang below it.
LEVELS = 6
#: Rows alike are counted and dealt out again in runs of so many.
RUN = 1024
#: Rows of a batch that are Python objects at one time.
AT_ONCE = 128

_NODES = "nodes array<struct<digest: binary, children: array<binary>>>"
_PATH = "path array<struct<at: int, others: array<binary>>>"
_NODE_TYPE = pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))])
_STEP_TYPE = pa.struct([("at", pa.int32()), ("others", pa.list_(pa.binary()))])

#: A step of a path: place of the own node among its run, and the run's others.
Step = tuple[int, list[bytes]]


# -- digests -------------------------------------------------------------------------


def field(value: Column) -> Column:
    """A value as it enters a digest: ``-`` if null, else bytes in UTF-8, ``:``, value."""
    text = value.cast("string")
    sized = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
    return F.coalesce(sized, F.lit("-"))


def leaf_digest(values: Sequence[Column]) -> Column:
    """SHA-256 of the values, one after the other, as bytes."""
    return F.unhex(F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256))


def node_digest(children: Sequence[bytes]) -> bytes:
    """SHA-256 of the children's digests as hexadecimal text."""
    return sha256("".join([c.hex() for c in children]).encode()).digest()


def subtree(
    children: list[bytes], arity: int, levels: int, whole: bool
) -> tuple[bytes, list[tuple[bytes, list[bytes]]]]:
    """Topmost digest over some children, and all inner nodes with their children.

    A piece of a larger tree goes up all levels; a ``whole`` tree stops at one node.
    """
    nodes = []
    for _ in range(levels):
        if whole and len(children) == 1:
            break
        runs = [children[i : i + arity] for i in range(0, len(children), arity)]
        children = [node_digest(run) for run in runs]
        nodes += zip(children, runs)
    return children[0], nodes


def height(total: int, arity: int) -> int:
    """Levels above so many nodes."""
    levels = 0
    while total > 1:
        total, levels = -(-total // arity), levels + 1
    return levels


def walk(
    store: dict[bytes, list[bytes]], digest: bytes, digit: int, arity: int, levels: int
) -> tuple[bytes, list[Step]]:
    """Down from a digest by the digits of a rank; what was not chosen, from the top."""
    steps: list[Step] = []
    for level in reversed(range(levels)):
        children = store[digest]
        at = digit // arity**level % arity
        steps.append((at, children[:at] + children[at + 1 :]))
        digest = children[at]
    return digest, steps


def fold(leaf: bytes, path: Sequence[Step]) -> bytes:
    """The root that a leaf and the path below it (from the leaf up) lead to."""
    for at, others in path:
        leaf = node_digest([*others[:at], leaf, *others[at:]])
    return leaf


# -- places ----------------------------------------------------------------------------


def placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Adds ``place``, the rank from 0 in ``key`` by ``order``, and the key's ``total``.

    Rows are dealt into ranges of the order, so a key with most rows has many of them;
    no window holds more than a range. Rows alike in all columns take places in turn.
    Nulls come first. ``key`` is null nowhere.
    """
    alike = rows.groupBy(*rows.columns).agg(F.count("*").alias("_count"))
    runs = alike.select(
        *rows.columns,
        F.col("_count"),
        F.explode(F.expr(f"sequence(0L, (_count - 1) div {RUN})")).alias("_run"),
    ).withColumn("_copies", F.least(F.lit(RUN), F.col("_count") - F.col("_run") * RUN))
    by = [F.col(c).asc_nulls_first() for c in [*order, "_run"]]
    dealt = runs.repartitionByRange(F.col("key"), *by)
    ranged = checkpointed(dealt.withColumn("_piece", F.spark_partition_id()).drop("_count"))
    before = Window.partitionBy("key").orderBy("_piece")
    totals = (
        ranged.groupBy("key", "_piece")
        .agg(F.sum("_copies").alias("_sum"))
        .select(
            F.col("key").alias("_key"),
            F.col("_piece").alias("_of"),
            (F.sum("_sum").over(before) - F.col("_sum")).alias("_start"),
            F.sum("_sum").over(Window.partitionBy("key")).alias("total"),
        )
    )
    same = (F.col("key") == F.col("_key")) & (F.col("_piece") == F.col("_of"))
    upto = Window.partitionBy("key", "_piece").orderBy(*by)
    inside = F.sum("_copies").over(upto.rowsBetween(Window.unboundedPreceding, 0))
    first = F.col("_start") + F.col("_inside") - F.col("_copies")
    return (
        ranged.withColumn("_inside", inside)
        .join(totals, same)
        .select(
            *rows.columns,
            "total",
            F.explode(F.sequence(first, first + F.col("_copies") - 1)).alias("place"),
        )
    )


# -- building ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Forest:
    """The trees of all keys: their stored records by level, and their roots."""

    records: list[DataFrame]
    roots: DataFrame
    arity: int
    levels: int

    @property
    def width(self) -> int:
        return self.arity**self.levels


def _build(arity: int, levels: int, level: int) -> Callable:
    whole = arity ** (levels * (level + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for key, total, place, children in _rows(batches):
            digests = [c["digest"] for c in children]
            yield key, total, place, *subtree(digests, arity, levels, total <= whole)

    types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(_NODE_TYPE)]
    return _in_batches(run, types, "key total place digest nodes".split())


def build(leaves: DataFrame, path: str, arity: int = ARITY, levels: int = LEVELS) -> Forest:
    """Stores the trees over ``leaves`` (key, total, place, digest) under ``path``.

    One folder of records per ``levels`` tree levels: ``key``, ``total`` leaves of the
    key's tree, ``place`` of the record on its level, ``digest`` of its topmost node and
    ``nodes``. A lone leaf is its tree's root; its record holds no nodes. ``roots`` has
    ``key``, ``total`` and ``digest``.
    """
    spark, width = leaves.sparkSession, arity**levels
    schema = f"key string, total long, place long, digest binary, {_NODES}"
    most = leaves.agg(F.max("total")).first()[0] or 0
    records, roots, nodes = [], None, leaves.select("key", "total", "place", "digest")
    while roots is None or width ** len(records) < most:
        bundles = nodes.groupBy(
            "key", "total", F.expr(f"place div {width}").alias("bundle")
        ).agg(F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("children"))
        folder = f"{path}/records-{len(records)}"
        bundles.mapInArrow(_build(arity, levels, len(records)), schema).write.parquet(folder)
        stored = spark.read.schema(schema).parquet(folder)
        records.append(stored)
        whole = F.col("total") <= width ** len(records)
        tops = stored.where(whole).select("key", "total", "digest")
        roots = tops if roots is None else roots.unionByName(tops)
        nodes = stored.where(~whole).select("key", "total", "place", "digest")
    return Forest(records, roots, arity, levels)


# -- descent ---------------------------------------------------------------------------


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for begin in range(0, batch.num_rows, AT_ONCE):
            part = batch.slice(begin, AT_ONCE)
            yield from zip(*[c.to_pylist() for c in part.columns])


def _in_batches(run: Callable, types: list[pa.DataType], names: list[str]) -> Callable:
    """Arrow batches of the rows that ``run`` yields."""

    def batched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        rows = []
        for row in run(batches):
            rows.append(row)
            if len(rows) == 8 * AT_ONCE:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    return batched


def _steps(path: list[dict]) -> list[Step]:
    return [(step["at"], step["others"]) for step in path]


def _down(total: int, arity: int, levels: int, level: int) -> int:
    """Tree levels in a record of this level."""
    nodes = -(-total // arity ** (levels * level))
    return min(height(nodes, arity), levels)


def _next(arity: int, levels: int, level: int) -> Callable:
    """From the asked children of a record to their digests and longer paths."""
    width = arity**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for key, total, place, digest, path, tree, top, wanted, nodes in _rows(batches):
            store = {n["digest"]: n["children"] for n in nodes}
            down = _down(total, arity, levels, level)
            so_far = _steps(path)
            for digit in wanted:
                child, steps = walk(store, digest, digit, arity, down)
                yield key, total, place * width + digit, child, so_far + steps, tree, top

    types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(_STEP_TYPE)]
    types += [pa.binary(), pa.binary()]
    return _in_batches(run, types, "key total place digest path tree top".split())


def _proofs(arity: int, levels: int, level: int) -> Callable:
    """From the asked leaves of a record to their proofs, folded again."""
    width = arity**levels

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for key, total, place, digest, path, tree, top, wanted, nodes in _rows(batches):
            store = {n["digest"]: n["children"] for n in nodes}
            down = _down(total, arity, levels, level)
            so_far = _steps(path)
            for leaf in wanted:
                found, steps = walk(store, digest, leaf["digit"], arity, down)
                if found != leaf["digest"]:
                    raise ValueError(f"no leaf {leaf['digest'].hex()} at its place in {tree.hex()}")
                upward = (so_far + steps)[::-1]
                others = [other for _, kept in upward for other in kept]
                folded = fold(leaf["shown"], upward)
                at = place * width + leaf["digit"]
                yield key, at, leaf["id"], found, tree, top, others, node_digest(others), folded

    types = [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    types += [pa.list_(pa.binary()), pa.binary(), pa.binary()]
    return _in_batches(run, types, "key place id leaf tree top others proof folded".split())


_ASKED = f"key string, total long, place long, digest binary, {_PATH}, tree binary, top binary"
_PROVED = (
    "key string, place long, id long, leaf binary, tree binary, top binary, "
    "others array<binary>, proof binary, folded binary"
)


def _below(requests: DataFrame, width: int, wanted: Column) -> DataFrame:
    """What is wanted below each record; at most ``width`` children each."""
    return requests.groupBy(
        F.col("key").alias("_key"), F.expr(f"place div {width}").alias("_bundle")
    ).agg(wanted.alias("wanted"))


def descend(forest: Forest, entry: DataFrame, requests: DataFrame, prove: bool) -> DataFrame:
    """The requested leaves with their paths or, with ``prove``, their proofs.

    ``entry`` has ``key``, ``total`` and ``digest`` of the tree's root, the ``path`` above
    it and the ``top`` where that begins. ``requests`` has ``key`` and ``place``, each once, and for
    proofs ``digest``, ``id`` and ``shown``, the leaf presented in the original's place.
    """
    width, spark = forest.width, entry.sparkSession
    digit = (F.col("place") % width).cast("int")
    leaf = F.struct(digit.alias("digit"), "digest", "id", "shown") if prove else digit
    wanted = [_below(requests, width, F.collect_list(leaf))]
    for _ in forest.records[1:]:
        above = wanted[-1].select(F.col("_key").alias("key"), F.col("_bundle").alias("place"))
        wanted.append(_below(above, width, F.collect_list(digit)))
    asked = spark.createDataFrame([], _ASKED)
    for level in reversed(range(len(forest.records))):
        # Trees whose topmost record is on this level are entered here.
        topmost = F.col("total") <= width ** (level + 1)
        if level:
            topmost &= F.col("total") > width**level
        entered = entry.where(topmost).select(
            "key",
            "total",
            F.lit(0).cast("long").alias("place"),
            "digest",
            "path",
            F.col("digest").alias("tree"),
            "top",
        )
        below = (F.col("key") == F.col("_key")) & (F.col("place") == F.col("_bundle"))
        # One record per digest: rows alike may make several records alike.
        store = (
            forest.records[level]
            .groupBy(F.col("digest").alias("_digest"))
            .agg(F.first("nodes").alias("nodes"))
        )
        joined = (
            asked.unionByName(entered)
            .join(wanted[level], below)
            .join(store, F.col("digest") == F.col("_digest"))
            .select("key", "total", "place", "digest", "path", "tree", "top", "wanted", "nodes")
        )
        if level or not prove:
            found = joined.mapInArrow(_next(forest.arity, forest.levels, level), _ASKED)
            asked = checkpointed(found) if level else found
        else:
            asked = joined.mapInArrow(_proofs(forest.arity, forest.levels, level), _PROVED)
    return asked


def manifest_proofs(
    docs: DataFrame,
    path: str,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    shown: dict[str, Column] | None = None,
    group: str = "lang",
    order: str = "doc_id",
    arity: int = ARITY,
    levels: int = LEVELS,
) -> DataFrame:
    """Stores the manifest of all rows under ``path`` and proves every row against it.

    A leaf is the digest of the ``fields``; leaves of one ``group`` value ascend by
    ``order``, ties by digest. ``shown`` replaces fields in the row that is presented
    for verification; without it the rows themselves are. Returns ``place`` in the
    group, ``doc_id`` (the order column), and as lower-case hexadecimal text ``leaf``,
    ``subroot``, ``root``, ``others`` (siblings from the leaf up), ``proof_sha256`` over
    them and ``folded_root``; ``verified`` says whether that is the root.

    Null and empty values are different leaves; null groups and order values are the
    first. Rows alike each have a place of their own, columns other than those named
    are not looked at, and a table without rows gives none.
    """
    spark: SparkSession = docs.sparkSession
    original = [F.col(f"`{c}`") for c in fields]
    presented = [(shown or {}).get(c, F.col(f"`{c}`")) for c in fields]
    grouped = F.col(f"`{group}`").cast("string")
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), grouped), F.lit("")).alias("key"),
        F.col(f"`{order}`").cast("long").alias("id"),
        leaf_digest(original).alias("digest"),
        (leaf_digest(presented) if shown else leaf_digest(original)).alias("shown"),
    )
    leaves = checkpointed(placed(rows, ["id", "digest", "shown"]))
    forest = build(leaves, f"{path}/groups", arity, levels)
    tops = forest.roots.select(
        F.lit("").alias("key"), F.col("key").alias("group"), F.col("total").alias("size"), "digest"
    )
    ranked = checkpointed(placed(tops, ["group"]))
    top = build(ranked, f"{path}/roots", arity, levels)
    # The tree over the groups is descended like any other; its leaves are the entries.
    nothing = F.expr("array()").cast(_PATH.removeprefix("path "))
    root = top.roots.select(
        "key", "total", "digest", nothing.alias("path"), F.col("digest").alias("top")
    )
    above = descend(top, root, ranked, prove=False).select("place", "digest", "path", "top")
    names = ranked.select(
        F.col("place").alias("_place"), F.col("group").alias("key"), F.col("size").alias("total")
    )
    entry = checkpointed(above.join(names, F.col("place") == F.col("_place")).drop("place", "_place"))
    found = descend(forest, entry, leaves, prove=True)

    def text(name: str) -> Column:
        return F.lower(F.hex(name))

    return found.select(
        "place",
        F.col("id").alias("doc_id"),
        text("leaf").alias("leaf"),
        text("tree").alias("subroot"),
        text("top").alias("root"),
        F.transform("others", lambda o: F.lower(F.hex(o))).alias("others"),
        text("proof").alias("proof_sha256"),
        text("folded").alias("folded_root"),
        (F.col("folded") == F.col("top")).alias("verified"),
    )
