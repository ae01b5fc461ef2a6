"""SimHash fingerprints and their links within a Hamming radius.

Fingerprints that may be near share a bucket of some table; each bucket is compared by
bit planes. Plane b holds bit b of all lanes (fingerprints in bucket order), so one
exclusive-or of a plane with itself, shifted by d lanes, gives bit b's difference for
every pair at distance d. Carry-save adders count these differences in vertical
counters for 64 pairs at a time, and blocks of 64 lanes are dropped once all of them
exceed the radius.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import WORD, checkpointed

SEED = 42
#: Buckets above this many lanes are compared in pairs of chunks.
CHUNK = 1 << 14
#: One in so many keys is counted to find such buckets.
SAMPLED = 64
#: At most so many rows are broadcast; more are joined.
MOST_BROADCAST = 100_000


# -- fingerprints ----------------------------------------------------------------


def shingles_of(words: list[str], shingle: int) -> list[str]:
    """Runs of ``shingle`` words; fewer words make one."""
    return [
        " ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))
    ]


def fingerprint(words: list[str], shingle: int, parts: int) -> bytes:
    """``parts`` 64-bit words: part p hashes shingles with seed 42 + p.

    A bit is 1 if it is set in over half of the shingles' hashes; without words all
    bits are 0, and fewer words than a shingle make one shingle.
    """
    if not words:
        return bytes(8 * parts)
    shingles = shingles_of(words, shingle)
    out = b""
    for part in range(parts):
        seed = SEED + part
        counts = np.zeros(64, np.int64)
        for at in range(0, len(shingles), 8192):
            hashes = np.array(
                [xxhash.xxh64_intdigest(s, seed) for s in shingles[at : at + 8192]], "<u8"
            )
            bits = np.unpackbits(hashes.view(np.uint8), bitorder="little")
            counts += bits.reshape(-1, 64).sum(axis=0, dtype=np.int32)
        ones = (2 * counts > len(shingles)).astype(np.uint8)
        out += np.packbits(ones, bitorder="little").tobytes()
    return out


def fingerprints(text: Column, shingle: int, parts: int = 1) -> Column:
    """Fingerprint of each text as little-endian bytes; null texts have no words.

    Only A-Z are lower-cased. A very long text is hashed in pieces, so memory follows
    the text itself.
    """

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        word = re.compile(WORD)
        lower = {c: c + 32 for c in range(65, 91)}
        for batch in batches:
            found = []
            for value in batch:
                words = word.findall((value.as_py() or "").translate(lower))
                found.append(fingerprint(words, shingle, parts))
            yield pa.array(found, pa.binary())

    return F.arrow_udf(_typed(run), "binary")(text)


def _typed(run: Callable) -> Callable:
    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return run


# -- buckets ---------------------------------------------------------------------


def block_keys(bits: int, blocks: int, agreeing: int) -> list[list[int]]:
    """Bit positions of each table's key: every choice of ``agreeing`` of the blocks.

    Two fingerprints that differ in at most ``blocks - agreeing`` bits agree fully in
    some choice, so no link is missed up to that radius.
    """
    edges = [round(i * bits / blocks) for i in range(blocks + 1)]
    parts = [list(range(edges[i], edges[i + 1])) for i in range(blocks)]
    return [
        [bit for part in choice for bit in parts[part]]
        for choice in combinations(range(blocks), agreeing)
    ]


def _bucketed(prints: DataFrame, keys: list[list[int]]) -> DataFrame:
    """Rows (key, fp): each fingerprint once per table."""
    parts = [np.array(positions) for positions in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                fps = batch.column(0).slice(at, 4096)
                bits = _bit_matrix(fps.to_pylist())
                for table, positions in enumerate(parts):
                    value = np.zeros(len(fps), np.int64)
                    for p in positions:
                        value = (value << 1) | bits[:, p]
                    key = value | (table << 48)
                    yield pa.RecordBatch.from_arrays([pa.array(key), fps], ["key", "fp"])

    if max(len(p) for p in keys) > 47:
        raise ValueError("a key has at most 47 bits")
    return prints.select("fp").mapInArrow(run, "key long, fp binary")


def _bit_matrix(fps: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(fps), np.uint8).reshape(len(fps), -1)
    return np.unpackbits(raw, axis=1, bitorder="little")


# -- bit-sliced comparison ---------------------------------------------------------


def bit_planes(bits: np.ndarray) -> np.ndarray:
    """(lanes, bits) to (bits, 64-lane words), with one empty word behind."""
    lanes, width = bits.shape
    padded = np.zeros((width, (lanes // 64 + 2) * 64), np.uint8)
    padded[:, :lanes] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


class Counters:
    """Vertical counters: bit k of all lanes' counts is one array."""

    def __init__(self, shape: tuple[int, ...], radius: int):
        self.radius = radius
        self.bits = [np.zeros(shape, np.uint64) for _ in range(radius.bit_length() + 1)]
        #: Lanes whose count left the counters' range.
        self.over = np.zeros(shape, np.uint64)

    def add(self, carry: np.ndarray, at: int) -> None:
        """Adds ``carry`` with weight 2**at to every lane."""
        for k in range(at, len(self.bits)):
            bit = self.bits[k]
            self.bits[k], carry = bit ^ carry, bit & carry
        self.over |= carry

    def add_planes(self, planes: list[np.ndarray]) -> None:
        """Three planes at a time become a sum and a carry before they are counted."""
        level = 0
        while planes:
            carries = []
            while len(planes) >= 3:
                a, b, c = planes.pop(), planes.pop(), planes.pop()
                half = a ^ b
                planes.insert(0, half ^ c)
                carries.append((a & b) | (half & c))
            for plane in planes:
                if level < len(self.bits):
                    self.add(plane, level)
                else:
                    self.over |= plane
            planes, level = carries, level + 1

    def exceed(self) -> np.ndarray:
        """Lanes whose count is above the radius."""
        above = np.zeros_like(self.over)
        equal = ~above
        for k in range(len(self.bits) - 1, -1, -1):
            if (self.radius >> k) & 1:
                equal = equal & self.bits[k]
            else:
                above = above | (equal & self.bits[k])
                equal = equal & ~self.bits[k]
        return above | self.over

    def keep(self, alive: np.ndarray) -> None:
        self.bits = [b[alive] for b in self.bits]
        self.over = self.over[alive]


#: Planes counted between two looks at which blocks are still open.
STEP = 16


def near_at_shift(
    planes: np.ndarray, open_lanes: np.ndarray, shift: int, radius: int
) -> np.ndarray:
    """Lanes i within ``radius`` of lane i + shift; ``open_lanes``: a mask in words."""
    words = np.flatnonzero(open_lanes)
    near = open_lanes[words]
    skip, turn = divmod(shift, 64)
    counters = Counters(words.shape, radius)
    last = planes.shape[1] - 1
    for at in range(0, planes.shape[0], STEP):
        rows = planes[at : at + STEP]
        there = rows[:, np.minimum(words + skip, last)]
        if turn:
            above = rows[:, np.minimum(words + skip + 1, last)]
            there = (there >> np.uint64(turn)) | (above << np.uint64(64 - turn))
        difference = rows[:, words] ^ there
        counters.add_planes(list(difference))
        near = near & ~counters.exceed()
        alive = near != 0
        if not alive.all():
            words, near = words[alive], near[alive]
            counters.keep(alive)
            if not len(words):
                return np.zeros(0, np.int64)
    bits = np.unpackbits(near.view(np.uint8), bitorder="little").reshape(-1, 64)
    row, lane = np.nonzero(bits)
    return words[row] * 64 + lane


def near_of_queries(
    planes: np.ndarray, queries: np.ndarray, radius: int
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, lane) within ``radius``; ``queries``: their bits, one row each."""
    words = planes.shape[1]
    asked = np.where(queries != 0, np.uint64(0xFFFFFFFFFFFFFFFF), np.uint64(0))
    at_query = np.repeat(np.arange(len(queries)), words)
    at_word = np.tile(np.arange(words), len(queries))
    counters = Counters(at_word.shape, radius)
    near = np.full(at_word.shape, 0xFFFFFFFFFFFFFFFF, np.uint64)
    for at in range(0, planes.shape[0], STEP):
        difference = [
            planes[b][at_word] ^ asked[at_query, b]
            for b in range(at, min(at + STEP, planes.shape[0]))
        ]
        counters.add_planes(difference)
        near = near & ~counters.exceed()
        alive = near != 0
        if not alive.all():
            at_query, at_word, near = at_query[alive], at_word[alive], near[alive]
            counters.keep(alive)
            if not len(near):
                break
    bits = np.unpackbits(near.view(np.uint8), bitorder="little").reshape(-1, 64)
    row, lane = np.nonzero(bits)
    return at_query[row], at_word[row] * 64 + lane


class Forest:
    """Union-find over lanes; links between lanes already joined are passed over."""

    def __init__(self, lanes: int):
        self.parent = np.arange(lanes)

    def roots(self) -> np.ndarray:
        while True:
            up = self.parent[self.parent]
            if (up == self.parent).all():
                return up
            self.parent = up

    def link(self, left: np.ndarray, right: np.ndarray) -> None:
        roots = self.roots()
        a, b = roots[left], roots[right]
        apart = a != b
        if not apart.any():
            return
        parent = self.parent
        for x, y in zip(a[apart].tolist(), b[apart].tolist()):
            while parent[x] != x:
                x = parent[x]
            while parent[y] != y:
                y = parent[y]
            if x != y:
                parent[max(x, y)] = min(x, y)


#: Groups up to this size are compared together by shifts, larger ones by queries.
SHIFTED = 256


def link_groups(bits: np.ndarray, starts: np.ndarray, radius: int) -> np.ndarray:
    """Each lane's root among the lanes of its group that links reach.

    ``starts``: first lane of each group, lanes of one group stand together.
    """
    lanes = len(bits)
    forest = Forest(lanes)
    sizes = np.diff(np.append(starts, lanes))
    small = sizes <= SHIFTED
    planes = bit_planes(bits)
    ends = np.repeat(np.where(small, starts + sizes, 0), sizes)
    index = np.arange(lanes)
    for shift in range(1, int(sizes[small].max(initial=1))):
        inside = np.zeros((planes.shape[1]) * 64, np.uint8)
        inside[:lanes] = index + shift < ends
        mask = np.packbits(inside, bitorder="little").view(np.uint64)
        if not mask.any():
            break
        found = near_at_shift(planes, mask, shift, radius)
        if len(found):
            forest.link(found, found + shift)
    for start, size in zip(starts[~small].tolist(), sizes[~small].tolist()):
        own = bits[start : start + size]
        own_planes = bit_planes(own)
        queries = max(1, 32768 // own_planes.shape[1])
        for at in range(0, size, queries):
            # A lane asks only blocks from its own on: earlier pairs are known.
            first = at // 64
            asked, lane = near_of_queries(
                np.ascontiguousarray(own_planes[:, first:]), own[at : at + queries], radius
            )
            lane = lane + first * 64
            asked = asked + at
            new = (lane > asked) & (lane < size)
            forest.link(asked[new] + start, lane[new] + start)
    return forest.roots()


def _linker(radius: int, lanes_at_once: int = 1 << 15) -> Callable:
    """Rows (key, fp), sorted by key: links from each lane to its root."""

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch | None:
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(starts, len(keys)))
        paired = np.repeat(sizes > 1, sizes)
        keys, fps = keys[paired], fps[paired]
        if not len(keys):
            return None
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        bits = np.unpackbits(fps, axis=1, bitorder="little")
        roots = link_groups(bits, starts, radius)
        # All link to their part's smallest fingerprint: other tables find the same one.
        order = np.lexsort(fps.T[::-1])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        smallest = np.full(len(order), len(order))
        np.minimum.at(smallest, roots, rank)
        head = order[smallest[roots]]
        lane = np.flatnonzero(head != np.arange(len(head)))
        if not len(lane):
            return None
        left = [fps[i].tobytes() for i in lane]
        right = [fps[i].tobytes() for i in head[lane]]
        return pa.RecordBatch.from_arrays(
            [pa.array(left, pa.binary()), pa.array(right, pa.binary())], ["a", "b"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        count = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy(zero_copy_only=False)
            raw = b"".join(batch.column(1).to_pylist())
            held.append((keys, np.frombuffer(raw, np.uint8).reshape(len(keys), -1)))
            count += len(keys)
            if count < lanes_at_once:
                continue
            keys = np.concatenate([k for k, _ in held])
            fps = np.concatenate([f for _, f in held])
            # The last group may go on in the next batch.
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                if (out := links(keys[:cut], fps[:cut])) is not None:
                    yield out
            held, count = [(keys[cut:], fps[cut:])], len(keys) - cut
        if held:
            keys = np.concatenate([k for k, _ in held])
            fps = np.concatenate([f for _, f in held])
            if (out := links(keys, fps)) is not None:
                yield out

    return run


def near_links(prints: DataFrame, keys: list[list[int]], radius: int) -> DataFrame:
    """Links (a, b) of distinct fingerprints ``fp``, none null, that keep all connections.

    ``prints`` has each fingerprint once; a single one, or none, has no links.

    Within a bucket only links that join two parts are kept, never all pairs. A bucket
    with more than ``CHUNK`` fingerprints is compared as pairs of chunks, each a task's
    group of its own. How many chunks a bucket needs is estimated from one in 64
    fingerprints; the estimate changes the work's division only, never the links.
    """
    spark = prints.sparkSession
    few = prints.filter(F.pmod(F.xxhash64("fp"), F.lit(SAMPLED)) == 0)
    crowded = checkpointed(
        _bucketed(few, keys)
        .groupBy("key")
        .count()
        .filter(F.col("count") * SAMPLED > CHUNK)
        .select(
            F.col("key").alias("crowded"),
            F.ceil(F.col("count") * SAMPLED / CHUNK).cast("int").alias("chunks"),
        )
    )
    rows = _bucketed(prints, keys)
    number = crowded.count()
    if number:
        split = F.broadcast(crowded) if number <= MOST_BROADCAST else crowded
        own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
        joined = rows.join(split, F.col("key") == F.col("crowded"), "left")
        other = F.explode(
            F.when(
                F.col("chunks").isNotNull(), F.sequence(F.lit(0), F.col("chunks") - 1)
            ).otherwise(F.array(F.lit(-1)))
        )
        paired = joined.withColumn("own", own).withColumn("other", other)
        rows = paired.select(
            F.when(F.col("other") < 0, F.col("key"))
            .otherwise(
                F.xxhash64(
                    "key", F.least("own", "other"), F.greatest("own", "other")
                )
            )
            .alias("key"),
            "fp",
        )
    dealt = rows.repartition("key").sortWithinPartitions("key")
    links = dealt.mapInArrow(_linker(radius), "a binary, b binary").distinct()
    # A fingerprint has one link per bucket it stands in, so few in all: it keeps the
    # smallest, to which its other partners are linked instead.
    gathered = links.groupBy("a").agg(F.min("b").alias("m"), F.collect_set("b").alias("bs"))
    partner = F.explode(F.concat(F.array("a"), "bs"))
    return gathered.select(partner.alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


# -- components ------------------------------------------------------------------


def component_labels(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node that links reach, for every linked node.

    Alternates two steps on links until nothing changes: each node's larger neighbours
    are linked to its smallest, then its smaller ones. Both group only by node and join
    the minimum back, so no neighbourhood is ever gathered, and a hub's rows stay a
    join that Spark may split.
    """
    edges = checkpointed(
        links.filter("a != b").select(
            F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
        ).distinct()
    )
    seen = None
    while True:
        state = edges.agg(
            F.count("u"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
        ).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("at"), F.least("u", "m").alias("m")
        )
        large = (
            both.join(low, F.col("u") == F.col("at"))
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), "m")
        joined = large.join(low, F.col("u") == F.col("at"))
        small = (
            joined.select(
                F.explode(
                    F.array(
                        F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                        F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    )
                ).alias("e")
            )
            .select("e.u", "e.v")
            .filter("u != v")
            .distinct()
        )
        edges = checkpointed(small)
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 4,
    parts: int = 1,
    keys: list[list[int]] | None = None,
    radius: int = 4,
) -> DataFrame:
    """Per row ``doc_id, text_key, fp`` (bytes), ``component_id`` and ``first_key``.

    The component is the smallest id that links of at most ``radius`` differing bits
    reach, itself included. By default the tables are every two of six blocks, which
    miss no link up to radius 4; other ``keys`` may trade that for a larger radius.
    Equal fingerprints count as linked and are compared once. Texts without words have
    fingerprint zero and link like any other. Null ids rank behind all others; a
    component without any id is null. ``text_key`` is the text's xxhash64 and
    ``first_key`` that of the component's first row. Repeated rows come back repeated,
    an empty table gives no rows, and other columns are not looked at.
    """
    if keys is None:
        if parts != 1 or radius > 4:
            raise ValueError("give the keys for this radius")
        keys = block_keys(64, 6, 2)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = checkpointed(
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.xxhash64(text).alias("text_key"),
            fingerprints(text, shingle, parts).alias("fp"),
        )
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key"))
    prints = checkpointed(rows.groupBy("fp").agg(first.alias("first")))
    labels = component_labels(near_links(prints, keys, radius))
    grouped = prints.join(labels, F.col("fp") == F.col("node"), "left").select(
        F.col("fp").alias("of"), "first", F.coalesce("label", "fp").alias("label")
    )
    smallest = grouped.groupBy("label").agg(F.min("first").alias("first"))
    classes = grouped.drop("first").join(smallest, "label").select(
        "of",
        F.col("first.doc_id").alias("component_id"),
        F.col("first.text_key").alias("first_key"),
    )
    return rows.join(classes, F.col("fp") == F.col("of")).select(
        "doc_id", "text_key", "fp", "component_id", "first_key"
    )


def one_of_each(
    docs: DataFrame, components: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The first row of each component, with all its columns.

    Of rows alike in id and text any one stays.
    """
    winners = components.select("component_id", "first_key").distinct()
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
        F.xxhash64(text).alias("key"),
    )
    kept = rows.join(
        winners.select(
            F.coalesce(F.col("component_id").cast("string"), F.lit("")).alias("id"),
            F.col("first_key").alias("key"),
        ),
        ["id", "key"],
        "left_semi",
    )
    return kept.dropDuplicates(["id", "key"]).select("row.*")


def hex_of(fp: Column) -> Column:
    """A one-part fingerprint as 16 hex digits, highest bit first."""
    return F.lower(F.concat(*[F.hex(F.substring(fp, i, 1)) for i in range(8, 0, -1)]))
