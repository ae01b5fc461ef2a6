"""Alignment of two tokenizers over a corpus, with counts of linked token ids.

Both tokenizers cut the same bytes; tokens whose byte ranges overlap are linked. The
first pass aligns all documents and counts links per pair of ids within each task. The
distinct pairs get a minimal perfect hash, shard by shard: pairs without a collision in
a bit array settle there, the others go on to the next one, and a pair's index is the
rank of its bit. Counts are dense vectors by index, summed in a tree per shard, with
the pairs beside them, as the hash alone says nothing of strangers. The second pass
aligns the documents again and looks the counts up.

Neither tokenizer joins a space to what stands before it, so texts are cut there and
a task encodes each of the pieces that it remembers once, many in one call.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from itertools import chain, islice
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import shared_folder

#: Where the vocabularies lie for the driver, and their files; tasks receive them.
TOKENIZERS = "/opt/tokenizers"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"

#: Distinct pieces that a task remembers, of which the half met most often stays when
#: there are more; characters of texts at one time, and of pieces in one call.
REMEMBERED, CHARS_AT_ONCE, CHARS_A_CALL = 400_000, 2_000_000, 50_000
#: Pairs of a shard and of a leaf of the sum, and leaves summed in one step.
SHARD_PAIRS, LEAF_PAIRS, FAN_IN = 1 << 14, 1 << 17, 8
#: Bits per pair in each level of the hash; cells that shards are made of.
SPARSE, CELLS = 2, 1 << 16
#: Bytes of counts that tasks receive; more are looked up by a shuffle.
MOST_BROADCAST = 64 << 20
_BYTES_A_PAIR = 18

_CUT = re.compile(r"(?<=\S)(?= )")
_WIDE = re.compile(r"\s ")
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


# -- tokenizers --------------------------------------------------------------------


def byte_of_letter() -> dict[str, int]:
    """Bytes by the letters of byte-level vocabularies: printable ones stand for
    themselves, the others for the letters from U+0100 on, in order."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    letters = {chr(b): b for b in plain}
    others = (b for b in range(256) if b not in plain)
    return letters | {chr(0x100 + i): b for i, b in enumerate(others)}


#: Fixed value: how byte-level tokenizers part a text before they merge.
PARTS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class TwoTokenizers:
    """A byte-level and a piece tokenizer with the bytes of their tokens."""

    def __init__(self, byte_level: str, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor

        model = json.loads(byte_level)["model"]
        letters = byte_of_letter()
        self.a_bytes = [b""] * (max(model["vocab"].values()) + 1)
        for token, at in model["vocab"].items():
            self.a_bytes[at] = bytes(letters[c] for c in token if c in letters)
        self.encode_a = _encoder(byte_level, model, self.a_bytes)
        self.b = SentencePieceProcessor(model_proto=pieces)
        named = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(named)
        ]
        self.a_sizes = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(t) for t in self.b_bytes], np.int64)
        # A piece that reaches over a space would be lost by cutting there.
        self.cuts = not any(re.search("[^▁]▁", p) for p in named)
        self.space = self.b.piece_to_id("▁")

    def encode_b(self, text: str) -> list[int]:
        """Ids of a text that begins with the space the tokenizer adds."""
        return self.b.encode(text[1:], num_threads=1) or [self.space]

    def pieces(self, text: str) -> list[str]:
        """The text cut before its spaces, each piece without the space it begins with.

        Only the first of several white characters ends a piece: what a tokenizer makes
        of a run depends on the whole of it.
        """
        if not self.cuts:
            return [text]
        if _WIDE.search(" " + text):
            return [p[1:] for p in _CUT.split(" " + text)]
        return text.split(" ")


def _encoder(byte_level: str, model: dict, token_bytes: list[bytes]) -> Callable:
    """Text to ids without special tokens.

    Where each merge makes the next id, ids rank the merges, and the faster library
    encodes by ranks with the same result; it is given the same vocabulary.
    """
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    # Single bytes come first.
    first = sum(len(t) == 1 for t in token_bytes)
    ranked = all(
        model["vocab"]["".join(merge)] == at for at, merge in enumerate(merges, first)
    )
    if ranked:
        import tiktoken

        ranks = {t: i for i, t in enumerate(token_bytes[: first + len(merges)])}
        library = tiktoken.Encoding(
            "ranked", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={}
        )
        return library.encode_ordinary
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(byte_level)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def read_vocabularies(folder: str) -> tuple[str, bytes]:
    with open(f"{folder}/{BYTE_LEVEL}", encoding="utf-8") as f:
        byte_level = json.dumps(json.load(f), ensure_ascii=False)
    with open(f"{folder}/{PIECES}", "rb") as f:
        return byte_level, f.read()


# -- alignment -----------------------------------------------------------------------


@dataclass
class Aligned:
    """Pieces in a row: sizes by piece, and the pairs linked in each, one after another.

    A piece whose tokens do not give its bytes back is not ``whole`` and has none.
    """

    whole: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    pairs: np.ndarray
    groups: list[str]

    @classmethod
    def joined(cls, parts: list[Aligned]) -> Aligned:
        names = ("whole", "n_a", "n_b", "n_groups", "n_links", "pairs")
        arrays = [np.concatenate([getattr(p, n) for p in parts]) for n in names]
        return cls(*arrays, [g for p in parts for g in p.groups])

    def taken(self, at: np.ndarray) -> Aligned:
        """Some of the pieces."""
        names = ("whole", "n_a", "n_b", "n_groups", "n_links")
        sizes = self.n_links[at]
        begin = (np.cumsum(self.n_links) - self.n_links)[at]
        of_pairs = np.arange(sizes.sum()) + np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        groups = [self.groups[i] for i in at.tolist()] if self.groups else []
        return Aligned(*[getattr(self, n)[at] for n in names], self.pairs[of_pairs], groups)


def _sizes(ids: list) -> np.ndarray:
    return np.fromiter(map(len, ids), np.int64, len(ids))


def _counts(ends: np.ndarray, token_ends: np.ndarray) -> np.ndarray | None:
    """Tokens up to each end of a piece; none if a token reaches over one."""
    at = np.searchsorted(token_ends, ends)
    if at[-1] >= len(token_ends) or (token_ends[at] != ends).any():
        return None
    return np.diff(at + 1, prepend=0)


def _encoded(two: TwoTokenizers, pieces: list[str]) -> Iterator[tuple]:
    """Ids of both and tokens by piece, for runs of pieces encoded as one text.

    A run whose bytes do not come back is halved until the broken piece stands alone.
    """
    text = " " + " ".join(pieces)
    raw = text.encode()
    a, b = two.encode_a(text), two.encode_b(text)
    whole = b"".join([two.b_bytes[i] for i in b]) == raw
    whole = whole and b"".join([two.a_bytes[i] for i in a]) == raw
    if whole:
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        ends = np.cumsum([len(p.encode()) + 1 for p in pieces])
        n_a = _counts(ends, np.cumsum(two.a_sizes[a]))
        n_b = _counts(ends, np.cumsum(two.b_sizes[b]))
        if n_a is not None and n_b is not None:
            yield a, n_a, b, n_b
            return
    if len(pieces) > 1:
        half = len(pieces) // 2
        yield from _encoded(two, pieces[:half])
        yield from _encoded(two, pieces[half:])
    else:
        none = np.zeros(0, np.int64)
        yield none, np.zeros(1, np.int64), none, np.zeros(1, np.int64)


def _runs(pieces: list[str]) -> Iterator[list[str]]:
    """Pieces that may stand one after the other: those before another end in no space."""
    run, held = [], 0
    for piece in pieces:
        run.append(piece)
        held += len(piece) + 1
        if held > CHARS_A_CALL or not piece or piece[-1].isspace():
            yield run
            run, held = [], 0
    if run:
        yield run


def align(two: TwoTokenizers, pieces: list[str], with_groups: bool) -> Aligned:
    """Both tokenizers over every piece, and their links and groups."""
    none = np.zeros(0, np.int64)
    parts = [part for run in _runs(pieces) for part in _encoded(two, run)]
    ids_a, n_a, ids_b, n_b = (np.concatenate([none, *c]) for c in (zip(*parts) if parts else [[]] * 4))
    # All pieces stand on one axis of bytes; their ends are ends of both.
    size_a, size_b = two.a_sizes[ids_a], two.b_sizes[ids_b]
    end_a, end_b = np.cumsum(size_a), np.cumsum(size_b)
    first = np.searchsorted(end_b, end_a - size_a, "right")
    behind = np.searchsorted(end_b - size_b, end_a, "left")
    links = behind - first
    own = np.repeat(np.arange(len(ids_a)), links)
    nth = np.arange(len(own)) - np.repeat(np.cumsum(links) - links, links)
    pairs = ids_a[own] << 32 | ids_b[np.repeat(first, links) + nth]
    piece_of = np.repeat(np.arange(len(pieces)), n_a)
    both = end_b[np.minimum(np.searchsorted(end_b, end_a), len(end_b) - 1)] == end_a
    count = len(pieces)
    texts = []
    if with_groups:
        cut_b = end_a[np.minimum(np.searchsorted(end_a, end_b), len(end_a) - 1)] == end_b
        texts = _group_texts(ids_a, ids_b, both, cut_b, piece_of, count)
    return Aligned(
        n_a > 0,
        n_a,
        n_b,
        np.bincount(piece_of[both], minlength=count),
        np.bincount(piece_of[own], minlength=count),
        pairs,
        texts,
    )


def _group_texts(
    ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray,
    piece_of: np.ndarray, count: int,
) -> list[str]:
    """Per piece its groups: ids of one, a bar, ids of the other; groups by semicolons."""
    text_a, text_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
    groups: list[list[str]] = [[] for _ in range(count)]
    from_a = from_b = 0
    ends = zip((np.flatnonzero(cut_a) + 1).tolist(), (np.flatnonzero(cut_b) + 1).tolist())
    for to_a, to_b in ends:
        group = f"{','.join(text_a[from_a:to_a])}|{','.join(text_b[from_b:to_b])}"
        groups[piece_of[from_a]].append(group)
        from_a, from_b = to_a, to_b
    return [";".join(g) for g in groups]


class _Numbered(dict):
    """Pieces by number; a new one gets the next."""

    def __missing__(self, piece: str) -> int:
        number = self[piece] = len(self)
        return number


class Memory:
    """Alignments of the pieces met so far, and how often each was met."""

    def __init__(self, two: TwoTokenizers, with_groups: bool):
        self.two, self.with_groups = two, with_groups
        self.known = _Numbered()
        self.times = np.zeros(0, np.int64)
        self.aligned = align(two, [], with_groups)

    def meet(self, pieces: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts, and where each text ends."""
        before = len(self.known)
        ends = np.cumsum(_sizes(pieces))
        numbers = map(self.known.__getitem__, chain.from_iterable(pieces))
        at = np.fromiter(numbers, np.int64, int(ends[-1]) if len(ends) else 0)
        if len(self.known) > before:
            new = list(islice(self.known, before, None))
            learned = align(self.two, new, self.with_groups)
            self.aligned = Aligned.joined([self.aligned, learned])
        met = np.bincount(at, minlength=len(self.known))
        met[:before] += self.times
        self.times = met
        return at, ends

    def shrink(self) -> np.ndarray:
        """Keeps the half met most often; their former numbers."""
        order = np.sort(np.argsort(-self.times, kind="stable")[: REMEMBERED // 2])
        names = list(self.known)
        self.known = _Numbered((names[i], n) for n, i in enumerate(order.tolist()))
        self.times = self.times[order]
        self.aligned = self.aligned.taken(order)
        return order


def _per_text(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values))
    return total[ends] - total[np.append(0, ends[:-1])]


def _text_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    ids, texts, held = [], [], 0
    for batch in batches:
        for row_id, text in zip(*batch.columns):
            ids.append(row_id.as_py())
            texts.append(text.as_py() or "")
            held += len(texts[-1])
            if held > CHARS_AT_ONCE:
                yield ids, texts
                ids, texts, held = [], [], 0
    if ids:
        yield ids, texts


class TextAligner:
    """Aligns batches of texts by their pieces."""

    def __init__(self, two: TwoTokenizers, with_groups: bool):
        self.two = two
        self.memory = Memory(two, with_groups)

    def read(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, dict[int, Aligned]]:
        """Piece numbers, text ends, and texts of broken pieces aligned as a whole.

        An empty text has no pieces. Broken pieces may still make up for each other, so
        their texts are judged uncut.
        """
        numbers, ends = self.memory.meet([self.two.pieces(t) if t else [] for t in texts])
        broken = np.flatnonzero(_per_text(~self.memory.aligned.whole[numbers], ends))
        apart = {}
        for at in broken.tolist():
            apart[at] = align(self.two, [texts[at]], self.memory.with_groups)
        return numbers, ends, apart


# -- first pass: links per pair ----------------------------------------------------------


def _summed(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(pairs, kind="stable")
    pairs, times = pairs[order], times[order]
    begin = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1])) if len(pairs) else []
    return pairs[begin], np.add.reduceat(times, begin) if len(pairs) else times


def _count_links(vocabularies: Callable) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = TextAligner(TwoTokenizers(*vocabularies()), with_groups=False)
        memory, times, apart_pairs = aligner.memory, np.zeros(0, np.int64), []

        def counted() -> pa.RecordBatch:
            aligned = memory.aligned
            per_link = np.repeat(times, aligned.n_links)
            met = per_link > 0
            pairs = [aligned.pairs[met], *apart_pairs]
            ones = [np.ones(len(p), np.int64) for p in apart_pairs]
            found, sums = _summed(np.concatenate(pairs), np.concatenate([per_link[met], *ones]))
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(sums)], ["pair", "links"])

        for _, texts in _text_batches(batches):
            numbers, ends, apart = aligner.read(texts)
            text_of = np.repeat(np.arange(len(texts)), np.diff(ends, prepend=0))
            counts = ~np.isin(text_of, list(apart))
            new = np.bincount(numbers[counts], minlength=len(memory.known))
            new[: len(times)] += times
            times = new
            apart_pairs += [a.pairs for a in apart.values()]
            if len(memory.known) > REMEMBERED:
                yield counted()
                times, apart_pairs = np.zeros(len(memory.shrink()), np.int64), []
        if len(times) or apart_pairs:
            yield counted()

    return run


# -- minimal perfect hash ---------------------------------------------------------------


def _mixed(pairs: np.ndarray, level: int) -> np.ndarray:
    code = pairs.astype(np.uint64) + np.uint64((level + 1) * _MIX[0] & (1 << 64) - 1)
    for shift, factor in ((30, _MIX[1]), (27, _MIX[2])):
        code = (code ^ (code >> np.uint64(shift))) * np.uint64(factor)
    return code ^ (code >> np.uint64(31))


def perfect_hash(pairs: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Level sizes, all levels' bits, and the distinct pairs by their index."""
    sizes, levels, settled, rest = [], [], [], pairs
    while len(rest):
        size = SPARSE * len(rest)
        at = (_mixed(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        mine = alone[at]
        order = np.argsort(at[mine], kind="stable")
        settled.append(rest[mine][order])
        sizes.append(size)
        levels.append(alone)
        rest = rest[~mine]
    none = np.zeros(0, np.int64)
    return sizes, np.concatenate([none.astype(bool), *levels]), np.concatenate([none, *settled])


class PairTable:
    """The hashes of some shards side by side, with the pairs and counts by index."""

    def __init__(self, shards: list[dict], count: int):
        """``shards`` by number, each with ``sizes``, ``bits``, ``pairs``, ``counts``."""
        self.count = count
        depth = max((len(s["sizes"]) for s in shards), default=0)
        self.sizes = np.zeros((count, depth), np.int64)
        self.begin = np.zeros((count, depth), np.int64)
        bits, held = [], 0
        for shard in shards:
            for level, size in enumerate(shard["sizes"]):
                self.sizes[shard["shard"], level] = size
                self.begin[shard["shard"], level] = held
                held += size
            bits.append(np.unpackbits(np.frombuffer(shard["bits"], np.uint8), count=sum(shard["sizes"])))
        flat = np.concatenate([np.zeros(0, np.uint8), *bits])
        self.bits = flat
        self.rank = np.cumsum(flat, dtype=np.int64) - flat
        none = np.zeros(0, np.int64)
        self.pairs = np.concatenate([none, *[np.frombuffer(s["pairs"], np.int64) for s in shards]])
        self.counts = np.concatenate(
            [none, *[np.frombuffer(s["counts"], np.int64) for s in shards if s.get("counts")]]
        )

    def index(self, pairs: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """Index of each pair, -1 for a pair that is not among those hashed."""
        found = np.full(len(pairs), -1, np.int64)
        open_ = np.arange(len(pairs))
        for level in range(self.sizes.shape[1]):
            size = self.sizes[shard[open_], level]
            open_ = open_[size > 0]
            if not len(open_):
                break
            size = size[size > 0]
            at = (_mixed(pairs[open_], level) % size.astype(np.uint64)).astype(np.int64)
            at += self.begin[shard[open_], level]
            hit = self.bits[at] == 1
            found[open_[hit]] = self.rank[at[hit]]
            open_ = open_[~hit]
        here = np.flatnonzero(found >= 0)
        found[here[self.pairs[found[here]] != pairs[here]]] = -1
        return found

    def count_of(self, pairs: np.ndarray) -> np.ndarray:
        found = self.index(pairs, shard_of(pairs, self.count))
        return np.where(found >= 0, self.counts[found], 0) if len(self.counts) else found * 0


def shard_of(pairs: np.ndarray, count: int) -> np.ndarray:
    return (_mixed(pairs, 1 << 20) % np.uint64(CELLS)).astype(np.int64) % count


def _with_shard(rows: DataFrame, count: int, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = batch.column("pair").to_numpy()
            yield batch.append_column("shard", pa.array(shard_of(pairs, count)))

    return rows.mapInArrow(run, f"{schema}, shard long")


_SHARD = "shard long, sizes array<long>, bits binary, pairs binary"
_SHARD_TYPES = pa.schema(
    [("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("pairs", pa.binary())]
)


def _hash_shard(group: pa.Table) -> pa.Table:
    sizes, bits, pairs = perfect_hash(np.sort(group["pair"].to_numpy()))
    row = (group["shard"][0].as_py(), sizes, np.packbits(bits).tobytes(), pairs.tobytes())
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SHARD_TYPES)], schema=_SHARD_TYPES)


# -- dense counts, summed in a tree ----------------------------------------------------------

_VECTOR = "shard long, node long, counts binary"
_VECTOR_TYPES = pa.schema([("shard", pa.int64()), ("node", pa.int64()), ("counts", pa.binary())])


def _vector(shard: int, node: int, counts: np.ndarray) -> pa.Table:
    row = (shard, node, counts.astype(np.int64).tobytes())
    return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, _VECTOR_TYPES)], schema=_VECTOR_TYPES)


def _leaf_vector(rows: pa.Table, table: pa.Table) -> pa.Table:
    """Counts of a leaf's partial sums by the index of their pairs."""
    if not rows.num_rows:
        return _VECTOR_TYPES.empty_table()
    shard = table.to_pylist()[0]
    hashed = PairTable([{**shard, "shard": 0}], 1)
    pairs = rows["pair"].to_numpy()
    at = hashed.index(pairs, np.zeros(len(pairs), np.int64))
    if (at < 0).any():
        raise ValueError(f"a pair of shard {shard['shard']} is not in its hash")
    counts = np.zeros(len(hashed.pairs), np.int64)
    np.add.at(counts, at, rows["links"].to_numpy())
    return _vector(shard["shard"], table["node"][0].as_py(), counts)


def _sum_vectors(group: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c.as_py(), np.int64) for c in group["counts"])
    return _vector(group["shard"][0].as_py(), group["parent"][0].as_py(), total)


@dataclass(frozen=True)
class PairCounts:
    """Stored shards with hash, pairs and counts; the highest count of each second id."""

    shards: DataFrame
    count: int
    pairs: int
    highest: np.ndarray

    def as_rows(self) -> DataFrame:
        """``a_id, b_id, links`` of every pair that is linked anywhere."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for pairs, counts in zip(batch.column(0), batch.column(1)):
                    pair = np.frombuffer(pairs.as_py(), np.int64)
                    links = np.frombuffer(counts.as_py(), np.int64)
                    columns = (pair >> 32, pair & 0xFFFFFFFF, links)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns], names=["a_id", "b_id", "links"]
                    )

        stored = self.shards.select("pairs", "counts")
        return stored.mapInArrow(run, "a_id long, b_id long, links long")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )


def _stored(rows: DataFrame, path: str) -> DataFrame:
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def pair_counts(
    docs: DataFrame, folder: str, vocabularies: Callable, id_col: str, text_col: str
) -> PairCounts:
    """Counts of all pairs of linked ids in the corpus, stored under ``folder``."""
    rows = _texts(docs, id_col, text_col)
    counted = rows.mapInArrow(_count_links(vocabularies), "pair long, links long")
    partial = _stored(counted.withColumn("task", F.spark_partition_id()), f"{folder}/partial")
    distinct = _stored(partial.select("pair").distinct(), f"{folder}/distinct")
    pairs, partials = distinct.count(), partial.count()
    count = max(1, -(-pairs // SHARD_PAIRS))
    hashed = _stored(
        _with_shard(distinct, count, "pair long").groupBy("shard").applyInArrow(_hash_shard, _SHARD),
        f"{folder}/hashes",
    )
    nodes = max(1, -(-partials // (count * LEAF_PAIRS)))
    parts = _with_shard(
        partial.select("pair", "links", (F.col("task") % nodes).cast("long").alias("node")),
        count,
        "pair long, links long, node long",
    )
    tables = hashed.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(nodes - 1)))).select(
        *hashed.columns, F.col("node").cast("long").alias("node")
    )
    vectors = (
        parts.groupBy("shard", "node")
        .cogroup(tables.groupBy("shard", "node"))
        .applyInArrow(_leaf_vector, _VECTOR)
    )
    step = 0
    while nodes > 1:
        vectors = _stored(vectors, f"{folder}/sums-{step}")
        vectors = (
            vectors.withColumn("parent", F.expr(f"node div {FAN_IN}"))
            .groupBy("shard", "parent")
            .applyInArrow(_sum_vectors, _VECTOR)
        )
        nodes, step = -(-nodes // FAN_IN), step + 1
    sums = vectors.select(F.col("shard").alias("_shard"), "counts")
    shards = _stored(
        hashed.join(sums, F.col("shard") == F.col("_shard")).drop("_shard"), f"{folder}/counts"
    )
    found = PairCounts(shards, count, pairs, np.zeros(0, np.int64))
    # At most one row for each id of the second vocabulary reaches the driver.
    most = found.as_rows().groupBy("b_id").agg(F.max("links").alias("links")).toArrow()
    ids = most["b_id"].to_numpy()
    highest = np.zeros(int(ids.max()) + 1 if len(ids) else 0, np.int64)
    highest[ids] = most["links"].to_numpy()
    return PairCounts(shards, count, pairs, highest)


# -- second pass -----------------------------------------------------------------------------

_ROW = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)
_ROW_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_ROW_TYPES = [pa.int64()] * 7 + [pa.string()]


def _digest(groups: str) -> str:
    return sha256(groups.encode()).hexdigest() if groups else ""


def _look_up(vocabularies: Callable, counts: Callable | None) -> Callable:
    """Results per text; without counts, the text's distinct pairs and their times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = TextAligner(TwoTokenizers(*vocabularies()), with_groups=True)
        memory = aligner.memory
        table, highest = counts() if counts else (None, None)
        best = total = np.zeros(0, np.int64)

        def of_links(n_links: np.ndarray, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Links with the highest count of their second id, and the counts' sum, by piece."""
            piece = np.repeat(np.arange(len(n_links)), n_links)
            links = table.count_of(pairs)
            top = links == highest[pairs & 0xFFFFFFFF]
            ends = np.cumsum(n_links)
            return np.bincount(piece[top], minlength=len(ends)), _per_text(links, ends)

        for ids, texts in _text_batches(batches):
            numbers, ends, apart = aligner.read(texts)
            aligned = memory.aligned
            if counts and len(best) < len(aligned.whole):
                known = int(aligned.n_links[: len(best)].sum())
                more_best, more_total = of_links(
                    aligned.n_links[len(best) :], aligned.pairs[known:]
                )
                best, total = np.append(best, more_best), np.append(total, more_total)
            sizes = [aligned.n_a, aligned.n_b, aligned.n_groups, aligned.n_links]
            if counts:
                sizes += [best, total]
            sums = [_per_text(s[numbers], ends) for s in sizes]
            at, begin, digests = numbers.tolist(), 0, []
            for end in ends.tolist():
                digests.append(_digest(";".join(map(aligned.groups.__getitem__, at[begin:end]))))
                begin = end
            for text, whole in apart.items():
                values = [whole.n_a, whole.n_b, whole.n_groups, whole.n_links]
                if counts:
                    values += of_links(whole.n_links, whole.pairs)
                for column, value in zip(sums, values):
                    column[text] = value[0]
                digests[text] = _digest(whole.groups[0])
            columns = [ids, *sums, *([] if counts else [[0] * len(ids)] * 2), digests]
            names, arrays = list(_ROW_NAMES), [pa.array(c, t) for c, t in zip(columns, _ROW_TYPES)]
            if not counts:
                arrays += _links_of(aligned, numbers, ends, apart)
                names += ["pairs", "times"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
            if len(memory.known) > REMEMBERED:
                kept = memory.shrink()
                best, total = best[kept] if counts else best, total[kept] if counts else total

    return run


def _links_of(
    aligned: Aligned, numbers: np.ndarray, ends: np.ndarray, apart: dict[int, Aligned]
) -> list[pa.Array]:
    """Distinct pairs of each text and how often each is linked there."""
    begin = np.append(0, np.cumsum(aligned.n_links))
    pairs, times, start = [], [], 0
    for text, end in enumerate(ends.tolist()):
        if text in apart:
            all_pairs = apart[text].pairs
        else:
            pieces = numbers[start:end]
            parts = [aligned.pairs[begin[p] : begin[p + 1]] for p in pieces.tolist()]
            all_pairs = np.concatenate([np.zeros(0, np.int64), *parts])
        found, sums = _summed(all_pairs, np.ones(len(all_pairs), np.int64))
        pairs.append(found)
        times.append(sums)
        start = end
    return [pa.array(c, pa.list_(pa.int64())) for c in (pairs, times)]


def _looked_up(highest: Callable) -> Callable:
    def run(rows: pa.Table, table: pa.Table) -> pa.Table:
        names = ["row", "n_best", "count_sum"]
        if not rows.num_rows:
            return pa.schema([(n, pa.int64()) for n in names]).empty_table()
        shard = table.to_pylist()[0]
        hashed = PairTable([{**shard, "shard": 0}], 1)
        pairs, times = rows["pair"].to_numpy(), rows["times"].to_numpy()
        at = hashed.index(pairs, np.zeros(len(pairs), np.int64))
        links = np.where(at >= 0, hashed.counts[at], 0)
        top = links == highest()[pairs & 0xFFFFFFFF]
        columns = (rows["row"].to_numpy(), times * top, times * links)
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=names)

    return run


def _by_shuffle(rows: DataFrame, found: PairCounts, folder: str, highest: Callable) -> DataFrame:
    """The counts of each text's pairs, looked up where their shard is."""
    keyed = rows.withColumn("row", F.monotonically_increasing_id())
    stored = _stored(keyed, f"{folder}/texts")
    size = stored.agg(F.sum(F.size("pairs"))).first()[0] or 0
    nodes = max(1, -(-size // (found.count * LEAF_PAIRS)))
    links = stored.select(
        "row", F.explode(F.arrays_zip("pairs", "times")).alias("link")
    ).select(
        F.col("link.pairs").alias("pair"),
        F.col("link.times").alias("times"),
        "row",
        F.pmod(F.xxhash64("row"), F.lit(nodes)).alias("node"),
    )
    sharded = _with_shard(links, found.count, "pair long, times long, row long, node long")
    tables = found.shards.withColumn("node", F.explode(F.sequence(F.lit(0), F.lit(nodes - 1))))
    sums = (
        sharded.groupBy("shard", "node")
        .cogroup(tables.withColumn("node", F.col("node").cast("long")).groupBy("shard", "node"))
        .applyInArrow(_looked_up(highest), "row long, n_best long, count_sum long")
        .groupBy(F.col("row").alias("_row"))
        .agg(F.sum("n_best").alias("best"), F.sum("count_sum").alias("total"))
    )

    def or_none(name: str) -> Column:
        return F.coalesce(F.col(name), F.lit(0).cast("long"))

    return (
        stored.join(sums, F.col("row") == F.col("_row"), "left")
        .withColumns({"n_best": or_none("best"), "count_sum": or_none("total")})
        .select(*_ROW_NAMES)
    )


def aligned_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizers: str = TOKENIZERS,
    most_broadcast: int = MOST_BROADCAST,
) -> tuple[DataFrame, PairCounts]:
    """Every document's alignment and the counts of the whole corpus.

    Returns ``doc_id``, tokens of both (``n_a``, ``n_b``), ``n_groups`` between common
    ends, ``n_links``, ``n_best`` links whose count is the highest of their second id,
    ``count_sum`` over the links and ``groups_sha256``; and the counts themselves.

    Null and empty texts, and those that a tokenizer does not give back byte by byte,
    have no tokens: zeros and an empty digest. Special tokens in a text are text. Rows
    alike count each on its own; ids may be null; a table without rows gives none; other
    columns are not looked at. ``tokenizers`` is the vocabularies' folder on the driver.

    Counts are sent to the tasks if ``most_broadcast`` bytes hold them; beyond that each
    text's pairs are looked up by a shuffle to their shards, with equal results.
    """
    spark = docs.sparkSession
    folder = f"{shared_folder(spark)}/alignment-{uuid4().hex}"
    sent = spark.sparkContext.broadcast(read_vocabularies(tokenizers))

    def vocabularies() -> tuple[str, bytes]:
        return sent.value

    found = pair_counts(docs, folder, vocabularies, id_col, text_col)
    rows = _texts(docs, id_col, text_col)
    if found.pairs * _BYTES_A_PAIR <= most_broadcast:
        shards = found.shards.orderBy("shard").toArrow().to_pylist()
        held = spark.sparkContext.broadcast((shards, found.count, found.highest))

        def counts() -> tuple[PairTable, np.ndarray]:
            listed, count, highest = held.value
            return PairTable(listed, count), highest

        return rows.mapInArrow(_look_up(vocabularies, counts), _ROW), found
    most = spark.sparkContext.broadcast(found.highest)
    listed = f"{_ROW}, pairs array<long>, times array<long>"
    aligned = rows.mapInArrow(_look_up(vocabularies, None), listed)
    return _by_shuffle(aligned, found, folder, lambda: most.value), found
