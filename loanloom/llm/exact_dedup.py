"""Exact deduplication by Grace hashing over complete texts.

Records are collected in an open-addressing table. When its distinct contents outgrow
the memory given, table and remaining input are dealt by hash to spill files and each
file is worked alone, with another hash, until every bucket fits. Copies are merged
before the shuffle by the same code, so a text that a third of all rows share arrives
at its reducer once per input partition.
"""

from __future__ import annotations

import hashlib
import os
import struct
import tempfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Content, rows merged so far, largest id among them.
Record = tuple[bytes, int, "int | None"]

FANOUT = 16
_HEAD = "<qq?q"


class OpenTable:
    """Distinct contents with their counts; linear probing, full comparison."""

    def __init__(self, budget: int):
        self.budget, self.used = budget, 0
        self.slots = [-1] * 1024
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.copies: list[int] = []
        self.largest: list[int | None] = []

    def add(self, content: bytes, copies: int, largest: int | None) -> bool:
        """False, and nothing changed, if a new content no longer fits."""
        code = xxhash.xxh64_intdigest(content)
        mask = len(self.slots) - 1
        slot = code & mask
        while (at := self.slots[slot]) >= 0:
            if self.hashes[at] == code and self.contents[at] == content:
                self.copies[at] += copies
                if self.largest[at] is None or (
                    largest is not None and largest > self.largest[at]
                ):
                    self.largest[at] = largest
                return True
            slot = (slot + 1) & mask
        size = len(content) + 128
        if self.contents and self.used + size > self.budget:
            return False
        self.used += size
        self.slots[slot] = len(self.contents)
        self.hashes.append(code)
        self.contents.append(content)
        self.copies.append(copies)
        self.largest.append(largest)
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return True

    def _grow(self) -> None:
        self.slots = [-1] * (2 * len(self.slots))
        mask = len(self.slots) - 1
        for at, code in enumerate(self.hashes):
            slot = code & mask
            while self.slots[slot] >= 0:
                slot = (slot + 1) & mask
            self.slots[slot] = at

    def records(self) -> Iterator[Record]:
        return zip(self.contents, self.copies, self.largest)


def _spill(records: Iterable[Record], folder: str, level: int) -> list[str]:
    paths = [os.path.join(folder, f"{level}-{i}") for i in range(FANOUT)]
    files = [open(p, "wb") for p in paths]
    try:
        for content, copies, largest in records:
            to = files[xxhash.xxh64_intdigest(content, level + 1) % FANOUT]
            to.write(struct.pack(_HEAD, len(content), copies, largest is None, largest or 0))
            to.write(content)
    finally:
        for f in files:
            f.close()
    return paths


def _read(path: str) -> Iterator[Record]:
    with open(path, "rb") as f:
        while head := f.read(struct.calcsize(_HEAD)):
            size, copies, missing, largest = struct.unpack(_HEAD, head)
            yield f.read(size), copies, None if missing else largest


def collapse(records: Iterable[Record], budget: int, level: int = 0) -> Iterator[Record]:
    """One record per distinct content, in memory of about ``budget`` bytes.

    Spill files belong to the running task alone and go with it: a lost executor's
    task starts anew from its input.
    """
    source = iter(records)
    table = OpenTable(budget)
    for record in source:
        if table.add(*record):
            continue
        with tempfile.TemporaryDirectory(prefix="grace-") as folder:

            def rest(first=record, table=table):
                yield from table.records()
                yield first
                yield from source

            paths = _spill(rest(), folder, level)
            table = OpenTable(0)
            for path in paths:
                yield from collapse(_read(path), budget, level + 1)
                os.unlink(path)
        return
    yield from table.records()


def _task(budget: int, with_text: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records():
            for batch in batches:
                columns = batch.columns
                contents = columns[0].cast(pa.binary()).to_pylist()
                yield from zip(contents, columns[1].to_pylist(), columns[2].to_pylist())

        rows, held = [], 0
        for content, copies, largest in collapse(records(), budget):
            digest = hashlib.sha256(content).digest()
            rows.append((content if with_text else b"", copies, largest, digest))
            held += len(rows[-1][0]) + 64
            if held > 4_000_000:
                yield _batch(rows)
                rows, held = [], 0
        if rows:
            yield _batch(rows)

    return run


def _batch(rows: list) -> pa.RecordBatch:
    content, copies, largest, digest = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(content, pa.binary()).cast(pa.string()),
            pa.array(copies, pa.int64()),
            pa.array(largest, pa.int64()),
            pa.array(digest, pa.binary()),
        ],
        names=["content", "copies", "largest", "digest"],
    )


_SCHEMA = "content string, copies long, largest long, digest binary"


def text_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    memory_bytes: int = 64 << 20,
) -> DataFrame:
    """One row per distinct text: digest, copies, largest id (null if all are)."""
    rows = docs.select(
        F.coalesce(F.col(text_col), F.lit("")).alias("content"),
        F.lit(1).cast("long").alias("copies"),
        F.col(id_col).cast("long").alias("largest"),
    )
    merged = rows.mapInArrow(_task(memory_bytes, True), _SCHEMA)
    dealt = merged.repartition("digest").select("content", "copies", "largest")
    return dealt.mapInArrow(_task(memory_bytes, False), _SCHEMA).drop("content")


def exact_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    memory_bytes: int = 64 << 20,
) -> DataFrame:
    """Every row with the group of its text and whether it stays.

    Null texts count as empty, texts are compared unchanged. Of equal texts the row
    with the largest id stays; of several rows with that id, or of rows that all lack
    one, exactly one. Null ids rank below all others. An empty table gives no rows,
    and columns other than id and text are not looked at.
    """
    groups = text_groups(docs, id_col, text_col, memory_bytes).select(
        F.col("digest").alias("_digest"),
        F.col("largest").alias("keep_id"),
        F.col("copies").alias("group_size"),
    )
    # Rows alike in id and text can't be told apart: counted, then written out again.
    alike = (
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"),
        )
        .groupBy("doc_id", "digest")
        .count()
    )
    numbered = alike.join(groups, F.col("digest") == F.col("_digest")).withColumn(
        "_nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("count")))
    )
    return numbered.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("_nth") == 1)).alias(
            "kept"
        ),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
