"""WARC archives in Zstandard: one frame per record, dictionary in front.

An archive may begin with a skippable frame that holds the dictionary of all later
frames. Writing goes through Spark's own text writer, so files appear only when their
task has succeeded and any store that Spark reaches will do. The writer ends each row
with a line feed; every row therefore closes with the head of a skippable frame of one
byte, of which that line feed is the content, and the file stays a plain sequence of
Zstandard frames.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the formats.
VERSION = b"WARC/1.1"
DICTIONARY_FRAME = 0x184D2A5D
SKIPPABLE_FIRST, SKIPPABLE_LAST = 0x184D2A50, 0x184D2A5F
FRAME_MAGIC, DICTIONARY_MAGIC = 0xFD2FB528, 0xEC30A437
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
TYPES = (
    "warcinfo", "response", "resource", "request",
    "metadata", "revisit", "conversion", "continuation",
)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_LINE_END_FRAME = struct.pack("<II", SKIPPABLE_FIRST, 1)
_NO_ID = "none"
_PIECE = 16 << 10
#: Bytes that a record may decode to.
MAX_RECORD_BYTES = 1 << 30


# -- one archive -----------------------------------------------------------------


def record_bytes(headers: Iterable[tuple[str, str]], block: bytes) -> bytes:
    """An uncompressed record; Content-Length is added."""
    lines = [VERSION, *(f"{k}: {v}".encode() for k, v in headers)]
    lines.append(b"Content-Length: %d" % len(block))
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary


def train_dictionary(samples: list[bytes], size: int) -> bytes | None:
    """None where there is too little to learn from."""
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:
        return None


def read_frames(
    archive: bytes, max_record_bytes: int = MAX_RECORD_BYTES
) -> Iterator[tuple[int, bytes | None, str | None]]:
    """Start of each record's frame, its decoded bytes, or what is wrong with it.

    After a frame whose end can't be found nothing more can be read; the error says so.
    So it is with a record above ``max_record_bytes``, whether its frame states the
    size or not: no more than that is ever decoded.
    """
    view, at, loaded = memoryview(archive), 0, None
    while at < len(view):
        if len(view) - at < 8:
            yield at, None, "truncated frame"
            return
        magic, size = struct.unpack_from("<II", view, at)
        if SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
            if at + 8 + size > len(view):
                yield at, None, "truncated skippable frame"
                return
            if magic == DICTIONARY_FRAME and at == 0:
                try:
                    loaded = _dictionary(bytes(view[8 : 8 + size]))
                except zstd.ZstdError as broken:
                    yield at, None, f"bad dictionary: {broken}"
                    return
            at += 8 + size
            continue
        if magic != FRAME_MAGIC:
            yield at, None, "not a frame"
            return
        one = zstd.ZstdDecompressor(dict_data=loaded).decompressobj()
        parts, end, decoded = [], at, 0
        try:
            if zstd.frame_content_size(view[at : at + 18]) > max_record_bytes:
                yield at, None, "record too large"
                return
            # In pieces: what is left of the last one after the frame is copied.
            while not one.eof and end < len(view):
                parts.append(one.decompress(view[end : end + _PIECE]))
                end = min(end + _PIECE, len(view))
                decoded += len(parts[-1])
                if decoded > max_record_bytes:
                    yield at, None, "record too large"
                    return
        except zstd.ZstdError as broken:
            yield at, None, f"bad frame: {broken}"
            return
        if not one.eof:
            yield at, None, "truncated frame"
            return
        yield at, b"".join(parts), None
        at = end - len(one.unused_data)


def _dictionary(content: bytes) -> zstd.ZstdCompressionDict:
    if content[:4] == struct.pack("<I", FRAME_MAGIC):
        content = zstd.ZstdDecompressor().decompressobj().decompress(content)
    return zstd.ZstdCompressionDict(content)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes, str | None]:
    """Headers (names in lower case), block, and the first rule that is broken."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not gap:
        return {}, b"", "no end of headers"
    if not first.startswith(b"WARC/1."):
        return {}, b"", "no WARC version line"
    headers: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if not colon or not name.strip():
            return headers, b"", "header without a name"
        headers[name.strip().lower()] = value.strip()
    for name in REQUIRED:
        if name not in headers:
            return headers, b"", f"no {name}"
    if headers["warc-type"] not in TYPES:
        return headers, b"", "unknown record type"
    length = headers["content-length"]
    if not length.isascii() or not length.isdigit():
        return headers, b"", "content-length is no number"
    if len(rest) != int(length) + 4 or rest[-4:] != b"\r\n\r\n":
        return headers, b"", "content-length does not fit the record"
    return headers, rest[:-4], None


def payload_of(headers: dict[str, str], block: bytes) -> bytes:
    """The block without the HTTP head, where it has one."""
    if headers.get("content-type", "").startswith("application/http"):
        return block.partition(b"\r\n\r\n")[2]
    return block


# -- Spark -----------------------------------------------------------------------


def with_revisits(
    pages: DataFrame, id_col: str, payload_col: str, min_bytes: int
) -> DataFrame:
    """Id, url and payload with their digest and, for a revisit, the id it refers to."""
    text = F.coalesce(F.col(f"`{payload_col}`"), F.lit(""))
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        text.cast("binary").alias("payload"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    first = (
        pages.select(
            F.col(f"`{id_col}`").cast("long").alias("page_id"),
            F.unhex(F.sha2(text, 256)).alias("_digest"),
            F.octet_length(text).alias("size"),
        )
        .filter(F.col("size") >= min_bytes)
        .groupBy("_digest")
        .agg(F.min("page_id").alias("_first"), F.count(F.lit(1)).alias("_rows"))
        .filter("_rows > 1")
    )
    later = ~F.col("page_id").eqNullSafe(F.col("_first")) & F.col("_first").isNotNull()
    return rows.join(first, F.col("digest") == F.col("_digest"), "left").select(
        "page_id", "url", "payload", "digest", F.when(later, F.col("_first")).alias("refers_to")
    )


def _writer(
    date: str, dictionary_bytes: int, sample_bytes: int, level: int, archive_bytes: int
) -> Callable:
    def build(page_id, url, payload: bytes, digest: bytes, refers_to) -> bytes:
        kind = "response" if refers_to is None else "revisit"
        headers = [
            ("WARC-Type", kind),
            ("WARC-Record-ID", _urn(page_id)),
            ("WARC-Date", date),
            # A header is one line; line ends in a URL are written as URLs write them.
            ("WARC-Target-URI", (url or "").replace("\r", "%0D").replace("\n", "%0A")),
            ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", f"sha256:{digest.hex()}"),
            ("X-Payload-Length", str(len(payload))),
        ]
        http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
        if refers_to is not None:
            headers.append(("WARC-Refers-To", _urn(refers_to)))
            headers.append(("WARC-Profile", REVISIT_PROFILE))
            return record_bytes(headers, http)
        return record_bytes(headers, http + payload)

    def archive(records: Iterator[bytes]) -> Iterator[bytes]:
        """Frames of one archive, until it is full or no record is left."""
        # The dictionary is learned from the first records of this archive.
        sample, held = [], 0
        for record in records:
            sample.append(record)
            held += len(record)
            if held >= min(sample_bytes, archive_bytes):
                break
        if not sample:
            return
        learned = train_dictionary([r[:65536] for r in sample], dictionary_bytes)
        written = 0
        if learned:
            yield dictionary_frame(learned) + _LINE_END_FRAME
        data = zstd.ZstdCompressionDict(learned) if learned else None
        compressor = zstd.ZstdCompressor(level=level, dict_data=data)
        for record in sample:
            yield (frame := compressor.compress(record) + _LINE_END_FRAME)
            written += len(frame)
        while written < archive_bytes and (record := next(records, None)) is not None:
            yield (frame := compressor.compress(record) + _LINE_END_FRAME)
            written += len(frame)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = (
            build(*row)
            for batch in batches
            for row in zip(*(c.to_pylist() for c in batch.columns))
        )
        number, out, size = 0, [], 0

        def packed() -> pa.RecordBatch:
            places, at, frames = zip(*out)
            types = (pa.int32(), pa.int64(), pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip((places, at, frames), types)],
                names=["archive", "position", "frame"],
            )

        while True:
            count = 0
            for count, frame in enumerate(archive(records), 1):
                out.append((number, count, frame))
                size += len(frame)
                if size > 4_000_000:
                    yield packed()
                    out, size = [], 0
            if not count:
                break
            number += 1
        if out:
            yield packed()

    return run


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{_NO_ID if page_id is None else page_id}>"


def write_warc(
    pages: DataFrame,
    path: str,
    id_col: str = "page_id",
    payload_col: str = "html",
    min_revisit_bytes: int = 100,
    date: str = "2024-01-01T00:00:00Z",
    dictionary_bytes: int = 16 << 10,
    sample_bytes: int = 1 << 20,
    level: int = 3,
    archive_bytes: int = 256 << 20,
) -> None:
    """Writes archives of about ``archive_bytes`` each, one record per row.

    A partition fills one archive after the other, each with a dictionary of its own;
    only a single record can make one much larger. They lie in folders by their number
    in the partition.

    Null payloads count as empty. Of rows with one payload of at least
    ``min_revisit_bytes`` those with the smallest id are responses and all others
    revisit them; a null id ranks last, and a group without any id is all responses.
    The dictionary is learned from an archive's first ``sample_bytes``, at most 64 KB
    of a record; an archive too small for that has none. An empty table gives no record.
    Only id, ``url`` and payload are read.
    """
    rows = with_revisits(pages, id_col, payload_col, min_revisit_bytes)
    run = _writer(date, dictionary_bytes, sample_bytes, level, archive_bytes)
    frames = rows.mapInArrow(run, "archive int, position long, frame binary")
    (
        # In the order of the archive, which the writer needs of its folders anyway.
        frames.sortWithinPartitions("archive", "position")
        .select(F.col("frame").cast("string"), "archive")
        .write.mode("overwrite")
        .partitionBy("archive")
        .option("compression", "none")
        .option("lineSep", "\n")
        .option("maxRecordsPerFile", 0)
        .text(path)
    )


_READ = (
    "archive string, position long, record_type string, record_id string, "
    "refers_to_id string, target_uri string, headers map<string,string>, payload binary, "
    "payload_bytes long, payload_digest string, error string"
)


def _reader(keep_payload: bool, max_record_bytes: int) -> Callable:
    def row(archive: str, at: int, record: bytes | None, error: str | None) -> tuple:
        headers: dict[str, str] = {}
        block = b""
        if error is None:
            headers, block, error = parse_record(record)
        payload = payload_of(headers, block)
        kind = headers.get("warc-type")
        said = headers.get("warc-payload-digest", "").removeprefix("sha256:")
        if kind == "revisit":
            length, digest = headers.get("x-payload-length", ""), said
            size = int(length) if length.isascii() and length.isdigit() else None
            if error is None and "warc-refers-to" not in headers:
                error = "revisit without warc-refers-to"
        else:
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            if error is None and said and said != digest:
                error = "payload does not fit its digest"
        return (
            archive, at, kind, headers.get("warc-record-id"),
            headers.get("warc-refers-to"), headers.get("warc-target-uri"),
            list(headers.items()), payload if keep_payload else None,
            size, digest, error,
        )

    types = pa.schema(
        [
            ("archive", pa.string()),
            ("position", pa.int64()),
            ("record_type", pa.string()),
            ("record_id", pa.string()),
            ("refers_to_id", pa.string()),
            ("target_uri", pa.string()),
            ("headers", pa.map_(pa.string(), pa.string())),
            ("payload", pa.binary()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("error", pa.string()),
        ]
    )

    def packed(rows: list) -> pa.RecordBatch:
        arrays = [pa.array(v, f.type) for v, f in zip(zip(*rows), types)]
        return pa.RecordBatch.from_arrays(arrays, schema=types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                archive = batch.column(0)[k].as_py()
                rows, held = [], 0
                content = batch.column(1)[k].as_py()
                for at, record, error in read_frames(content, max_record_bytes):
                    rows.append(row(archive, at, record, error))
                    held += len(rows[-1][7] or b"") + 500
                    if held > 4_000_000:
                        yield packed(rows)
                        rows, held = [], 0
                if rows:
                    yield packed(rows)

    return run


def read_warc(
    spark: SparkSession,
    path: str,
    keep_payload: bool = True,
    max_archive_bytes: int = 1 << 30,
    max_record_bytes: int = MAX_RECORD_BYTES,
) -> DataFrame:
    """One row per frame of the archives under ``path``, bad ones with their ``error``.

    Checked are frames, version line, header lines, required headers, record type,
    length and payload digest. Size and digest are those of the decoded payload; a
    revisit repeats those of the record it refers to. Spark reads a binary file as one
    value, so one above ``max_archive_bytes`` stops the job; ``write_warc`` makes none.
    A folder without archives, and an empty file, give no rows.
    """
    files = spark.read.format("binaryFile").load(path)
    too_large = F.concat(F.lit("archive is too large: "), F.col("path"))
    content = F.when(F.col("length") > max_archive_bytes, F.raise_error(too_large))
    return files.select("path", content.otherwise(F.col("content")).alias("content")).mapInArrow(
        _reader(keep_payload, max_record_bytes), _READ
    )


def page_id_of(record_id) -> F.Column:
    """The id that ``write_warc`` put into a record id; null if the page had none."""
    found = F.regexp_extract(record_id, "^<urn:page:(-?[0-9]+)>$", 1)
    return F.when(found != "", found.cast("long"))
