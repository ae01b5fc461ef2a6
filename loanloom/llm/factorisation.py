"""Quality classifier: a factorisation machine over hashed words and structure.

The score adds a weight per feature and, for every pair of features, the product of
their low-rank vectors. The pair sum needs no pairs: per rank it is half of the squared
sum minus the sum of squares, so a text is scored in time linear in its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import WORD, checkpointed, training_row

#: Hashed words take the features from ``STRUCTURE`` on.
WORD_BUCKETS = 1 << 14
PUNCTUATION = ".,;:!?'\"()[]{}<>|/\\@#$%&*+-=_~^`"
STRUCTURE = 16 + len(PUNCTUATION)
FEATURES = STRUCTURE + WORD_BUCKETS


# -- features --------------------------------------------------------------------


def structure(text: str, words: list[str], counts: Counter, metadata: float | None) -> list[float]:
    """Shares and logarithms that describe a text's form, about 0 to 1 each."""
    raw = text.encode("utf-8", "replace")
    by_byte = np.bincount(np.frombuffer(raw, np.uint8), minlength=256).astype(float)
    size, n = max(len(raw), 1), max(len(words), 1)
    lower, upper = by_byte[97:123].sum(), by_byte[65:91].sum()
    lines = text.split("\n")
    repeats = sum(map(str.__eq__, words, words[1:]))
    return [
        1.0,
        np.log1p(len(words)) / 10,
        min(len(raw) / n / 20, 3.0),
        (lower + upper) / size,
        upper / max(lower + upper, 1),
        by_byte[48:58].sum() / size,
        (by_byte[9:14].sum() + by_byte[32]) / size,
        by_byte[128:].sum() / size,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        repeats / n,
        np.log1p(len(lines)) / 8,
        1 - len(set(lines)) / len(lines),
        0.0 if words else 1.0,
        0.0 if metadata is None else np.log1p(max(metadata, 0.0)) / 12,
        1.0 if metadata is None else 0.0,
        *(min(4 * float(np.sqrt(by_byte[ord(c)] / size)), 3.0) for c in PUNCTUATION),
    ]


def features(text: str | None, metadata: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values; the words' values have length one together."""
    text = text or ""
    words = re.findall(WORD, text.lower())
    counts = Counter(words)
    stats = structure(text, words, counts, metadata)
    hashed = [STRUCTURE + xxhash.xxh32_intdigest(w) % WORD_BUCKETS for w in counts]
    values = np.log1p(np.fromiter(counts.values(), float, len(counts)))
    if len(values):
        values /= np.sqrt((values**2).sum())
    index = np.concatenate([np.arange(STRUCTURE), np.array(hashed, np.int64)])
    return index.astype(np.int64), np.concatenate([stats, values])


# -- the machine -----------------------------------------------------------------


class Machine(NamedTuple):
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, index: np.ndarray, values: np.ndarray) -> float:
        scaled = self.factors[index] * values[:, None]
        pairs = 0.5 * (scaled.sum(axis=0) ** 2 - (scaled**2).sum(axis=0)).sum()
        raw = self.bias + self.weights[index] @ values + pairs
        return float(1 / (1 + np.exp(-np.clip(raw, -500, 500))))


def train(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    rank: int = 8,
    epochs: int = 12,
    rate: float = 0.1,
    decay: float = 1e-5,
    batch: int = 64,
    seed: int = 7,
) -> Machine:
    """Logistic loss, gradient steps scaled per feature. One class only: its share."""
    share = float(labels.mean()) if len(labels) else 0.5
    clipped = min(max(share, 0.01), 0.99)
    bias = float(np.log(clipped / (1 - clipped)))
    weights = np.zeros(FEATURES)
    draw = np.random.default_rng(seed)
    factors = draw.normal(0, 0.02, (FEATURES, rank))
    if share in (0.0, 1.0) or not len(labels):
        return Machine(bias, weights, np.zeros((FEATURES, rank)))
    seen_w = np.full(FEATURES, 1e-2)
    seen_f = np.full((FEATURES, rank), 1e-2)
    seen_b = 1e-2
    for _ in range(epochs):
        order = draw.permutation(len(rows))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            index = np.concatenate([rows[i][0] for i in chosen])
            values = np.concatenate([rows[i][1] for i in chosen])
            sizes = [len(rows[i][0]) for i in chosen]
            row = np.repeat(np.arange(len(chosen)), sizes)
            starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            scaled = factors[index] * values[:, None]
            sums = np.add.reduceat(scaled, starts)
            pairs = 0.5 * (sums**2 - np.add.reduceat(scaled**2, starts)).sum(axis=1)
            raw = bias + np.add.reduceat(weights[index] * values, starts) + pairs
            wrong = 1 / (1 + np.exp(-np.clip(raw, -500, 500))) - labels[chosen]
            pull = (wrong / len(chosen))[row] * values
            step_w = np.bincount(index, pull, FEATURES)
            touched = np.unique(index)
            step_f = np.zeros((FEATURES, rank))
            np.add.at(step_f, index, pull[:, None] * (sums[row] - scaled))
            step_w = step_w[touched] + decay * weights[touched]
            step_f = step_f[touched] + decay * factors[touched]
            seen_w[touched] += step_w**2
            seen_f[touched] += step_f**2
            weights[touched] -= rate * step_w / np.sqrt(seen_w[touched])
            factors[touched] -= rate * step_f / np.sqrt(seen_f[touched])
            step_b = float(wrong.mean())
            seen_b += step_b**2
            bias -= rate * step_b / seen_b**0.5
    return Machine(bias, weights, factors)


# -- Spark -----------------------------------------------------------------------


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    metadata_col: str = "n_chars",
    label_col: str = "quality",
    max_rows: int = 6000,
) -> Machine:
    """A machine from at most ``max_rows`` labelled documents, those first by a hash.

    Ids whose crc32 modulo 3 is 1 are never learned from. An id with several labels
    takes their rounded mean, one with several texts the smallest. Null labels and ids,
    and ids without a document, are left out; without any label every score is 0.5.
    """
    present = docs.select(F.col(f"`{id_col}`").cast("long").alias("own")).distinct()
    wanted = (
        labels.filter(F.col(f"`{label_col}`").isNotNull() & training_row(F.col(f"`{id_col}`")))
        .groupBy(F.col(f"`{id_col}`").cast("long").alias("id"))
        .agg(F.round(F.avg(f"`{label_col}`")).cast("int").alias("label"))
        .join(present, F.col("id") == F.col("own"), "left_semi")
        .orderBy(F.xxhash64("id"), "id")
        .limit(max_rows)
    )
    # At most max_rows pairs of numbers: small enough for every executor.
    wanted = F.broadcast(checkpointed(wanted))
    sample = (
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc"),
            F.col(f"`{text_col}`").cast("string").alias("text"),
            _metadata(docs, metadata_col).alias("metadata"),
        )
        .join(wanted, F.col("doc") == F.col("id"))
        .groupBy("doc", "label")
        .agg(F.min(F.struct("text", "metadata")).alias("row"))
        .select("doc", "label", "row.text", "row.metadata")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, label, text, metadata = (c.to_pylist() for c in batch.columns)
            found = [features(t, m) for t, m in zip(text, metadata)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(doc, pa.int64()),
                    pa.array(label, pa.int32()),
                    pa.array([f[0] for f in found], pa.list_(pa.int64())),
                    pa.array([f[1] for f in found], pa.list_(pa.float64())),
                ],
                names=["doc", "label", "index", "values"],
            )

    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [
            (doc, label, np.array(i.as_py(), np.int32), np.array(v.as_py(), np.float64))
            for batch in batches
            for doc, label, i, v in zip(*(c if n > 1 else c.to_pylist() for n, c in enumerate(batch.columns)))
        ]
        found.sort(key=lambda row: row[0])
        machine = train([row[2:] for row in found], np.array([row[1] for row in found], float))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([machine.bias]),
                pa.array([machine.weights.tobytes()]),
                pa.array([machine.factors.tobytes()]),
            ],
            names=["bias", "weights", "factors"],
        )

    schema = "doc long, label int, index array<long>, values array<double>"
    # The sample is bounded, so one task may hold it; the driver gets the machine alone.
    found = sample.mapInArrow(run, schema).repartition(1)
    models = found.mapInArrow(trained, "bias double, weights binary, factors binary").collect()
    if not models:
        return train([], np.zeros(0))
    bias, weights, factors = models[0]
    return Machine(
        bias, np.frombuffer(weights), np.frombuffer(factors).reshape(FEATURES, -1)
    )


def _metadata(docs: DataFrame, name: str) -> Column:
    return F.col(f"`{name}`").cast("double") if name in docs.columns else F.lit(None).cast("double")


def quality_score(
    docs: DataFrame,
    machine: Machine,
    text_col: str = "text",
    metadata_col: str = "n_chars",
) -> Column:
    """Score 0 to 1 of each row; null texts count as empty."""
    # Fixed size: features times rank.
    shared = docs.sparkSession.sparkContext.broadcast(tuple(machine))

    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        own = Machine(*shared.value)
        for texts, metadata in batches:
            yield pa.array(
                [
                    own.score(*features(t.as_py(), m.as_py()))
                    for t, m in zip(texts, metadata)
                ],
                pa.float64(),
            )

    run.__annotations__ = {
        "batches": Iterator[tuple[pa.Array, pa.Array]],
        "return": Iterator[pa.Array],
    }
    return F.arrow_udf(run, "double")(
        F.col(f"`{text_col}`").cast("string"), _metadata(docs, metadata_col)
    )


def good_documents(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    metadata_col: str = "n_chars",
    max_rows: int = 6000,
) -> DataFrame:
    """The rows that score 0.5 or more, with their columns as they are.

    The score stands beside the row, so that columns of any name keep their values.
    """
    machine = fit(docs, labels, id_col, text_col, metadata_col, max_rows=max_rows)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    score = quality_score(docs, machine, text_col, metadata_col)
    return docs.select(row.alias("row"), score.alias("score")).where("score >= 0.5").select("row.*")


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    metadata_col: str = "n_chars",
    max_rows: int = 6000,
) -> DataFrame:
    """All rows and columns with ``score`` and ``predicted`` (1 from 0.5 on).

    The score depends on the text and, where there is one, the length column alone; ids,
    sources and labels never enter it. Columns of the two names are replaced. An empty
    table gives no rows.
    """
    machine = fit(docs, labels, id_col, text_col, metadata_col, max_rows=max_rows)
    score = quality_score(docs, machine, text_col, metadata_col)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    scored = docs.select(F.struct(*kept).alias("row"), score.alias("score"))
    return scored.select(
        "row.*", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted")
    )
