"""Language identification of mixed texts, word by word.

A word's script leaves only the languages that are written in it. Its letter n-grams
give each of those a score, and Viterbi's algorithm with a penalty for switching finds
the best sequence of languages over the text's words. Runs of one language are spans;
the text's language is the one with most letters.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanloom.llm.common import checkpointed, training_row

UNDECIDED = "und"
#: A run of letters and of numbers that are no digits, such as fractions.
_WORDS = re.compile(r"[^\W\d_]+")

# First code point of each stretch of letters and its script.
SCRIPTS = (
    (0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"),
    (0x0980, "other"), (0x0E00, "thai"), (0x0E80, "other"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
    (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x2DE0, "cyrillic"),
    (0x2E00, "other"), (0x3040, "kana"), (0x3100, "han"), (0x3130, "hangul"),
    (0x3190, "han"), (0xA000, "other"), (0xA640, "cyrillic"), (0xA6A0, "other"),
    (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "latin"), (0xFB10, "other"), (0xFB50, "arabic"),
    (0xFE00, "other"), (0xFE70, "arabic"), (0xFF00, "latin"), (0xFF66, "kana"),
    (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other"),
)
NAMES = sorted({name for _, name in SCRIPTS})

#: n-grams of these lengths, hashed into this many buckets each; into half as many, and
#: again, where a model of all languages would exceed its bytes.
ORDERS, BITS, LEAST_BITS, MODEL_BYTES = (1, 2, 3, 4), 14, 10, 128 << 20
#: A language owns a script that holds at least this share of its letters.
SCRIPT_SHARE = 0.02
SWITCH_PENALTY = 12.0
#: Words worked at once; words whose scores are remembered, and the scores' bytes.
WORDS_AT_ONCE, REMEMBERED, REMEMBERED_BYTES = 400_000, 300_000, 64 << 20

_FIRST = [first for first, _ in SCRIPTS]
_SCRIPT = [NAMES.index(name) for _, name in SCRIPTS]


def script_of(letter: str) -> int:
    return _SCRIPT[bisect_right(_FIRST, ord(letter)) - 1]


def letter_runs(text: str) -> list[str]:
    """The words of a text: its runs of letters, and of nothing but letters."""
    found = _WORDS.findall(text)
    if all(map(str.isalpha, found)):
        return found
    spaced = ("".join(c if c.isalpha() else " " for c in word) for word in found)
    return [part for word in spaced for part in word.split()]


def model_bits(languages: int) -> int:
    """Bits of a bucket with so many languages."""
    bits = BITS
    while bits > LEAST_BITS and (len(ORDERS) << bits) * languages * 4 > MODEL_BYTES:
        bits -= 1
    return bits


def gram_buckets(words: list[str], bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Per character of the words, joined by line feeds, one bucket per n-gram order.

    Returns (characters, orders) and each word's first row. The line feed before and
    after a word marks its ends; n-grams that reach over one get the empty bucket.
    """
    buckets = 1 << bits
    codes = np.frombuffer(("\n" + "\n".join(words) + "\n").encode("utf-32-le"), np.uint32)
    codes = codes.astype(np.uint64)
    breaks = codes == 10
    starts = np.flatnonzero(breaks)[:-1]
    lanes = len(codes) - 1
    rows = np.empty((lanes, len(ORDERS)), np.int64)
    for column, n in enumerate(ORDERS):
        mixed = np.zeros(lanes, np.uint64)
        whole = np.ones(lanes, bool)
        padded = np.concatenate([codes, np.full(n, 10, np.uint64)])
        stops = np.concatenate([breaks, np.ones(n, bool)])
        for k in range(n):
            mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + padded[k : k + lanes]
            mixed ^= mixed >> np.uint64(29)
            if 0 < k < n - 1:
                whole &= ~stops[k : k + lanes]
        if n == 1:
            whole &= ~breaks[:lanes]
        elif n > 1:
            # Not the two ends of neighbouring words alone.
            whole &= ~(stops[:lanes] & stops[n - 1 : n - 1 + lanes] & (n == 2))
        bucket = (mixed * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)
        rows[:, column] = np.where(
            whole, bucket.astype(np.int64) + column * buckets, len(ORDERS) * buckets
        )
    return rows, starts


class Model:
    """Log-shares of n-grams per language, and the languages of each script."""

    def __init__(self, languages: list[str], weights: np.ndarray, allowed: np.ndarray):
        self.languages, self.weights, self.allowed = languages, weights, allowed
        self.bits = (len(weights) // len(ORDERS)).bit_length() - 1

    def word_scores(self, words: list[str]) -> np.ndarray:
        rows, starts = gram_buckets(words, self.bits)
        total = self.weights[rows[:, 0]]
        for column in range(1, rows.shape[1]):
            total = total + self.weights[rows[:, column]]
        scores = np.add.reduceat(total, starts, axis=0)
        scripts = np.array([script_of(w[0]) for w in words])
        return np.where(self.allowed[scripts], scores, scores - 1e4)


def learned(counts: pa.Table, letters: pa.Table, bits: int = BITS) -> Model | None:
    """A model from (lang, bucket, n) and (lang, script, n); None without languages."""
    buckets = 1 << bits
    languages = sorted(set(letters["lang"].to_pylist()))
    if not languages:
        return None
    at = {lang: i for i, lang in enumerate(languages)}
    table = np.full((len(ORDERS) * buckets + 1, len(languages)), 0.5, np.float32)
    lang = np.array([at[x] for x in counts["lang"].to_pylist()], np.int64)
    table[counts["bucket"].to_numpy(), lang] += counts["n"].to_numpy()
    for order in range(len(ORDERS)):
        part = slice(order * buckets, (order + 1) * buckets)
        table[part] = np.log(table[part] / table[part].sum(axis=0))
    table[-1] = 0
    # Only differences between languages matter.
    table -= table.mean(axis=1, keepdims=True)
    owned = np.zeros((len(NAMES), len(languages)))
    for name, script, n in zip(*(letters[c].to_pylist() for c in ("lang", "script", "n"))):
        owned[script, at[name]] += n
    allowed = owned >= SCRIPT_SHARE * np.maximum(owned.sum(axis=0), 1)
    # A script that nobody owns narrows nothing.
    allowed[~allowed.any(axis=1)] = True
    return Model(languages, table.astype(np.float32), allowed)


# -- Viterbi ---------------------------------------------------------------------


def best_paths(
    scores: np.ndarray, words: np.ndarray, starts: np.ndarray, penalty: float
) -> np.ndarray:
    """Best language of every word; texts follow one another, ``starts`` their words.

    ``words`` are rows of ``scores``. All texts advance together, one word a step, the
    longest first. Of the way back a word takes one bit a language: whether it stayed
    or came from the best of the word before.
    """
    total, languages = len(words), scores.shape[1]
    sizes = np.diff(np.append(starts, total))
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] > 0]
    first, size = starts[order], sizes[order]
    steps = int(size[0]) if len(size) else 0
    # Texts still running at each step.
    running = np.searchsorted(-size, -np.arange(1, steps + 1), side="right")
    stayed = np.empty((total, (languages + 7) // 8), np.uint8)
    came = np.empty(total, np.int32)
    best = np.zeros((len(first), languages))
    for t in range(steps):
        n = running[t]
        at = first[:n] + t
        if t == 0:
            best[:n] = scores[words[at]]
            continue
        before = best[:n]
        top = before.argmax(axis=1)
        switched = before[np.arange(n), top] - penalty
        stay = before >= switched[:, None]
        stayed[at] = np.packbits(stay, axis=1)
        came[at] = top
        best[:n] = np.where(stay, before, switched[:, None]) + scores[words[at]]
    path = np.empty(total, np.int32)
    state = best.argmax(axis=1)
    for t in range(steps - 1, -1, -1):
        n = running[t]
        at = first[:n] + t
        now = state[:n]
        path[at] = now
        if t:
            same = stayed[at, now >> 3] >> (7 - (now & 7)) & 1
            state[:n] = np.where(same == 1, now, came[at])
    return path


class Labeller:
    """Languages of texts, with the scores of frequent words remembered."""

    def __init__(self, model: Model, penalty: float):
        self.model, self.penalty = model, penalty
        self.known: dict[str, int] = {}
        self.scores = np.zeros((0, len(model.languages)), np.float32)

    def label(self, texts: list[str]) -> Iterator[tuple[str, float, str]]:
        """Language, its share of letters, and spans as lang:first word:end word."""
        found = [letter_runs(t) for t in texts]
        words = [w.lower() for f in found for w in f]
        new = list(set(words).difference(self.known))
        held = min(REMEMBERED, REMEMBERED_BYTES // (4 * len(self.model.languages)))
        if len(self.known) + len(new) > held and self.known:
            self.known, self.scores = {}, self.scores[:0]
            new = list(set(words))
        if new:
            for i, w in enumerate(new, len(self.known)):
                self.known[w] = i
            self.scores = np.concatenate([self.scores, self.model.word_scores(new)])
        rows = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        sizes = np.array([len(f) for f in found], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        path = best_paths(self.scores, rows, starts, self.penalty)
        letters = np.fromiter(map(len, words), np.int64, len(words))
        names = self.model.languages
        for start, size in zip(starts.tolist(), sizes.tolist()):
            if not size:
                yield UNDECIDED, 0.0, ""
                continue
            own = path[start : start + size]
            share = np.bincount(own, letters[start : start + size], len(names))
            top = int(share.argmax())
            cuts = np.flatnonzero(np.diff(own)) + 1
            edges = [0, *cuts.tolist(), size]
            spans = ",".join(
                f"{names[own[a]]}:{a}:{b}" for a, b in zip(edges, edges[1:])
            )
            yield names[top], float(share[top] / share.sum()), spans


# -- Spark -----------------------------------------------------------------------


def fit(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    rows_per_language: int = 600,
    most_broadcast: int = 1_000_000,
) -> Model | None:
    """A model of every language from at most ``rows_per_language`` texts of each.

    These are the first by a hash of the id. Ids whose crc32 modulo 3 is 1, null ids and
    null languages are never learned from. The model has four bytes per language and
    bucket; with hundreds of languages buckets get fewer, languages never.
    """
    usable = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    ).filter(F.col("lang").isNotNull() & training_row(F.col("id")))
    order = [F.xxhash64("id"), F.col("id")]
    # First by piece of a language, so that no task ranks the whole of a frequent one.
    piece = Window.partitionBy("lang", "piece").orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    chosen = checkpointed(
        usable.distinct()
        .withColumn("piece", F.pmod(F.xxhash64("id"), F.lit(64)))
        .withColumn("nth", F.row_number().over(piece))
        .filter(F.col("nth") <= rows_per_language)
        .withColumn("nth", F.row_number().over(whole))
        .filter(F.col("nth") <= rows_per_language)
        .select("id", "lang")
    )
    rows, languages = chosen.agg(F.count("*"), F.count_distinct("lang")).first()
    bits = model_bits(languages)
    # Rows per language times languages; beyond the bound the join shuffles.
    if rows <= most_broadcast:
        chosen = F.broadcast(chosen)
    sample = (
        docs.select(
            F.col(f"`{id_col}`").cast("long").alias("doc"),
            F.col(f"`{text_col}`").cast("string").alias("text"),
            F.col(f"`{lang_col}`").cast("string").alias("own"),
        )
        .join(chosen, (F.col("doc") == F.col("id")) & (F.col("own") == F.col("lang")))
        .groupBy("doc", "lang")
        .agg(F.min("text").alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [w.lower() for w in letter_runs(text or "")]
                if not words:
                    continue
                rows, _ = gram_buckets(words, bits)
                buckets, n = np.unique(rows, return_counts=True)
                whole = buckets < len(ORDERS) << bits
                buckets, n = buckets[whole], n[whole]
                scripts = np.zeros(len(NAMES), np.int64)
                for w in words:
                    scripts[script_of(w[0])] += len(w)
                held = np.flatnonzero(scripts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * (len(buckets) + len(held))),
                        pa.array(np.concatenate([buckets, -1 - held])),
                        pa.array(np.concatenate([n, scripts[held]])),
                    ],
                    names=["lang", "bucket", "n"],
                )

    counted = (
        sample.select("lang", "text")
        .mapInArrow(run, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toArrow()
    )
    # Scripts travel as negative buckets.
    below = np.array(counted["bucket"].to_pylist(), np.int64) < 0
    letters = counted.filter(pa.array(below))
    letters = letters.append_column(
        "script", pa.array(-1 - np.array(letters["bucket"].to_pylist(), np.int64))
    )
    return learned(counted.filter(pa.array(~below)), letters, bits)


def identify_languages(
    docs: DataFrame,
    model: Model | None,
    id_col: str = "doc_id",
    text_col: str = "text",
    penalty: float = SWITCH_PENALTY,
) -> DataFrame:
    """Per row ``doc_id, lang_pred, score, spans``.

    The score is the share of letters in spans of the language; equal shares go to the
    language first by code point. Spans are language, first word and end word, words
    being runs of letters. Null texts and texts without a letter are ``und`` with score
    0 and no spans, and so is all without a model. Rows stay as many as they are, null
    ids too; an empty table gives no rows; other columns are not looked at.
    """
    known = model and (model.languages, model.weights, model.allowed)
    # Fixed size: n-gram buckets times at most the model's languages.
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(Model(*shared.value), penalty) if shared.value else None

        def labelled(ids: list, texts: list[str]) -> pa.RecordBatch:
            if labeller:
                found = list(labeller.label(texts))
            else:
                found = [(UNDECIDED, 0.0, "")] * len(texts)
            lang, score, spans = zip(*found)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(lang), pa.array(score), pa.array(spans)],
                names=["doc_id", "lang_pred", "score", "spans"],
            )

        ids, texts, held = [], [], 0
        for batch in batches:
            for row_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or ""
                ids.append(row_id.as_py())
                texts.append(text)
                held += len(text)
                # About six characters a word.
                if held > 6 * WORDS_AT_ONCE:
                    yield labelled(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield labelled(ids, texts)

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, spans string")
