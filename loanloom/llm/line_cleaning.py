"""Line-first cleaning.

Each line of a text is judged alone by rules of punctuation, navigation and boilerplate;
lines that fail go. A text that loses too much of itself with them is no document worth
keeping. Counts of the whole text stand beside it: words, symbols, repeated lines and
words in repeated windows.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import WORD

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
#: Fewer words, or more than this share of words in repeated windows, fail a text.
LEAST_WORDS, MOST_REPEATED = 20, 30
WINDOW = 8

# What ends a sentence and may stand behind it, punctuation, separators.
ENDS = ".!?…:;。！？।؟"
CLOSERS = "\"'”’“»›)]"
PUNCTUATION = string.punctuation + "¡¿«»„“”‘’…–—•·›‹©®™、。，！？"
SEPARATORS = "|»›•·→←"
#: Words of menus, and phrases of notices.
MENU = frozenset(
    "home menu login logout register search next previous prev back top more contact about "
    "help faq sitemap share print email tweet follow subscribe comments reply tags archive "
    "archives categories rss up down skip to content main navigation toggle close us in sign "
    "out read page start startseite suche kontakt impressum hilfe weiter zurück anmelden "
    "accueil recherche aide suivant précédent connexion inicio buscar contacto ayuda "
    "siguiente anterior".split()
)
PHRASES = (
    "all rights reserved",
    "copyright ©",
    "© copyright",
    "alle rechte vorbehalten",
    "tous droits réservés",
    "todos los derechos reservados",
    "privacy policy",
    "terms of use",
    "terms of service",
    "terms and conditions",
    "cookie policy",
    "use of cookies",
    "uses cookies",
    "accept cookies",
    "enable javascript",
    "javascript is disabled",
    "lorem ipsum",
    "powered by",
    "sign up for our newsletter",
    "subscribe to our newsletter",
    "click here",
    "licensed under the",
    "permission is hereby granted, free of charge",
    "spdx-license-identifier",
)
#: Punctuation fails a line from so many marks on, above a fifth of its characters.
MARKS = 4
#: An unfinished line of so many words goes on in a next line in lower case.
CONTINUED = 5
#: Navigation: separators, words to each of them, and words of a line of menu words.
BARS, WORDS_TO_A_BAR, MENU_WORDS = 2, 6, 6
#: Longer lines may mention a notice's phrase.
NOTICE_WORDS = 40
#: Tenths of its characters that a document may lose.
MOST_LOST = 3
WORDS_AT_ONCE = 300_000

_WORDS = re.compile(WORD)
_FINISHED = re.compile(rf"[{re.escape(ENDS)}][{re.escape(CLOSERS)}]*{SPACE}*\Z")
_MARKS = re.compile(f"[{re.escape(PUNCTUATION + SEPARATORS)}]")
_NO_MARKS = {ord(c): None for c in PUNCTUATION}
#: White space to ``str.split`` that is part of a word here.
_IN_WORDS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def has_notice(text: str) -> bool:
    low = text.lower()
    return any(phrase in low for phrase in PHRASES)


def line_fault(line: str, words: list[str], following: str) -> str | None:
    """The rule that a line with words breaks: punctuation, navigation or boilerplate."""
    found = _MARKS.findall(line)
    bars = sum(c in SEPARATORS for c in found)
    if bars >= BARS and len(words) <= WORDS_TO_A_BAR * bars:
        return "navigation"
    if len(words) <= MENU_WORDS:
        bare = {w.translate(_NO_MARKS).lower() for w in words} - {""}
        if bare and bare <= MENU:
            return "navigation"
    if len(words) <= NOTICE_WORDS and has_notice(line):
        return "boilerplate"
    marks = sum(c in PUNCTUATION for c in found)
    if marks >= MARKS and 5 * marks > sum(map(len, words)):
        return "punctuation"
    if found and found[-1] in ENDS and line[-1] == found[-1]:
        return None
    if not _FINISHED.search(line):
        goes_on = len(words) >= CONTINUED and following and category(following[0]) == "Ll"
        if not goes_on:
            return "punctuation"
    return None


@dataclass
class Cleaned:
    """A text's counts and the lines that stay; lines without words stay as they are."""

    word_chars: int
    n_symbols: int
    n_dup_lines: int
    faults: dict[str, int]
    lost_chars: int
    text: str


def clean_text(text: str) -> tuple[list[str], Cleaned]:
    """All words of a text, and what line-first cleaning makes of it."""
    lines = text.split("\n")
    words_of = _WORDS.findall if _IN_WORDS.search(text) else str.split
    split = [words_of(line) for line in lines]
    words = [w for of_line in split for w in of_line]
    seen: set[str] = set()
    repeated = lost = 0
    faults = dict.fromkeys(("punctuation", "navigation", "boilerplate"), 0)
    stay = [True] * len(lines)
    following = ""
    # From the end, so that each line knows the next one with words.
    for at in reversed(range(len(lines))):
        if not split[at]:
            continue
        fault = line_fault(lines[at], split[at], following)
        following = split[at][0]
        if fault:
            faults[fault] += 1
            lost += sum(map(len, split[at]))
            stay[at] = False
    for line, of_line in zip(lines, split):
        if of_line:
            repeated += line in seen
            seen.add(line)
    cleaned = Cleaned(
        word_chars=sum(map(len, words)),
        n_symbols=sum(map(text.count, SYMBOLS)),
        n_dup_lines=repeated,
        faults=faults,
        lost_chars=lost,
        text="\n".join([line for line, keep in zip(lines, stay) if keep]),
    )
    return words, cleaned


def repeated_words(texts: list[list[str]], window: int = WINDOW) -> list[int]:
    """Per text, its words in windows that it holds twice or more.

    Windows are named without collisions: pairs of names of half a window get the next
    names, so ``window`` is a power of two.
    """
    known: dict[str, int] = {}
    sizes = np.array([len(words) for words in texts], np.int64)
    total = int(sizes.sum())
    if total < window:
        return [0] * len(texts)
    names = np.fromiter(
        (known.setdefault(w, len(known)) for words in texts for w in words), np.int64, total
    )
    text = np.repeat(np.arange(len(texts)), sizes)
    half = 1
    while half < window:
        pairs = names[:-half] * (names.max() + 1) + names[half:]
        names = np.unique(pairs, return_inverse=True)[1]
        half *= 2
    inside = text[: len(names)] == text[window - 1 :]
    starts = np.flatnonzero(inside)
    in_text = names[starts] * len(texts) + text[starts]
    _, which, count = np.unique(in_text, return_inverse=True, return_counts=True)
    starts = starts[count[which] > 1]
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + window, -1)
    covered = np.cumsum(steps[:-1]) > 0
    return np.bincount(text[covered], minlength=len(texts)).tolist()


_COUNTS = "n_words word_chars n_symbols n_dup_lines n_repeat_words".split()
_FAULTS = "n_punctuation n_navigation n_boilerplate lost_chars".split()
_SCHEMA = (
    "doc_id long, "
    + ", ".join(f"{c} long" for c in _COUNTS + _FAULTS)
    + ", base_failed boolean, kept boolean, clean_text string"
)
_TYPES = [pa.int64()] * (1 + len(_COUNTS + _FAULTS)) + [pa.bool_(), pa.bool_(), pa.string()]


def clean_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = True
) -> DataFrame:
    """Every document cleaned line by line, with its counts and the verdict.

    ``clean_text`` holds the lines that stay (null unless ``with_text``); the counts are
    those of the whole text before. ``base_failed``: under 20 words, or more than 30 in
    100 words in repeated windows. ``kept`` is false for these and for texts that lose
    more than three tenths of their characters with the removed lines.

    Null texts count as empty: no words, not kept. One row per row, repeated ones too;
    ids may be null; columns other than id and text are not looked at; an empty table
    gives no rows. Texts are read whole, some 300,000 words or one text at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for doc_id, text in zip(*batch.columns):
                words, cleaned = clean_text(text.as_py() or "")
                rows.append((doc_id.as_py(), words, cleaned))
                held += len(words)
                if held > WORDS_AT_ONCE:
                    yield judged(rows)
                    rows, held = [], 0
        if rows:
            yield judged(rows)

    def judged(rows: list[tuple[int, list[str], Cleaned]]) -> pa.RecordBatch:
        out = []
        for (doc_id, words, c), again in zip(rows, repeated_words([r[1] for r in rows])):
            failed = len(words) < LEAST_WORDS or 100 * again > MOST_REPEATED * len(words)
            kept = not failed and 10 * c.lost_chars <= MOST_LOST * c.word_chars
            counts = (len(words), c.word_chars, c.n_symbols, c.n_dup_lines, again)
            clean = c.text if with_text else None
            out.append((doc_id, *counts, *c.faults.values(), c.lost_chars, failed, kept, clean))
        arrays = [pa.array(column, kind) for column, kind in zip(zip(*out), _TYPES)]
        names = ["doc_id", *_COUNTS, *_FAULTS, "base_failed", "kept", "clean_text"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(
        F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("string")
    ).mapInArrow(run, _SCHEMA)


def kept_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, in the cleaned form: id and text."""
    cleaned = clean_documents(docs, id_col, text_col)
    return cleaned.where("kept").select(
        F.col("doc_id").alias(id_col), F.col("clean_text").alias(text_col)
    )
