"""Benchmark decontamination by templates.

A text is read as tokens; numbers, names and units become typed placeholders, so a
question with other values has the same template. Windows of the template, and of the
plain tokens, are hashed and joined with the benchmark's. A template match counts only
if its slots are filled consistently: one value of the benchmark, one value here.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce
from itertools import compress, islice
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanloom.llm.common import checkpointed

#: Scripts without spaces: Thai, Lao, Myanmar, Khmer, kana, Han. Each letter is a token.
UNSPACED = (
    "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff"
    "\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_LETTER = rf"[^\W\d_{UNSPACED}]"
_NUMBER = r"\d+(?:[.,]\d+)*"
#: Signs that stand for a unit beside a number, before or behind it.
SIGNS = {"$": "dollar", "€": "euro", "£": "pound", "¥": "yen", "₹": "rupee", "%": "percent"}
_SIGN = f"[{''.join(SIGNS)}]"
#: Marks that part neighbouring names, numbers or units.
MARKS = frozenset(".!?;:,…()[]\"“”。！？，；：\n")
TOKEN = (
    rf"{_LETTER}+(?:['’-]{_LETTER}+)*|(?:{_SIGN}\ ?)?{_NUMBER}(?:\ ?{_SIGN})?|[^\W\d_]"
    rf"|[{re.escape(''.join(MARKS))}]"
)
LITERAL, NUMBER, NAME, UNIT, MARK = range(5)
PLAIN, TEMPLATE = 0, 1
#: Where a slot stands in its item.
INNER, FIRST, LAST = range(3)

# Words for numbers, and units, which count only behind a number.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen "
    "fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty "
    "sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg lb lbs oz gram grams "
    "kilogram kilograms pound pounds ounce ounces ton tons ml l liter liters litre litres "
    "gallon gallons meter meters metre metres kilometer kilometers kilometre kilometres "
    "centimeter centimeters second seconds minute minutes min hour hours h day days week "
    "weeks month months year years percent degree degrees dollar dollars cent cents euro "
    "euros mph kmh watt watts volt volts yen rupee rupees".split()
)
#: Units whose singular is not the plural without its s.
SINGULAR = {"feet": "foot", "inches": "inch", "lbs": "lb", "metre": "meter", "litre": "liter"}

#: Tokens in a window.
WINDOW = 8
#: Literals that a template's alignment must cover, or all that the item has; with
#: fewer than LEAST an item's template says too little and only its plain form counts.
LITERALS, LEAST = 5, 2
#: Shorter items are found inside a text from this length on; below it, only as a
#: whole text.
SHORTEST = 5
#: A pair counts from so many matched tokens on, or with the whole item.
ENOUGH = 12
LEXICON_BITS = 22
#: Bits of the filter per benchmark window, and its largest size (16 MB).
FILTER_SHARE, FILTER_MOST, PROBES = 32, 27, 3
TOKENS_AT_ONCE = 300_000

_PRIME = 0x100000001B3
_KINDS = (0, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)
_MULTIPLIERS = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)


_TOKENS = re.compile(TOKEN).findall
_SIGNED = re.compile(_SIGN).search


# -- tokens ------------------------------------------------------------------------


class _Numbered(dict):
    """Tokens by number; a new one gets the next."""

    def __missing__(self, token: str) -> int:
        number = self[token] = len(self)
        return number


class Tokens:
    """Kinds and hashes of tokens; remembers the words it has seen.

    A capitalised word is a name unless the benchmark also writes it in lower case.
    """

    MOST = 500_000

    def __init__(self, lexicon: bytes):
        self.lexicon = np.frombuffer(lexicon, np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known = _Numbered()
        self.arrays = tuple(np.zeros(0, t) for t in (np.uint64, np.int8, bool, bool))

    def _in_lexicon(self, word: str) -> bool:
        at = crc32(word.encode()) & ((1 << LEXICON_BITS) - 1)
        return bool(self.lexicon[at >> 3] >> (at & 7) & 1)

    def _kind(self, token: str, word: str) -> int:
        if token[0].isdigit() or word in NUMBER_WORDS:
            return NUMBER
        if token in MARKS:
            return MARK
        if token == word or not (token[0].isupper() and token[1:].islower()):
            return LITERAL
        return LITERAL if self._in_lexicon(word) else NAME

    def _learn(self, tokens: list[str]) -> None:
        """Hash, kind, and whether it is a unit or short, of each new token."""
        words = [t.lower() for t in tokens]
        learned = (
            np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)),
            np.fromiter(map(self._kind, tokens, words), np.int8, len(words)),
            np.fromiter((w in UNITS or w in SIGNS for w in words), bool, len(words)),
            np.fromiter((len(w) <= 2 or w == "mrs" for w in words), bool, len(words)),
        )
        self.arrays = tuple(np.concatenate(pair) for pair in zip(self.arrays, learned))

    def read(self, tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of the tokens that are no marks, their hashes and kinds, and whether a
        mark stands before them. A point behind a short word abbreviates it."""
        if len(self.known) > self.MOST:
            self._forget()
        before = len(self.known)
        at = np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))
        if len(self.known) > before:
            self._learn(list(islice(self.known, before, None)))
        hashes, kinds, units, short = self.arrays
        mark = kinds[at] == MARK
        kept = np.flatnonzero(~mark)
        if (point := self.known.get(".")) is not None:
            mark[1:] &= ~((at[1:] == point) & short[at[:-1]])
        parted = np.append(False, mark)[kept]
        at = at[kept]
        kind = kinds[at]
        behind = np.append(False, kind[:-1] == NUMBER)
        kind = np.where(units[at] & behind, np.int8(UNIT), kind)
        return kept, hashes[at], kind, parted


def split_tokens(text: str) -> list[str]:
    """The tokens and marks of a text.

    Number words joined by hyphens are tokens of their own, and a sign of a unit follows
    its number wherever it stands.
    """
    found = _TOKENS(text)
    if "-" in text:
        found = [part for t in found for part in (_parts(t) if "-" in t else (t,))]
    if _SIGNED(text):
        found = [part for t in found for part in (_number_first(t) if _SIGNED(t) else (t,))]
    return found


def _number_first(token: str) -> list[str]:
    signs = [c for c in token if c in SIGNS]
    return ["".join(c for c in token if c not in SIGNS).strip(), *signs]


def unit_of(word: str) -> str:
    """One word for the ways to write a unit."""
    word = SIGNS.get(word, word)
    word = SINGULAR.get(word, word)
    return SINGULAR.get(word.removesuffix("s"), word.removesuffix("s"))


def _parts(token: str) -> list[str]:
    found: list[str] = []
    joins = False
    for part in token.split("-"):
        number = part.lower() in NUMBER_WORDS
        if joins and not number:
            found[-1] += f"-{part}"
        else:
            found.append(part)
        joins = not number
    return found


def lexicon_bits(words: set[str]) -> bytes:
    bits = np.zeros(1 << (LEXICON_BITS - 3), np.uint8)
    for word in words:
        at = crc32(word.encode()) & ((1 << LEXICON_BITS) - 1)
        bits[at >> 3] |= 1 << (at & 7)
    return bits.tobytes()


# -- windows -----------------------------------------------------------------------


class Windows:
    """Windows of a run of texts in one form.

    ``codes`` are the form's tokens, ``first`` the plain token each begins with and
    ``text`` the text it stands in. In a template, neighbouring slots of one kind are
    one slot, unless a mark stands between them.
    """

    def __init__(
        self, form: int, hashes: np.ndarray, kinds: np.ndarray, parted: np.ndarray, text: np.ndarray
    ):
        self.form = form
        if form == PLAIN:
            self.codes, self.first, self.text = hashes, np.arange(len(hashes)), text
            self.kinds = np.zeros(len(hashes), np.int8)
            return
        joined = np.zeros(len(kinds), bool)
        joined[1:] = (kinds[1:] > LITERAL) & (kinds[1:] == kinds[:-1]) & (text[1:] == text[:-1])
        joined &= ~parted
        self.first = np.flatnonzero(~joined)
        self.kinds, self.text = kinds[self.first], text[self.first]
        slots = np.array(_KINDS, np.uint64)[self.kinds]
        self.codes = np.where(self.kinds == LITERAL, hashes[self.first], slots)

    def hashed(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Starts of the usable windows of n tokens, and their hashes."""
        count = len(self.codes) - n + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        code = np.full(count, (self.form + 1) * 1000 + n, np.uint64)
        for k in range(n):
            code = (code ^ self.codes[k : k + count]) * np.uint64(_PRIME)
            code ^= code >> np.uint64(31)
        usable = self.text[:count] == self.text[n - 1 :]
        if n < SHORTEST:
            # Only where the window is its whole text.
            before = np.append(-1, self.text[:-1])[:count]
            after = np.append(self.text[n:], -1)[:count]
            usable &= (before != self.text[:count]) & (after != self.text[:count])
        at = np.flatnonzero(usable)
        return at, code[at]

    def needed(self, at: np.ndarray, n: int, texts: int) -> np.ndarray:
        """Template windows of texts in which one of them holds a slot, and one a literal.

        In texts without slots the plain form says the same; slots alone say nothing.
        """
        slot = np.append(0, np.cumsum(self.kinds > LITERAL))
        held = slot[at + n] - slot[at]
        some = np.zeros((2, texts), bool)
        some[0, self.text[at[held > 0]]] = True
        some[1, self.text[at[held < n]]] = True
        return some.all(axis=0)[self.text[at]]

    def literals(self, at: int, n: int) -> list[int]:
        """Where a template's window holds literals."""
        if self.form == PLAIN:
            return []
        return (at + np.flatnonzero(self.kinds[at : at + n] == LITERAL)).tolist()

    def slots(self, at: int, n: int, tokens: list[str]) -> list[str]:
        """Kind and value of each slot of a window."""
        if self.form == PLAIN:
            return []
        found = []
        for i in range(at, at + n):
            if self.kinds[i] == LITERAL:
                continue
            end = self.first[i + 1] if i + 1 < len(self.first) else len(tokens)
            words = [t.lower() for t in tokens[self.first[i] : end]]
            if self.kinds[i] == UNIT:
                words = [unit_of(w) for w in words]
            found.append(f"{self.kinds[i]}:{' '.join(words)}")
        return found

    def edges(self, at: int, n: int) -> list[int]:
        """For each slot of a window, whether it is the first or the last of all codes."""
        if self.form == PLAIN:
            return []
        last = len(self.codes) - 1
        places = (at + np.flatnonzero(self.kinds[at : at + n] != LITERAL)).tolist()
        return [FIRST if i == 0 else LAST if i == last else INNER for i in places]


def read_texts(reader: Tokens, texts: list[str]) -> tuple[list[str], list[Windows], np.ndarray]:
    """All tokens, both forms, and the tokens per text."""
    found = [split_tokens(t) for t in texts]
    tokens = [t for f in found for t in f]
    kept, hashes, kinds, parted = reader.read(tokens)
    text = np.repeat(np.arange(len(texts)), [len(f) for f in found])[kept]
    plain = np.zeros(len(tokens), bool)
    plain[kept] = True
    tokens = list(compress(tokens, plain.tolist()))
    sizes = np.bincount(text, minlength=len(texts))
    forms = [Windows(form, hashes, kinds, parted, text) for form in (PLAIN, TEMPLATE)]
    return tokens, forms, sizes


def probes(code: np.ndarray, bits: int) -> list[np.ndarray]:
    shift = np.uint64(64 - bits)
    return [((code * np.uint64(m)) >> shift).astype(np.int64) for m in _MULTIPLIERS]


# -- Spark ---------------------------------------------------------------------------

_WINDOWS = (
    "item_id long, form int, length int, code long, position int, slots array<string>, "
    "edges array<int>, size int, literals array<int>, wanted int"
)


def _item_windows(lexicon: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Tokens(lexicon)
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                tokens, forms, _ = read_texts(reader, [text or ""])
                for windows in forms:
                    size = len(windows.codes)
                    n = min(WINDOW, size)
                    if not n:
                        continue
                    wanted = 0
                    if windows.form == TEMPLATE:
                        wanted = min(LITERALS, int((windows.kinds == LITERAL).sum()))
                        if wanted < LEAST:
                            continue
                    at, code = windows.hashed(n)
                    for i, c in zip(at.tolist(), code.view(np.int64).tolist()):
                        slots, literals = windows.slots(i, n, tokens), windows.literals(i, n)
                        edges = windows.edges(i, n)
                        rows.append(
                            (item, windows.form, n, c, i, slots, edges, size, literals, wanted)
                        )
            if rows:
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
                types += [pa.list_(pa.string()), pa.list_(pa.int32()), pa.int32()]
                types += [pa.list_(pa.int32()), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                    names="item_id form length code position slots edges size literals wanted".split(),
                )

    return run


def _doc_windows(lexicon: bytes, lengths: list[int], bits: int, filter_bytes: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Tokens(lexicon)
        packed = np.frombuffer(filter_bytes, np.uint8)

        def candidates(ids: list, keys: list, texts: list[str]) -> pa.RecordBatch | None:
            tokens, forms, _ = read_texts(reader, texts)
            rows = []
            for windows in forms:
                begin = np.searchsorted(windows.text, np.arange(len(texts)))
                for n in lengths:
                    at, code = windows.hashed(n)
                    for probe in range(PROBES):
                        where = probes(code, bits)[probe]
                        hit = (packed[where >> 3] >> (where & 7).astype(np.uint8)) & 1
                        at, code = at[hit == 1], code[hit == 1]
                    if windows.form == TEMPLATE:
                        needed = windows.needed(at, n, len(texts))
                        at, code = at[needed], code[needed]
                    for i, c in zip(at.tolist(), code.view(np.int64).tolist()):
                        t = int(windows.text[i])
                        slots = windows.slots(i, n, tokens)
                        rows.append(
                            (ids[t], keys[t], windows.form, n, c, i - int(begin[t]), slots)
                        )
            if not rows:
                return None
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
            types.append(pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), types)],
                names="doc_id text_key form length code position slots".split(),
            )

        ids, keys, texts, held = [], [], [], 0
        for batch in batches:
            for row_id, key, text in zip(*batch.columns):
                ids.append(row_id.as_py())
                keys.append(key.as_py())
                texts.append(text.as_py() or "")
                held += len(texts[-1])
                if held > 6 * TOKENS_AT_ONCE:
                    if (out := candidates(ids, keys, texts)) is not None:
                        yield out
                    ids, keys, texts, held = [], [], [], 0
        if texts and (out := candidates(ids, keys, texts)) is not None:
            yield out

    return run


def _lexicon(items: DataFrame) -> bytes:
    """The benchmark's lower-case words as a bitmap of fixed size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = {
                t
                for text in batch.column(0).to_pylist()
                for t in split_tokens(text or "")
                if t.islower()
            }
            bits = np.frombuffer(lexicon_bits(words), np.uint8)
            yield _bitmap_rows(np.flatnonzero(np.unpackbits(bits, bitorder="little")))

    return _bitmap(items.select("text").mapInArrow(run, "word long, bits long"), LEXICON_BITS)


def _bitmap_rows(at: np.ndarray) -> pa.RecordBatch:
    at = np.unique(at)
    one = np.uint64(1) << (at & 63).astype(np.uint64)
    return pa.RecordBatch.from_arrays(
        [pa.array(at >> 6), pa.array(one.view(np.int64))], names=["word", "bits"]
    )


def _bitmap(rows: DataFrame, bits: int) -> bytes:
    """Bits united per 64-bit word; at most 2**bits / 64 rows reach the driver."""
    found = rows.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    packed = np.zeros(1 << (bits - 6), np.int64)
    packed[found["word"].to_numpy()] = found["bits"].to_numpy()
    return packed.tobytes()


def _filter(windows: DataFrame, bits: int) -> bytes:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy().view(np.uint64)
            yield _bitmap_rows(np.concatenate(probes(code, bits)))

    return _bitmap(windows.select("code").mapInArrow(run, "word long, bits long"), bits)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of a text and a benchmark item that it holds, in these words or others.

    Returns ``doc_id, text_key, item_id, matched`` (tokens), ``item_tokens``, ``exact``
    and ``slots``, the replaced values as kind:item value>text value. A pair counts
    from ``ENOUGH`` matched tokens on, or with the whole item; items under
    ``SHORTEST`` tokens count only as a whole text, items without tokens never. With
    other values it must also cover ``LITERALS`` literals, or all that the item has and
    these at least ``LEAST``.
    What of a name, number or unit at the item's ends belongs to the text around it is
    left open: there the text's run of such words must end, or begin, with the value.
    Signs are read as the unit they stand for, and units in the singular.
    ``text_key`` is the text's xxhash64, which tells rows apart that lack an id.

    Null texts hold nothing; repeated rows give one pair. Without documents or items
    there are no rows. Only id and text columns are read. The filter and the lexicon
    that tasks receive have a largest size; beyond it the filter lets more windows
    through to the join, which decides.
    """
    items = items.select(
        F.col(f"`{item_id_col}`").cast("long").alias("item_id"),
        F.coalesce(F.col(f"`{item_text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    lexicon = _lexicon(items)
    windows = checkpointed(
        items.select("item_id", "text").mapInArrow(_item_windows(lexicon), _WINDOWS).distinct()
    )
    number = windows.count()
    lengths = sorted(r[0] for r in windows.select("length").distinct().collect())
    bits = min(max((number * FILTER_SHARE).bit_length(), 16), FILTER_MOST)
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((lexicon, lengths, bits, _filter(windows, bits)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _doc_windows(*shared.value)(batches)

    text = F.col(f"`{text_col}`").cast("string")
    found = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        text.alias("text"),
    ).mapInArrow(
        run,
        "doc_id long, text_key long, form int, length int, code long, position int, "
        "slots array<string>",
    )
    own = windows.select(
        "item_id",
        "size",
        "literals",
        "wanted",
        # Windows with many literals are also judged alone, see below.
        F.explode(
            F.when(F.size("literals") >= F.ceil(F.col("length") * LITERALS / WINDOW), F.array(F.lit(0), F.lit(1)))
            .otherwise(F.array(F.lit(0)))
        ).alias("strict"),
        *[
            F.col(c).alias(f"item_{c}")
            for c in ("form", "length", "code", "position", "slots", "edges")
        ],
    )
    same = [F.col(c) == F.col(f"item_{c}") for c in ("code", "form", "length")]
    matched = found.join(own, reduce(Column.__and__, same))
    # One alignment of an item with a text: all its windows are equally far apart. It is
    # judged with all windows and with the literal ones alone, so that a chance match of
    # a window full of slots does not make the rest inconsistent.
    aligned = matched.groupBy(
        "doc_id",
        "text_key",
        "item_id",
        "size",
        "form",
        "length",
        "strict",
        "wanted",
        (F.col("position") - F.col("item_position")).alias("offset"),
    ).agg(
        F.array_sort(F.collect_set("item_position")).alias("positions"),
        F.size(F.array_distinct(F.flatten(F.collect_set("literals")))).alias("held"),
        F.array_distinct(
            F.flatten(F.collect_set(F.arrays_zip("item_slots", "item_edges", "slots")))
        ).alias("pairs"),
    )
    pairs = F.col("pairs")
    consistent = _consistent(pairs)
    exact = F.forall(pairs, lambda p: F.array_contains(_possible(p), p["item_slots"]))
    # A template alignment without a slot is the plain form's.
    told = (F.col("form") == PLAIN) | (
        (F.size(pairs) > 0) & (F.col("held") >= F.col("wanted"))
    )
    counted = aligned.filter(consistent & told).select(
        "doc_id",
        "text_key",
        "item_id",
        F.col("size").alias("item_tokens"),
        _covered(F.col("positions"), F.col("length")).alias("matched"),
        exact.alias("exact"),
        F.array_join(
            F.transform(
                F.filter(pairs, lambda p: ~F.array_contains(_possible(p), p["item_slots"])),
                lambda p: F.concat(p["item_slots"], F.lit(">"), p["slots"]),
            ),
            ",",
        ).alias("slots"),
    )
    enough = F.col("matched") >= F.least(F.lit(ENOUGH), F.col("item_tokens"))
    best = F.max_by(
        F.struct("item_tokens", "matched", "exact", "slots"),
        F.struct("matched", "exact", "item_tokens", "slots"),
    )
    return (
        counted.filter(enough)
        .groupBy("doc_id", "text_key", "item_id")
        .agg(best.alias("best"))
        .select("doc_id", "text_key", "item_id", "best.*")
    )


def _values(pairs: Column, field: str) -> Column:
    return F.transform(pairs, lambda p: p[field])


def _possible(pair: Column) -> Column:
    """Values that a slot may have: at an item's end, any end of the text's run."""
    kind = F.substring_index(pair["slots"], ":", 1)
    words = F.split(F.substring(pair["slots"], 3, 1 << 30), " ")
    n = F.size(words)

    def part(k: Column) -> Column:
        begin = F.when(pair["item_edges"] == FIRST, n - k + 1).otherwise(F.lit(1))
        return F.concat(kind, F.lit(":"), F.array_join(F.slice(words, begin, k), " "))

    ends = F.transform(F.sequence(F.lit(1), n), part)
    return F.when(pair["item_edges"] == INNER, F.array(pair["slots"])).otherwise(ends)


def _consistent(pairs: Column) -> Column:
    """One value here for each of the item's, and for two names two."""
    inner = F.array_distinct(
        F.transform(
            F.filter(pairs, lambda p: p["item_edges"] == INNER),
            lambda p: F.struct(p["item_slots"].alias("item_slots"), p["slots"].alias("slots")),
        )
    )
    edges = F.filter(pairs, lambda p: p["item_edges"] != INNER)
    names = F.filter(inner, lambda p: p["item_slots"].startswith(f"{NAME}:"))
    function = F.size(F.array_distinct(_values(inner, "item_slots"))) == F.size(inner)
    two = F.size(F.array_distinct(_values(names, "slots"))) == F.size(names)

    def fits(edge: Column) -> Column:
        """An end's slot against all others of its value, and of other names."""
        possible = _possible(edge)
        alike = F.forall(
            pairs,
            lambda p: (p["item_slots"] != edge["item_slots"])
            | F.arrays_overlap(_possible(p), possible),
        )
        # Only a run of one word is known to be the name and nothing else.
        alone = edge["item_slots"].startswith(f"{NAME}:") & (F.size(possible) == 1)
        other = F.forall(
            pairs,
            lambda p: (p["item_slots"] == edge["item_slots"])
            | (F.size(_possible(p)) != 1)
            | (p["slots"] != edge["slots"]),
        )
        return alike & (~alone | other)

    return function & two & F.forall(edges, fits)


def _covered(positions: Column, length: Column) -> Column:
    """Tokens under windows of this length at the sorted positions."""
    return F.aggregate(
        positions,
        F.struct(F.lit(-1).alias("end"), F.lit(0).alias("sum")),
        lambda s, p: F.struct(
            (p + length).alias("end"),
            (s["sum"] + p + length - F.greatest(s["end"], p)).alias("sum"),
        ),
        lambda s: s["sum"],
    )


def without_leaks(
    docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows that hold no benchmark item, with all their columns as they are.

    A row goes if its id and text are those of a pair in ``found``; rows alike go
    together, a null id is matched like any other, null texts are never found. Without
    pairs all rows stay; a table without rows gives none.
    """
    flagged = found.select(F.col("doc_id").alias("id"), F.col("text_key").alias("key"))
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("row_id"),
        F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("row_key"),
    )
    same = F.col("row_id").eqNullSafe(F.col("id")) & (F.col("row_key") == F.col("key"))
    return rows.join(flagged.distinct(), same, "left_anti").select("row.*")
