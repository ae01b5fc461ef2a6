"""Secrets in texts: known forms, and tokens that look random.

A candidate token's encoding is inferred from its characters. Three tests ask whether
its characters could come from written language: how uniformly the alphabet is used
(chi-squared), how often character classes change (runs) and how neighbouring
characters go together (serial correlation). Their p-values under language are
combined, and a false-discovery limit per encoding and length class, over all
candidates of the corpus, decides which tokens are reported.

Everything is a column expression; nothing runs in Python.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loanloom.llm.common import checkpointed

# The known forms.
ASSIGN = (
    r"(?:(?i:password|passwd|secret|token|api_?key))"
    r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"

#: Encodings, narrowest first: name, pattern of the whole token, alphabet size.
ENCODINGS = (
    ("decimal", "^[0-9]+$", 10),
    ("hex", "^([0-9a-f]+|[0-9A-F]+)$", 16),
    ("base32", "^[A-Z2-7]+=*$", 32),
    ("base62", "^[A-Za-z0-9]+$", 62),
    ("base64", "^[A-Za-z0-9+/]+=*$", 64),
    ("base64url", "^[A-Za-z0-9_-]+=*$", 64),
    ("mixed", "", 66),
)

# What language looks like: sums of squared and cubed letter shares (letters of written
# European languages), share of neighbours that change class, and serial correlation
# of the vowels with its spread.
LETTERS_SQUARED, LETTERS_CUBED = 0.066, 0.0055
CLASS_CHANGES = 0.12
VOWEL_SERIAL, VOWEL_SPREAD = -0.35, 0.9

#: Length classes double from 20 characters; the last one is open.
LENGTH_CLASSES = 8
#: p-values are counted in bins of equal steps of the logarithm.
BINS, BIN_STEP = 400, 0.05


# -- spans -----------------------------------------------------------------------


#: Matches whose places are added up at one time, before the blocks are.
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used there."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def spans(text: Column, pattern: str, keep=None) -> Column:
    """Leftmost non-overlapping matches as structs of start, end (code points), token.

    The matches and the pieces between them come from the same pattern, so adding up
    lengths gives the positions: within blocks of matches first, then over the blocks,
    so that the work grows with the matches and not with their square. ``keep`` may drop
    matches by their text, after the scan.
    """
    none = F.array().cast("array<struct<start:long,end:long,token:string>>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    pieces = F.zip_with(
        between, found, lambda gap, hit: F.struct(F.length(gap).cast("long").alias("gap"), hit.alias("hit"))
    )

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + x["gap"]
        end = start + F.length(x["hit"])
        span = F.struct(start.alias("start"), end.alias("end"), x["hit"].alias("token"))
        moved = F.struct(end.alias("at"), F.concat(s["out"], F.array(span)).alias("out"))
        return F.when(x["hit"].isNull(), s).otherwise(moved)

    def block(part: Column) -> Column:
        begin = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
        return F.aggregate(part, begin, step)

    def blocks_of(pieces: Column) -> Column:
        last = F.floor((F.size(pieces) - 1) / BLOCK).cast("int")
        return F.transform(
            F.sequence(F.lit(0), last),
            lambda i: block(F.slice(pieces, i * BLOCK + 1, F.lit(BLOCK))),
        )

    def joined(blocks: Column) -> Column:
        zero = F.lit(0).cast("long")
        starts = F.aggregate(
            blocks,
            F.struct(zero.alias("at"), F.array(zero).alias("out")),
            lambda s, x: F.struct(
                (s["at"] + x["at"]).alias("at"),
                F.concat(s["out"], F.array(s["at"] + x["at"])).alias("out"),
            ),
            lambda s: F.slice(s["out"], F.lit(1), F.size(s["out"]) - 1),
        )
        moved = F.zip_with(
            blocks,
            starts,
            lambda x, at: F.transform(
                x["out"],
                lambda m: F.struct(
                    (m["start"] + at).alias("start"),
                    (m["end"] + at).alias("end"),
                    m["token"].alias("token"),
                ),
            ),
        )
        return F.flatten(moved)

    placed = let(let(pieces, blocks_of), joined)
    placed = F.when(text.rlike(pattern), placed).otherwise(none)
    return F.filter(placed, lambda x: keep(x["token"])) if keep else placed


def _count_below(values: Column, limit: Column) -> Column:
    """How many of the ascending values are below the limit, by bisection."""
    steps = F.ceil(F.log2(F.size(values) + 1.0)).cast("int")

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = F.get(values, middle) < limit
        open_ = s["low"] < s["high"]
        return F.struct(
            F.when(open_ & below, middle + 1).otherwise(s["low"]).alias("low"),
            F.when(open_ & ~below, middle).otherwise(s["high"]).alias("high"),
        )

    begin = F.struct(F.lit(0).alias("low"), F.size(values).alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), steps), begin, halve, lambda s: s["low"])
    return F.when(F.size(values) == 0, F.lit(0)).otherwise(found)


def apart(tokens: Column, known: Column) -> Column:
    """The tokens that overlap none of the known spans, which stand in order and apart.

    A token overlaps some if more of them start before its end than end up to its start.
    """

    def free(edges: Column) -> Column:
        return F.filter(
            tokens,
            lambda t: _count_below(edges["starts"], t["end"])
            == _count_below(edges["ends"], t["start"] + 1),
        )

    edges = F.struct(
        F.transform(known, lambda s: s["start"]).alias("starts"),
        F.transform(known, lambda s: s["end"]).alias("ends"),
    )
    return F.when(F.size(known) == 0, tokens).otherwise(let(edges, free))


def assigned_value(token: Column) -> Column:
    return F.regexp_extract(token, ASSIGN, 1)


def base_spans(text: Column) -> list[Column]:
    """Spans of the three known forms, in the order of ``KINDS``."""
    return [
        spans(text, ASSIGN, lambda t: F.length(assigned_value(t)) >= 6),
        spans(text, ACCESS),
        spans(text, HEX),
    ]


# -- the battery -----------------------------------------------------------------


def _normal_tail(z: Column) -> Column:
    """P(Z > z) of a standard normal, by the logistic form good to 1e-3."""
    slope = z * 1.5976 + F.pow(z, 3) * 0.07056
    return 1 / (1 + F.exp(F.least(F.greatest(slope, F.lit(-300.0)), F.lit(300.0))))


def _chars(token: Column) -> Column:
    return F.split(F.regexp_replace(token, "=+$", ""), "")


def encoding(token: Column) -> Column:
    """Index of the narrowest encoding whose alphabet holds the token."""
    found = F.lit(len(ENCODINGS) - 1)
    for i in range(len(ENCODINGS) - 2, -1, -1):
        found = F.when(token.rlike(ENCODINGS[i][1]), F.lit(i)).otherwise(found)
    return found


def chi_squared_p(chars: Column, n: Column, k: Column) -> Column:
    """How likely language would use the alphabet this uniformly.

    The statistic against equal shares of k characters is (k / n) * sum of squared
    counts - n; under language its mean and spread follow from the chance that two
    characters of a token agree.
    """
    start = F.struct(
        F.lit("").alias("last"), F.lit(0.0).alias("run"), F.lit(0.0).alias("pairs")
    )
    pairs = F.aggregate(
        F.array_sort(chars),
        start,
        lambda s, c: F.struct(
            c.alias("last"),
            F.when(s["last"] == c, s["run"] + 1).otherwise(F.lit(0.0) + 1).alias("run"),
            (s["pairs"] + F.when(s["last"] == c, s["run"]).otherwise(F.lit(0.0))).alias("pairs"),
        ),
        lambda s: s["pairs"],
    )
    two = n * (n - 1) / 2
    three = n * (n - 1) * (n - 2) / 6
    squared, cubed = F.lit(LETTERS_SQUARED), F.lit(LETTERS_CUBED)
    mean = two * squared
    variance = two * (squared - squared * squared) + three * 6 * (cubed - squared * squared)
    # Both means are turned into the statistic's scale; k cancels out of the test, but a
    # small alphabet has more agreeing pairs by itself, which language is not blamed for.
    own = two / k
    shift = F.greatest(own - mean, F.lit(0.0))
    return _normal_tail((mean + shift - pairs) / F.sqrt(F.greatest(variance, F.lit(1e-6))))


def runs_p(chars: Column, n: Column) -> Column:
    """How likely language would change between character classes this often."""
    kind = F.transform(
        chars,
        lambda c: F.when(c.rlike("[a-z]"), 0)
        .when(c.rlike("[A-Z]"), 1)
        .when(c.rlike("[0-9]"), 2)
        .otherwise(3),
    )
    changes = F.aggregate(
        kind,
        F.struct(F.lit(-1).alias("last"), F.lit(0.0).alias("changes")),
        lambda s, c: F.struct(
            c.alias("last"),
            (
                s["changes"]
                + F.when((s["last"] >= 0) & (s["last"] != c), F.lit(1.0)).otherwise(F.lit(0.0))
            ).alias("changes"),
        ),
        lambda s: s["changes"],
    )
    steps = n - 1
    spread = F.sqrt(steps * CLASS_CHANGES * (1 - CLASS_CHANGES))
    return _normal_tail((changes - steps * CLASS_CHANGES) / F.greatest(spread, F.lit(1e-6)))


def serial_p(chars: Column, n: Column) -> Column:
    """How likely vowels and other characters would alternate this little in language."""
    start = F.struct(
        F.lit(-1.0).alias("last"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("both")
    )
    vowel = F.transform(
        chars, lambda c: F.when(F.lower(c).isin(*"aeiou"), F.lit(1.0)).otherwise(F.lit(0.0))
    )

    def serial(s: Column) -> Column:
        share = s["sum"] / n
        variance = share * (1 - share)
        return F.when(variance <= 0, F.lit(0.0)).otherwise(
            (s["both"] / (n - 1) - share * share) / variance
        )

    correlation = F.aggregate(
        vowel,
        start,
        lambda s, v: F.struct(
            v.alias("last"),
            (s["sum"] + v).alias("sum"),
            (s["both"] + F.when(s["last"] > 0, v).otherwise(F.lit(0.0))).alias("both"),
        ),
        serial,
    )
    return _normal_tail((correlation - VOWEL_SERIAL) * F.sqrt(n) / VOWEL_SPREAD)


def language_p(token: Column) -> Column:
    """Combined p-value that language wrote the token: Fisher's sum of three logarithms."""
    chars = _chars(token)
    n = F.size(chars).cast("double")
    k = F.element_at(
        F.array(*[F.lit(float(e[2])) for e in ENCODINGS]), encoding(token) + 1
    )
    logs = F.lit(0.0)
    for p in (chi_squared_p(chars, n, k), runs_p(chars, n), serial_p(chars, n)):
        logs = logs - F.log(F.greatest(p, F.lit(1e-12)))
    # -2 * sum of logs is chi-squared with six degrees: its tail in closed form.
    return F.exp(-logs) * (1 + logs + logs * logs / 2)


def length_class(token: Column) -> Column:
    return F.least(
        F.floor(F.log2(F.length(token) / 20.0)).cast("int"), F.lit(LENGTH_CLASSES - 1)
    )


def p_bin(p: Column) -> Column:
    """Bin 0 holds the smallest p-values."""
    step = F.floor(-F.log10(F.greatest(p, F.lit(1e-20))) / BIN_STEP).cast("int")
    return F.greatest(F.lit(BINS - 1) - step, F.lit(0))


def bin_ceiling(at: Column) -> Column:
    """The largest p-value of a bin."""
    return F.pow(F.lit(10.0), -(F.lit(BINS - 1) - at) * BIN_STEP)


def discovery_limits(counts: DataFrame, limit: float) -> DataFrame:
    """Last bin to report per stratum, where there is one.

    ``counts``: stratum, bin, tokens. With r tokens up to a bin and m in the stratum,
    chance explains m times the bin's largest p of them; the last bin where that is at
    most ``limit`` of r is the step-up rule of false-discovery control.
    """
    up_to = Window.partitionBy("stratum").orderBy("bin")
    every = Window.partitionBy("stratum")
    return (
        counts.withColumn("found", F.sum("tokens").over(up_to))
        .withColumn("all", F.sum("tokens").over(every))
        .filter(bin_ceiling(F.col("bin")) * F.col("all") <= F.col("found") * limit)
        .groupBy("stratum")
        .agg(F.max("bin").alias("last"))
    )


# -- the scan --------------------------------------------------------------------


def scan_secrets(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    false_discoveries: float = 0.001,
) -> DataFrame:
    """Per row ``doc_id`` and ``found``: spans of kind, start, end and token in order.

    Positions are code points, the end is exclusive. Null texts count as empty. A
    random token overlaps no known form. Rows stay as many as they are, repeated ones
    too; null ids are kept; an empty table gives no rows; other columns are not looked
    at. The limits per stratum, of which there are at most the encodings times eight
    length classes, are the only values that pass through the driver.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    known = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text")
    ).select(
        "doc_id",
        *[s.alias(k) for s, k in zip(base_spans(F.col("text")), KINDS)],
        spans(F.col("text"), CANDIDATE).alias("tokens"),
    )
    free = F.col("tokens")
    for kind in KINDS[:3]:
        free = apart(free, F.col(kind))
    scored = F.transform(
        free,
        lambda t: F.struct(
            t["start"].alias("start"),
            t["end"].alias("end"),
            t["token"].alias("token"),
            (encoding(t["token"]) * LENGTH_CLASSES + length_class(t["token"])).alias("stratum"),
            p_bin(language_p(t["token"])).alias("bin"),
        ),
    )
    rows = checkpointed(known.select("doc_id", *KINDS[:3], scored.alias("random")))
    counts = (
        rows.select(F.explode("random").alias("t"))
        .groupBy(F.col("t.stratum").alias("stratum"), F.col("t.bin").alias("bin"))
        .agg(F.count(F.lit(1)).alias("tokens"))
    )
    limits = discovery_limits(counts, false_discoveries).collect()
    if limits:
        pairs = [F.lit(x) for row in sorted(limits) for x in (row["stratum"], row["last"])]
        last = F.create_map(*pairs)
        random = F.filter(
            F.col("random"),
            lambda t: t["bin"] <= F.coalesce(F.element_at(last, t["stratum"]), F.lit(-1)),
        )
    else:
        random = F.filter(F.col("random"), lambda t: F.lit(False))
    parts = [_of_kind(F.col(kind), rank) for rank, kind in enumerate(KINDS[:3])]
    parts.append(_of_kind(random, 3))
    return rows.select("doc_id", F.array_sort(F.concat(*parts)).alias("found"))


def _of_kind(found: Column, rank: int) -> Column:
    return F.transform(
        found,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            s["end"].alias("end"),
            F.lit(KINDS[rank]).alias("kind"),
            s["token"].alias("token"),
        ),
    )


def joined_spans(found: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans of these kinds, joined by commas."""
    listed = F.filter(found, lambda s: s["kind"].isin(*kinds))
    return F.array_join(
        F.transform(
            listed,
            lambda s: F.concat_ws(
                ":", s["kind"], s["start"].cast("string"), s["end"].cast("string")
            ),
        ),
        ",",
    )


def count_of(found: Column, kind: str) -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")
