"""The Merkle manifest against a tree built in plain Python."""

import random
from hashlib import sha256

import pytest
from corpus_fixtures import odd  # noqa: F401
from loanloom.llm import merkle
from pyspark.sql import functions as F


def text_digest(text):
    return sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def plain_tree(leaves, arity):
    levels = [leaves]
    while len(levels[-1]) > 1:
        below = levels[-1]
        runs = [below[i : i + arity] for i in range(0, len(below), arity)]
        levels.append([text_digest("".join(run)) for run in runs])
    return levels


def climb(levels, at, arity, folded):
    others = []
    for level in levels[:-1]:
        first = at // arity * arity
        run = level[first : first + arity]
        others += [d for i, d in enumerate(run) if i != at - first]
        run[at - first] = folded
        folded, at = text_digest("".join(run)), at // arity
    return others, folded


def plain_proofs(rows, arity=2, changed=lambda row: row):
    """Rows of (leaf, subroot, root, proof, folded) for (doc_id, source, lang, n_chars, text)."""
    by_lang = {}
    for row in rows:
        shown = text_digest("".join(map(field, changed(row))))
        leaf = text_digest("".join(map(field, row)))
        by_lang.setdefault(row[2], []).append((row[0] is not None, row[0] or 0, leaf, shown))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {x: plain_tree([r[2] for r in sorted(by_lang[x])], arity) for x in langs}
    top = plain_tree([trees[x][-1][0] for x in langs], arity) if langs else []
    found = []
    for place, lang in enumerate(langs):
        for at, (_, _, leaf, shown) in enumerate(sorted(by_lang[lang])):
            others, folded = climb(trees[lang], at, arity, shown)
            more, folded = climb(top, place, arity, folded)
            proof = text_digest("".join(others + more))
            found.append((leaf, trees[lang][-1][0], top[-1][0], proof, folded))
    return found


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"
NAMES = ["leaf", "subroot", "root", "proof_sha256", "folded_root"]


def proofs_of(spark, rows, folder, **more):
    docs = spark.createDataFrame(rows, SCHEMA)
    found = merkle.manifest_proofs(docs, str(folder), **more)
    return sorted(tuple(r) for r in found.select(*NAMES, "verified").collect())


@pytest.mark.parametrize("arity, levels, count", [(2, 6, 200), (2, 2, 65), (3, 2, 100)])
def test_against_plain_tree(spark, tmp_path, arity, levels, count):
    draw = random.Random(count)
    langs = [None, "", "de", "en", "zü", "é"]
    rows = [
        (i, f"s{i % 3}", draw.choice(langs + ["en"] * 8), draw.choice([None, i]), f"text é {i}")
        for i in range(count)
    ]
    found = proofs_of(spark, rows, tmp_path / "m", arity=arity, levels=levels)
    assert [r[:5] for r in found] == sorted(plain_proofs(rows, arity))
    assert all(r[5] for r in found)


def test_small_groups(spark, tmp_path):
    rows = [(i, None, f"x{n}", 1, "t") for n in range(1, 10) for i in range(n)]
    rows.append((9, None, None, None, None))
    found = proofs_of(spark, rows, tmp_path / "m", levels=1)
    assert [r[:5] for r in found] == sorted(plain_proofs(rows))


def test_one_row(spark, tmp_path):
    (row,) = proofs_of(spark, [(5, "s", "l", 1, "t")], tmp_path / "m")
    assert row[0] == row[1] == row[2] == row[4] and row[5]
    assert row[3] == text_digest("")


def test_rows_alike(spark, tmp_path):
    """Rows alike, nulls in all columns, and equal ids with different texts."""
    rows = [(7, "s", "en", 3, "abc")] * 3000 + [(None,) * 5] * 70
    rows += [(7, "s", "en", 3, t) for t in ("", None, "x" * 300_000)]
    found = proofs_of(spark, rows, tmp_path / "m")
    assert [r[:5] for r in found] == sorted(plain_proofs(rows))


def test_changed_rows_fail(spark, tmp_path):
    rows = [(i, "s", "en", i, "t") for i in range(50)] + [(50, "s", "en", None, "t")]

    def more(row):
        return (*row[:3], None if row[3] is None else row[3] + 1, row[4])

    shown = {"n_chars": F.col("n_chars") + 1}
    found = proofs_of(spark, rows, tmp_path / "m", shown=shown)
    assert [r[:5] for r in found] == sorted(plain_proofs(rows, changed=more))
    assert sum(r[5] for r in found) == 1


def test_damaged_record_is_found(spark, tmp_path):
    leaves = spark.range(300).select(
        F.lit("=en").alias("key"), F.lit(300).cast("long").alias("total"), F.col("id").alias("place"),
        F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("digest"),
        F.col("id"), F.lit(None).cast("binary").alias("shown"),
    )
    forest = merkle.build(leaves, str(tmp_path / "m"))
    wrong = leaves.withColumn("shown", F.col("digest")).withColumn("place", 299 - F.col("place"))
    entry = forest.roots.select(
        "key", "total", "digest", F.expr("array()").cast(merkle._PATH[5:]).alias("path"),
        F.col("digest").alias("top"),
    )
    with pytest.raises(Exception, match="no leaf"):
        merkle.descend(forest, entry, wrong, prove=True).collect()


def test_empty_and_clashing(spark, tmp_path, odd):
    assert proofs_of(spark, [], tmp_path / "a") == []
    names = ["doc_id", "source", "lang", "n_chars", "text"]
    rows = [tuple(r) for r in odd.select(*names).collect()]
    found = merkle.manifest_proofs(
        odd.withColumns({c: F.lit(1) for c in ("place", "total", "others", "_run", "path")}),
        str(tmp_path / "b"),
    )
    assert sorted(tuple(r) for r in found.select(*NAMES).collect()) == sorted(plain_proofs(rows))
