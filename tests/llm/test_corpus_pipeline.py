"""Each stage of the pipeline against a plain version on its own input."""

import random
import re

import corpus_pipeline
import pytest
import xxhash
from corpus_fixtures import FOLDER, odd  # noqa: F401
from loanloom.llm import queries, simhash
from pyspark.sql import functions as F

STAGES = dict(corpus_pipeline.STAGES)


def written(spark, df, tmp_path, name):
    path = str(tmp_path / name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_order_and_names():
    assert list(STAGES) == ["quality", "near_copies", "benchmark_leaks", "mixture", "shards"]


def test_run(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    docs = queries.table(spark, FOLDER, "documents")
    assert found.columns == [*docs.columns, "curve", "shard", "slot"]
    rows = found.collect()
    assert rows and {r["doc_id"] for r in rows} <= {r["doc_id"] for r in docs.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(texts[r["doc_id"]] == r["text"] for r in rows)
    sizes = {}
    for r in rows:
        sizes[r["shard"]] = sizes.get(r["shard"], 0) + 1
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_quality_keeps_good_rows(spark):
    folder = FOLDER.replace("0.001", "0.01")
    docs = queries.table(spark, folder, "documents")
    kept = {r["doc_id"] for r in STAGES["quality"](spark, docs, folder).collect()}
    labels = queries.table(spark, folder, "labels").collect()
    good = [r["doc_id"] for r in labels if r["quality"] == 1]
    bad = [r["doc_id"] for r in labels if r["quality"] == 0]
    assert sum(i in kept for i in good) >= 0.98 * len(good)
    assert sum(i in kept for i in bad) <= 0.1 * len(bad)


def plain_fingerprint(text):
    """Contract of the operator, spelled out."""
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(
        1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)
    )


def test_near_copies_against_all_pairs(spark, tmp_path):
    """Groups by all pairs of fingerprints; the smallest id of each stays, whole."""
    draw = random.Random(5)
    folder = FOLDER.replace("0.001", "0.01")
    table = queries.table(spark, folder, "documents")
    rows = [tuple(r) for r in table.filter("n_chars > 2000").limit(150).collect()]
    for r in list(rows):
        words = r[1].split(" ")
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = "changed"
        rows.append((100_000 + r[0], " ".join(words), *r[2:]))
    rows += [rows[0], (None, rows[1][1], "en", "a", 1), (7, "", None, None, 0), (None, None, None, None, None)]
    rows += [(500_000 + i, f"one two three four {i}", "en", "a", 20) for i in range(30)]
    prints = [plain_fingerprint(r[1]) for r in rows]
    part = list(range(len(rows)))

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                part[root(i)] = root(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(root(i), []).append((r[0] is None, r[0] or 0))
    docs = written(spark, spark.createDataFrame(rows, table.schema), tmp_path, "near")
    found = STAGES["near_copies"](spark, docs, folder).collect()
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in found)
    assert kept == sorted(min(g) for g in groups.values())
    assert 100 < len(groups) < len(rows) - 50
    assert {tuple(r) for r in found} <= set(rows)


def test_one_large_group_of_near_copies(spark, tmp_path):
    """Twenty thousand texts of one group: rows stay linear, one text stays."""
    base = [f"w{i}" for i in range(400)]
    rows = []
    for n in range(20_000):
        words = list(base)
        words[n % 400] = f"x{n}"
        rows.append((n, " ".join(words)))
    docs = written(spark, spark.createDataFrame(rows, "doc_id long, text string"), tmp_path, "large")
    found = simhash.simhash_components(docs)
    groups = found.groupBy("component_id").count().orderBy(F.desc("count")).collect()
    assert groups[0]["component_id"] == 0 and groups[0]["count"] > 19_000
    links = simhash.near_links(found.select("fp").distinct(), simhash.block_keys(64, 6, 2), 4)
    assert links.count() <= 2 * 15 * found.select("fp").distinct().count()


def test_leaks_go(spark):
    docs = queries.table(spark, FOLDER, "documents")
    kept = {r["doc_id"] for r in STAGES["benchmark_leaks"](spark, docs, FOLDER).collect()}
    items = [r["text"] for r in queries.table(spark, FOLDER, "benchmark").collect()]
    assert kept == {r["doc_id"] for r in docs.collect() if not any(b in r["text"] for b in items)}


def test_mixture_repeats_whole_rows(spark):
    docs = queries.table(spark, FOLDER, "documents")
    found = STAGES["mixture"](spark, docs, FOLDER)
    assert found.columns == docs.columns
    often = {r["doc_id"]: r["count"] for r in found.groupBy("doc_id").count().collect()}
    taken = queries.op10_golden_mix(spark, FOLDER).filter("size > 0").collect()
    for r in taken:
        assert abs(often.get(r["doc_id"], 0) - r["taken"] / r["size"]) <= 0.5


@pytest.mark.parametrize("name", STAGES)
def test_empty_and_odd_rows(spark, odd, tmp_path, name):
    docs = written(spark, odd, tmp_path, "odd")
    found = STAGES[name](spark, docs, FOLDER)
    own = [c for c in found.columns if name != "shards" or c not in ("curve", "shard", "slot")]
    assert set(own) <= set(docs.columns)
    assert found.count() <= 2 * docs.count()
    if name != "shards":
        # Values too: columns named as results and helpers come back as they were.
        assert found.schema == docs.schema
        assert found.distinct().exceptAll(docs.distinct()).isEmpty()
    else:
        assert found.count() == docs.count()
    empty = written(spark, odd.limit(0), tmp_path, "empty")
    assert STAGES[name](spark, empty, FOLDER).count() == 0
