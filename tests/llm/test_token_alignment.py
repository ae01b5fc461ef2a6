"""Token alignment against a plain version that encodes whole texts."""

from collections import Counter
from functools import cache
from hashlib import sha256

import numpy as np
import pytest
from corpus_fixtures import FOLDER, odd  # noqa: F401
from loanloom.llm import token_alignment as ta
from tokenizers import Tokenizer


@pytest.fixture(scope="module")
def two():
    return ta.TwoTokenizers(*ta.read_vocabularies(ta.TOKENIZERS))


@cache
def plain_encoder():
    encoder = Tokenizer.from_file(f"{ta.TOKENIZERS}/{ta.BYTE_LEVEL}")
    encoder.encode_special_tokens = True
    return encoder


def plain_tokens(two, text):
    """Ids and byte ranges of both; none if the bytes differ."""
    if not text:
        return [], []
    a = plain_encoder().encode(f" {text}", add_special_tokens=False).ids
    b = two.b.encode(text)
    found = []
    for ids, of in ((a, two.a_bytes), (b, two.b_bytes)):
        if b"".join(of[i] for i in ids) != f" {text}".encode():
            return [], []
        ends = np.cumsum([len(of[i]) for i in ids]).tolist()
        found.append(list(zip(ids, [0, *ends], ends)))
    return found


def plain_links(a, b):
    """All pairs of overlapping tokens, by two pointers."""
    links, j = [], 0
    for i, begin, end in a:
        while j and b[j][1] > begin:
            j -= 1
        while b[j][2] <= begin:
            j += 1
        k = j
        while k < len(b) and b[k][1] < end:
            links.append((i, b[k][0]))
            k += 1
    return links


def plain_groups(a, b):
    ends = sorted({t[2] for t in a} & {t[2] for t in b})
    begin, groups = 0, []
    for end in ends:
        parts = [",".join(str(i) for i, s, e in t if begin <= s and e <= end) for t in (a, b)]
        groups.append("|".join(parts))
        begin = end
    return groups


def plain_rows(two, rows):
    tokens = [plain_tokens(two, text) for _, text in rows]
    links = [plain_links(*t) for t in tokens]
    counts = Counter(pair for found in links for pair in found)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for (doc_id, _), (a, b), found in zip(rows, tokens, links):
        groups = plain_groups(a, b)
        best = sum(counts[pair] == highest[pair[1]] for pair in found)
        digest = sha256(";".join(groups).encode()).hexdigest() if groups else ""
        total = sum(counts[pair] for pair in found)
        out.append((doc_id, len(a), len(b), len(groups), len(found), best, total, digest))
    return sorted(out, key=str), counts


ODD = [
    (1, "Plain words, and more words."),
    (1, "Plain words, and more words."),
    (2, ""),
    (3, None),
    (None, "no id 123 4567"),
    (4, "  two  spaces\n\nlines \n x\ty  "),
    (5, " "),
    (6, "\n"),
    (7, "naïve 中文 \U0001f600\U0001f600 \U0001f468‍\U0001f469 é"),
    (8, "a ▁ b▁ c"),
    (9, "<|endoftext|> <s> </s> <0x41> <unk>"),
    (10, "nbsp  x y 　z\u0085 w\x1c v\x1f \x00 q"),
    (11, "x" * 5000),
    (12, "can't WON'T it's  I'll"),
    (13, "word " * 3000),
    (14, "trailing "),
    (15, " leading"),
]


def rows_of(found):
    return sorted([tuple(r) for r in found.collect()], key=str)


@pytest.mark.parametrize("most_broadcast", [ta.MOST_BROADCAST, 0])
def test_against_whole_texts(spark, two, most_broadcast):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()] + ODD
    found, counts = ta.aligned_documents(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(5),
        most_broadcast=most_broadcast,
    )
    wanted, links = plain_rows(two, rows)
    assert rows_of(found) == wanted
    listed = {(r.a_id, r.b_id): r.links for r in counts.as_rows().collect()}
    assert listed == dict(links) and counts.pairs == len(links)


def test_small_memory_and_many_leaves(spark, two, monkeypatch):
    """Pieces forgotten midway, sums over several steps, shards of few pairs."""
    monkeypatch.setattr(ta, "SHARD_PAIRS", 64)
    monkeypatch.setattr(ta, "LEAF_PAIRS", 4)
    monkeypatch.setattr(ta, "FAN_IN", 2)
    rows = [(i, f"{t or ''} {i % 7}") for i, (_, t) in enumerate(ODD[:10] * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    for most in (ta.MOST_BROADCAST, 0):
        found, _ = ta.aligned_documents(docs, most_broadcast=most)
        assert rows_of(found) == plain_rows(two, rows)[0]


def test_forgetting(two, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(ta, "REMEMBERED", 3)
    monkeypatch.setattr(ta, "CHARS_AT_ONCE", 10)
    texts = ["one two three", "two three four", "five six seven eight", "one one two", "a ▁"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5)), pa.array(texts)], ["doc_id", "text"])
    task = ta._count_links(lambda: ta.read_vocabularies(ta.TOKENIZERS))
    counts = Counter()
    for out in task(iter([batch])):
        for pair, links in zip(*[c.to_pylist() for c in out.columns]):
            counts[pair >> 32, pair & 0xFFFFFFFF] += links
    assert counts == plain_rows(two, list(enumerate(texts)))[1]


def test_hash_is_minimal_and_perfect():
    draw = np.random.default_rng(1)
    pairs = np.unique(draw.integers(0, 1 << 48, 20_000))
    shard = ta.shard_of(pairs, 3)
    shards = []
    for at in (2, 0, 1):
        sizes, bits, kept = ta.perfect_hash(pairs[shard == at])
        counts = (kept % 1000).tobytes()
        packed = np.packbits(bits).tobytes()
        shards.append(dict(shard=at, sizes=sizes, bits=packed, pairs=kept.tobytes(), counts=counts))
    table = ta.PairTable(shards, 3)
    index = table.index(pairs, shard)
    assert sorted(index.tolist()) == list(range(len(pairs)))
    assert (table.count_of(pairs) == pairs % 1000).all()
    strangers = np.setdiff1d(draw.integers(0, 1 << 48, 20_000), pairs)
    assert (table.index(strangers, ta.shard_of(strangers, 3)) == -1).all()
    assert not table.count_of(strangers).any()


def test_empty_and_clashing(spark, odd, two):
    empty, counts = ta.aligned_documents(odd.limit(0))
    assert empty.collect() == [] and counts.as_rows().collect() == []
    none = spark.createDataFrame([(1, None), (2, "▁")], "doc_id long, text string")
    for most in (ta.MOST_BROADCAST, 0):
        found, _ = ta.aligned_documents(none, most_broadcast=most)
        assert rows_of(found) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    found, _ = ta.aligned_documents(odd)
    assert rows_of(found) == plain_rows(two, rows)[0]
