"""Line-first cleaning: rules by example, windows against a plain count."""

import random
from collections import Counter

import pytest
from loanloom.llm.line_cleaning import (
    clean_documents,
    clean_text,
    kept_documents,
    line_fault,
    repeated_words,
)

PROSE = "The river runs through the old town, and the people there like it well."


@pytest.mark.parametrize(
    "line, following, fault",
    [
        (PROSE, "", None),
        ("Short one.", "", None),
        ("„Wirklich?“", "", None),
        ("真的吗？", "", None),
        ("no end here", "", "punctuation"),
        ("this line of a wrapped text goes", "on", None),
        ("this line of a wrapped text goes", "On", "punctuation"),
        ("too short", "on", "punctuation"),
        ("word### other*** word%%% more&&&.", "", "punctuation"),
        ("Home | About | Contact | Help", "", "navigation"),
        ("Home » News » Sport today", "", "navigation"),
        ("Skip to content", "", "navigation"),
        ("Next >", "", "navigation"),
        ("One long sentence may hold a | bar and another | bar without being a menu of any kind at all.", "", None),
        ("© 2020 Some Firm. All rights reserved.", "", "boilerplate"),
        ("Please ENABLE JavaScript.", "", "boilerplate"),
        (("word " * 41) + "all rights reserved.", "", None),
    ],
)
def test_rules(line, following, fault):
    assert line_fault(line, line.split(), following) == fault


def test_lines_go_and_the_rest_stays():
    text = f"Home | News | Sport\n{PROSE}\n\n  {PROSE}\nread more"
    words, cleaned = clean_text(text)
    assert cleaned.text == f"{PROSE}\n\n  {PROSE}"
    assert len(words) == 35 and cleaned.n_dup_lines == 0
    assert cleaned.faults == {"punctuation": 0, "navigation": 2, "boilerplate": 0}
    assert cleaned.lost_chars == len("Home|News|Sport") + len("readmore")


def test_only_equal_lines_are_repeated():
    assert clean_text("a b.\na b. \na b.\n\n\n \na b.")[1].n_dup_lines == 2


def plain_repeated(words, window=8):
    windows = [tuple(words[i : i + window]) for i in range(len(words) - window + 1)]
    times = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(window)})


def test_repeated_words_against_plain_count():
    draw = random.Random(3)
    texts = [[], ["a"] * 7, ["a"] * 8, ["a"] * 9, list("abcdefgh") * 2, list("abcdefgh")]
    for _ in range(300):
        texts.append(draw.choices("ab" if draw.random() < 0.5 else "abc", k=draw.randrange(60)))
    # A window that two texts share, or that spans two texts, is no repetition.
    texts += [list("qrstuvwxyz"), list("qrstuvwxyz")]
    assert repeated_words(texts) == [plain_repeated(t) for t in texts]
    assert repeated_words(texts[:2]) == [0, 0] and repeated_words([]) == []


def test_verdicts(spark):
    menu = "\n".join(f"Home | Part{i} | Sport{i}" for i in range(12))
    rows = [
        (1, f"{PROSE} {PROSE.upper()}"),
        (2, PROSE),
        (3, f"{PROSE} {PROSE.upper()}\n{menu}"),
        (4, " ".join([PROSE] * 3)),
        (5, None),
        (6, ""),
        (None, f"{PROSE} {PROSE.upper()}"),
        (1, f"{PROSE} {PROSE.upper()}\nread more"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = clean_documents(docs).collect()
    by_id = {(r.doc_id, r.n_navigation): r for r in found}
    assert len(found) == len(rows)
    assert by_id[1, 0].kept and by_id[1, 1].kept and by_id[None, 0].kept
    assert by_id[2, 0].base_failed and not by_id[2, 0].kept
    assert not by_id[3, 12].base_failed and not by_id[3, 12].kept
    assert by_id[4, 0].base_failed and by_id[4, 0].n_repeat_words == by_id[4, 0].n_words
    assert by_id[5, 0].n_words == by_id[6, 0].n_words == 0 and by_id[5, 0].base_failed
    kept = kept_documents(docs).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [
        (0, rows[0][1]), (1, rows[0][1]), (1, rows[0][1]),
    ]
