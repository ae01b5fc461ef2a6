"""One call for the whole batch: every message scored once, bad input refused."""

import json

import pytest
from loanloom.plans.triage import score_messages, triage_decided
from loanloom.plans.triage_batch import report_batch, run_triage
from loanloom.samples.triage import BOOK, length_scorer
from loanloom.sources.layers import Layers
from loanloom.sources.messages import parse_decisions


def line(number, **changes):
    fields = {
        "id": f"m{number}",
        "channel": "chat",
        "received_at": "2024-01-01T10:00:00Z",
        "from": "a",
        "text": "hola " + "x" * number,
    }
    return json.dumps({**fields, **changes})


def counting(path):
    inner, path = length_scorer(), str(path)

    def score(text):
        with open(path, "a") as calls:
            calls.write(text + "\n")
        return inner(text)

    return score


def test_scored_once_and_ordered_by_instant(spark, tmp_path):
    stamps = {
        1: "2024-01-01T12:00:00Z",
        2: "2024-01-01T10:00:00-05:00",
        3: "2024-01-01T11:00:00Z",
    }
    (tmp_path / "in").mkdir()
    text = "\n".join(line(n, received_at=stamp) for n, stamp in stamps.items())
    (tmp_path / "in" / "a.jsonl").write_text(text + "\n")
    calls = tmp_path / "calls"
    summary = run_triage(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), counting(calls), BOOK
    ).first()
    assert summary["message_count"] == summary["total_messages"] == 3 and summary["complete"]
    assert len(calls.read_text().splitlines()) == 3
    files = sorted((tmp_path / "out" / "report" / "results").glob("part-*.json"))
    rows = [json.loads(x) for f in files for x in f.read_text().splitlines()]
    assert [(r["id"], r["position"]) for r in rows] == [("m3", 1), ("m1", 2), ("m2", 3)]
    assert len(calls.read_text().splitlines()) == 3


def test_scoring_joins_nothing(planned, tmp_path):
    calls = tmp_path / "calls"
    rows = [(f"m{n}", "2024-01-01T10:00:00", "hola " + "x" * n) for n in range(40)]
    messages = planned.createDataFrame(rows, "id string, received_at string, text string")
    decided = parse_decisions(score_messages(messages, counting(calls)))
    results = triage_decided(decided, BOOK)
    plan = results._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
    assert plan.count("parse_json") <= 1
    layers = Layers(planned, str(tmp_path / "out"))
    report_batch(messages, layers, counting(calls), BOOK).collect()
    assert sorted(calls.read_text().splitlines()) == sorted(t for _, _, t in rows)


@pytest.mark.parametrize("bad", ["{", line(1), line(2, channel="fax")])
def test_bad_input_is_refused_before_scoring(spark, tmp_path, bad):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.jsonl").write_text(line(1) + "\n" + bad + "\n")
    calls = tmp_path / "calls"
    with pytest.raises(Exception, match="message"):
        run_triage(spark, str(tmp_path / "in"), str(tmp_path / "out"), counting(calls), BOOK)
    assert not calls.exists()
