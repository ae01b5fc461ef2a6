"""Every corpus query on the smallest tables: against SQL where there is some, and with
the columns, rows and rules of its contract."""

import __spark_entry__ as driver
import pytest
from compare import compare, connect
from corpus_fixtures import FOLDER, folder_of, odd  # noqa: F401
from loanloom.llm import oracles, queries
from pyspark.sql import functions as F


def test_all_are_registered():
    names = set(queries.QUERIES) | {"pipeline"}
    assert names <= set(driver.queries())
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", oracles.SQL)
def test_against_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, FOLDER), connect(FOLDER), oracles.SQL[name]) == ""


@pytest.mark.parametrize(
    "name, columns, table",
    [
        ("op3_hilbert", "doc_id size text_crc32 law shard slot grown_shard", "documents"),
        ("op5_simhash", "doc_id fingerprint component_id", "documents"),
        ("op7_secrets", "doc_id n_assign n_access n_hex base_sha256 spans", "documents"),
        ("op8_language_viterbi", "doc_id held_out lang_pred score", "documents"),
        ("op9_factorisation", "doc_id held_out score predicted", "documents"),
        ("op10_golden_mix", "doc_id size source_size target taken", "documents"),
        (
            "op11_token_alignment",
            "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256",
            "documents",
        ),
        (
            "op12_line_cleaning",
            "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
            "documents",
        ),
        (
            "op13_merkle_manifest",
            "doc_id leaf subroot root proof_sha256 folded_root verified",
            "documents",
        ),
    ],
)
def test_one_row_each(spark, name, columns, table):
    ids = queries.table(spark, FOLDER, table).select("doc_id")
    found = queries.QUERIES[name](spark, FOLDER)
    assert set(columns.split()) <= set(found.columns)
    found = found.select("doc_id")
    assert found.exceptAll(ids).count() == 0 and ids.exceptAll(found).count() == 0


def empty_tables(spark):
    return {
        name: queries.table(spark, FOLDER, name).limit(0)
        for name in ("documents", "pages", "benchmark", "labels")
    }


@pytest.mark.parametrize("name", queries.QUERIES)
def test_empty_tables(spark, folder_of, name):
    folder = folder_of(**empty_tables(spark))
    assert queries.QUERIES[name](spark, folder).count() == 0


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n not in ("op2_warc", "op4_url_trie")])
def test_odd_documents(spark, odd, folder_of, name):
    tables = {**empty_tables(spark), "documents": odd}
    found = queries.QUERIES[name](spark, folder_of(**tables))
    assert found.count() == (0 if name.startswith("op1_") else odd.count())


@pytest.mark.parametrize("name", ["op2_warc", "op4_url_trie"])
def test_odd_pages(spark, folder_of, name):
    rows = [
        (1, "http://A.example.org/es/1", "x" * 200),
        (2, None, "x" * 200),
        (2, None, "x" * 200),
        (3, "no scheme", None),
        (None, "://", "x" * 200),
        (4, "http://h\r\nX: y/", ""),
        (5, "http://h/", "y" * 3_000_000),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages = pages.withColumns({n: F.lit(1) for n in ("host", "rule", "payload", "digest", "size")})
    found = queries.QUERIES[name](spark, folder_of(pages=pages))
    assert found.count() == len(rows)
    con_rows = {r["page_id"]: r for r in found.collect()}
    if name == "op2_warc":
        assert con_rows[2]["record_type"] == "revisit" and con_rows[2]["refers_to"] == 1
        assert con_rows[None]["record_type"] == "revisit"
        assert con_rows[1]["record_type"] == con_rows[3]["record_type"] == "response"
        assert con_rows[5]["payload_bytes"] == 3_000_000 and con_rows[3]["payload_bytes"] == 0
    else:
        assert con_rows[1]["host"] == "a.example.org" and con_rows[1]["verdict"] == "block"
        assert con_rows[3]["host"] == "" and con_rows[3]["rule"] is None
