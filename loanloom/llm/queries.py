"""The registered queries of the corpus operators."""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import factorisation, language_id
from loanloom.llm.common import checkpointed, shared_folder, training_row
from loanloom.llm.decontamination import leaks
from loanloom.llm.exact_dedup import exact_duplicates
from loanloom.llm.hilbert import LAW, by_logarithm, by_range, by_value, hilbert_shards
from loanloom.llm.line_cleaning import clean_documents
from loanloom.llm.merkle import manifest_proofs
from loanloom.llm.mixing import mix
from loanloom.llm.secret_scan import KINDS, count_of, joined_spans, scan_secrets
from loanloom.llm.simhash import hex_of, simhash_components
from loanloom.llm.token_alignment import aligned_documents
from loanloom.llm.url_rules import ALLOW, BLOCK, Rule, judge_urls
from loanloom.llm.warc import page_id_of, read_warc, write_warc

Query = Callable[[SparkSession, str], DataFrame]

#: The rules of the URL query.
URL_RULES = (
    Rule(ALLOW, "org", "/"),
    Rule(BLOCK, "example.org", "/es/"),
    Rule(BLOCK, "example.org", "/en/1"),
    Rule(ALLOW, "com", "/fr/"),
    Rule(BLOCK, "com", "/de/"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_template_leaks(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is or with other values."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = leaks(docs, table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "matched", "item_tokens", "exact", "slots")


def op2_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Pages written as archives to the shared folder and read back."""
    path = f"{shared_folder(spark)}/warc-{uuid4().hex}"
    write_warc(table(spark, folder, "pages"), path)
    records = read_warc(spark, path, keep_payload=False)
    broken = F.concat_ws(" ", "archive", "position", "error")
    payload_bytes = F.when(F.col("error").isNotNull(), F.raise_error(broken)).otherwise(
        F.col("payload_bytes")
    )
    return records.select(
        page_id_of(F.col("record_id")).alias("page_id"),
        payload_bytes.cast("long").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        page_id_of(F.col("refers_to_id")).alias("refers_to"),
    )


def op3_hilbert(spark: SparkSession, folder: str) -> DataFrame:
    """All documents in 40 shards along a curve over source, language, length and id."""
    docs = table(spark, folder, "documents")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = checkpointed(
        docs.select(
            "doc_id",
            "source",
            "lang",
            "n_chars",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
        )
    )
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    bits = 4
    dimensions = [
        by_value(F.col("source"), bits),
        by_value(F.col("lang"), bits),
        by_logarithm(F.col("n_chars"), bits, 1 << 24),
        by_range(F.col("doc_id"), low, high, bits),
    ]
    sharded = hilbert_shards(rows, dimensions, ["doc_id", "text_crc32", "size"], 40, bits)
    return sharded.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def op4_url_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every page's URL against the rules."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = judge_urls(pages, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint and the component its links reach."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = simhash_components(docs, shingle=4, parts=1, radius=4)
    return found.select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op6_grace(spark: SparkSession, folder: str) -> DataFrame:
    """Every document with the group of its text."""
    return exact_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's secrets: known forms and random tokens."""
    found = scan_secrets(table(spark, folder, "documents").select("doc_id", "text"))
    spans = F.col("found")
    return found.select(
        "doc_id",
        *[count_of(spans, kind).alias(f"n_{kind}") for kind in KINDS[:3]],
        F.sha2(joined_spans(spans, KINDS[:3]), 256).alias("base_sha256"),
        joined_spans(spans).alias("spans"),
    )


def op8_language_viterbi(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's language, learned from two thirds of the documents."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs)
    found = language_id.identify_languages(docs, model)
    return found.select("doc_id", _held_out(), "lang_pred", "score", "spans")


def op9_factorisation(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's quality, learned from the labels of two thirds."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "n_chars")
    scored = factorisation.classify_quality(docs, table(spark, folder, "labels"))
    return scored.select("doc_id", _held_out(), "score", "predicted")


def _held_out() -> Column:
    """Whether the row's remainder is the one never learned from; false without an id."""
    known = F.col("doc_id").isNotNull()
    return (known & ~training_row(F.col("doc_id"))).alias("held_out")


def op10_golden_mix(spark: SparkSession, folder: str) -> DataFrame:
    """What the mix takes of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "source")
    report, _ = mix(docs)
    return report.select("doc_id", "size", "source_size", "target", "taken")


def op11_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's tokens, links and how frequent these are in the corpus."""
    found, _ = aligned_documents(table(spark, folder, "documents"))
    return found


def op12_line_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's counts, failing lines and verdict."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return clean_documents(docs, with_text=False).drop("clean_text")


def op13_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every document proved against the manifest; some are shown with another length."""
    docs = table(spark, folder, "documents")
    marked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    length = F.col("n_chars").cast("decimal(20,0)")
    shown = {"n_chars": F.when(marked, length + 1).otherwise(length)}
    path = f"{shared_folder(spark)}/manifest-{uuid4().hex}"
    proofs = manifest_proofs(docs, path, shown=shown)
    return proofs.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"
    )


QUERIES: dict[str, Query] = {
    "op1_template_leaks": op1_template_leaks,
    "op2_warc": op2_warc,
    "op3_hilbert": op3_hilbert,
    "op4_url_trie": op4_url_trie,
    "op5_simhash": op5_simhash,
    "op6_grace": op6_grace,
    "op7_secrets": op7_secrets,
    "op8_language_viterbi": op8_language_viterbi,
    "op9_factorisation": op9_factorisation,
    "op10_golden_mix": op10_golden_mix,
    "op11_token_alignment": op11_token_alignment,
    "op12_line_cleaning": op12_line_cleaning,
    "op13_merkle_manifest": op13_merkle_manifest,
}
