"""Documents to training shards in five stages.

Each stage takes the documents that the one before it kept, written as Parquet and read
again, and returns the same columns; the last one adds the shard.
"""

from __future__ import annotations

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import decontamination, factorisation, hilbert, mixing, simhash
from loanloom.llm.common import shared_folder

#: Near copies, as the operator's contract has them: four-word shingles, and at most four
#: of 64 bits apart, which its tables find without a miss.
SHINGLE, RADIUS = 4, 4
SHARDS, BITS = 40, 4


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out what the factorisation machine holds for low quality.

    Null texts count as empty; rows alike share their fate, and columns of any name keep
    their values. Without labels every score is a half, and all rows stay.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return factorisation.good_documents(docs, labels)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of each group of near copies.

    Groups are what links of near fingerprints reach. Texts without words, null ones
    too, are one group; of several rows with the smallest id one stays, and a null id
    ranks last. All columns are kept.
    """
    components = simhash.simhash_components(docs, shingle=SHINGLE, radius=RADIUS)
    return simhash.one_of_each(docs, components)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that hold a benchmark item, also with other values.

    Null and empty texts hold none; rows alike go together, a null id does not matter.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.without_leaks(docs, decontamination.leaks(docs, items))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their source takes them.

    Texts without words have no size and go; a null source is one of the sources; rows
    alike are taken each on its own.
    """
    report, _ = mixing.mix(docs)
    return mixing.resampled(docs, report)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds ``curve``, ``shard`` and ``slot``, in the place of columns of these names.

    Nulls have a cell of their own in every dimension; ties are ordered by id, source,
    language and length, rows alike in these in any order. A table without rows gives none.
    """
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    dimensions = [
        hilbert.by_value(F.col("source"), BITS),
        hilbert.by_value(F.col("lang"), BITS),
        hilbert.by_logarithm(F.col("n_chars"), BITS, 1 << 24),
        hilbert.by_range(F.col("doc_id"), low, high, BITS),
    ]
    order = ["doc_id", "source", "lang", "n_chars"]
    return hilbert.hilbert_shards(docs, dimensions, order, SHARDS, BITS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_copies", near_copies),
    ("benchmark_leaks", benchmark_leaks),
    ("mixture", mixture),
    ("shards", shards),
]

#: XXH64 and the fitted model are out of SQL's reach; the tests compare each stage with
#: a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what stands between them is in the shared folder."""
    folder = f"{shared_folder(spark)}/pipeline-{uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
