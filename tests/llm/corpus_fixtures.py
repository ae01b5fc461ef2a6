"""Fixtures for the corpus tests; test modules import them by name."""

import pytest
from pyspark.sql import functions as F

FOLDER = "/root/testdata/sf0.001"

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
    (2, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a"),
    (3, "", "en", "a"),
    (4, None, None, None),
    (5, None, "fr", "b"),
    (None, "no id at all", "en", None),
    (None, None, None, None),
    (6, "word " * 30000, "en", "b"),
    (7, "élève \U0001f600 中文 naïve", "fr", "b"),
    (8, " \t\n\x0b ", "en", "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, and columns of clashing names."""
    df = spark.createDataFrame(TEXTS, "doc_id long, text string, lang string, source string")
    return clashing(df.withColumn("n_chars", F.length("text").cast("long")))


def clashing(df):
    """Extra columns named as results and helpers are."""
    names = (
        "size slot shard curve taken target copy words score predicted kept fp key row "
        "content digest count component_id label place host path rule verdict bucket cell "
        "_id _row _place _source _leak_id text_key found spans"
    )
    taken = set(df.columns)
    return df.select(
        "*", *[F.lit(i).alias(n) for i, n in enumerate(names.split()) if n not in taken]
    )


@pytest.fixture(scope="session")
def folder_of(spark, tmp_path_factory):
    """Writes tables as a folder of Parquet files, as the queries read them."""

    def written(**tables):
        folder = str(tmp_path_factory.mktemp("tables"))
        for name, df in tables.items():
            df.write.parquet(f"{folder}/{name}.parquet")
        return folder

    return written
