import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use inside.
        T.StructField("row_key", T.StringType()),
        T.StructField("copy", T.StringType()),
        T.StructField("ids", T.StringType()),
        T.StructField("n", T.StringType()),
        T.StructField("packed", T.StringType()),
    ]
)


def passage(seed: int, words: int) -> str:
    """Words without repeats inside one passage."""
    return " ".join(f"w{seed}x{i}" for i in range(words))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and very long texts, ties, repeated rows."""
    long = passage(1, 30_000)
    base = passage(2, 120)
    rows = [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),  # a repeated row
        (3, None, "en", "a"),
        (4, "", None, "b"),
        (5, " \t\n\x0b\x0c\r ", "de", None),
        (6, long, "de", "b"),
        (7, long + " end", "de", "b"),
        (8, "One two", "en", "a"),
        (9, "one TWO", "en", "a"),
        (10, "x" * 40_000, "en", "a"),
        (11, passage(3, 70) + " " + base + " " + passage(4, 70), None, None),
        (12, "line one\nline one\nline one\n### $$$ %%%", "en", "a"),
        (None, base, "en", "a"),
        (None, None, None, None),
        (13, "déjà vu É   中文 no break", "fr", "c"),
    ]
    return [(i, t, g, s, None if t is None else len(t), "k", "c", "i", "n", "p") for i, t, g, s in rows]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS).repartition(3).cache()


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}
