import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
BASE = ("the quick brown fox jumps over the lazy dog while seven wizards quietly mix strong liquid jade potions before "
        "dawn breaks over distant frozen hills and rivers run slowly towards the old grey sea").split()


def passage(seed: int, n: int) -> str:
    return " ".join(f"{BASE[(seed * 7 + i * (seed % 5 + 1)) % len(BASE)]}{(seed * 31 + i) % 97}" for i in range(n))


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty, blank and very long texts, ties, copies and repeated rows, clashing extra columns."""
    shared = passage(3, 60)
    rows = [
        (1, shared + " tail one", "en", "a", 5), (2, "head two " + shared, "en", "a", None), (3, None, "en", "a", 0),
        (4, "", "en", None, 0), (5, " \n\t ", None, "b", 3), (None, passage(8, 40), "fr", "b", 1), (None, None, None, None, None),
        (6, passage(9, 30), "fr", "b", 9), (7, passage(9, 30), "fr", "b", 9), (7, passage(9, 30), "fr", "b", 9),
        (8, passage(11, 6000), "fr", "a", 1), (9, "word", "en", "a", 4), (10, "12 34 !!", "en", "a", 8),
        (11, "çà et là 日本語 😀", "fr", "b", 2), (12, "rep eat " * 300, "en", "a", 7),
        (13, passage(20, 50), "en", "a", 1), (14, passage(20, 49) + " changed", "en", "a", 1), (7, "same id, other text", "en", "b", 1),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("d", "x", "t", "h", "raw", "value", "score", "n_words", "n_tokens", "shard", "findings", "spans", "_row", "_k0", "_h", "_n", "_d", "_x", "_id", "a.b"):
        docs = docs.withColumn(name, F.lit(name))
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
