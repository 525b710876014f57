import pytest

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `row` string, size string, rest string"


@pytest.fixture(scope="session")
def documents(spark, small_dir):
    return spark.read.parquet(f"{small_dir}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, ties, repeats, clashing names."""
    long = " ".join(f"w{k}" for k in range(30_000)) + " " + "x" * 50_000
    same = " ".join(f"s{k % 40}" for k in range(60)) + "."
    rows = [
        (1, same, "en", "a", 1, "r", "s", "t"),
        (1, same, "en", "a", 1, "r", "s", "t"),
        (1, "other text of the same number", "en", None, None, None, None, None),
        (None, same, None, None, None, "r", None, None),
        (None, None, None, None, None, None, None, None),
        (2, "", "en", "b", 0, "", "", ""),
        (3, " \t\n ", "en", "b", 0, "", "", ""),
        (4, long, "en", "a", 5, "", "", ""),
        (5, long + " end", "en", "a", 5, "", "", ""),
        (6, "one two", None, "c", 7, "", "", ""),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(odd):
    return odd.filter(F.lit(False))
