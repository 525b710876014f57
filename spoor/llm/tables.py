"""Intermediate tables that outlive lost executors."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor.session import shared_folder


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: its lineage ends there."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_key() -> Column:
    """What tells the texts of rows with one doc_id apart (null and empty text differ)."""
    return F.xxhash64(F.coalesce(F.col("text"), F.lit("\x00null")))


def word_count(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text (null: 0), by built-in functions."""
    bare = F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))
    return (
        F.when(text.isNull() | (bare == ""), F.lit(0))
        .otherwise(F.size(F.split(bare, "[\\x20\\x09-\\x0D]+")))
        .cast("long")
    )
