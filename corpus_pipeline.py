"""From documents to training ids: toxicity, near duplicates, repeats, mix, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from spoor.llm import mixing, near, pieces, substrings, toxicity
from spoor.llm.tables import written

ORACLE_SQL = None
"""SQL has neither the classifier nor the merges; tests compare with plain loops."""

NEAR_PERCENT = 80
"""The least similarity of near duplicates, in percent."""


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain does not reject."""
    chain = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, chain)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, at a similarity of 0.8 or more."""
    return near.without_near_duplicates(docs, NEAR_PERCENT)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere too."""
    return substrings.cleaned(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources; a document has a row for each time it is taken."""
    return mixing.mixture(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix with its ids. Columns of docs with the names of the results make way."""
    made = ("ids", "n_pieces", "round_trip")
    return pieces.encoded(docs.drop(*made)).select("row.*", *made)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("substring dedup", cut_repeats),
    ("mixing", mix_sources),
    ("encoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each writes a table that the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
