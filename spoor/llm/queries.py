"""The operators' registered queries, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from spoor.llm import chat, decontamination, infill, licenses, merkle, mixing, near, pieces, quality, resampling, rules, substrings, toxicity
from spoor.llm.oracles import ORACLE  # noqa: F401  (part of this module's interface)

QUERIES: dict = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    chain = toxicity.train(docs, table(spark, sf_dir, "labels"))
    found = toxicity.scored(docs.select("doc_id", "text"), chain)
    return found.select("row.doc_id", *[f"p_{c}" for c in chain.categories], "rejected", (~F.col("rejected")).alias("kept"))


@query
def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mixed(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    shards = F.array_join(F.expr("transform(draws, d -> cast(d.shard AS string))"), ",")
    return found.select(
        "row.doc_id", "size", "source_size", "target", "taken", "row.source", F.coalesce(shards, F.lit("")).alias("shards")
    )


@query
def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licenses(table(spark, sf_dir, "documents")).drop("text_key")


@query
def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("rest.doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@query
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprints(table(spark, sf_dir, "documents"))


@query
def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pieces.encoded(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_pieces", "ids", "round_trip")


@query
def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(table(spark, sf_dir, "documents")).drop("cleaned")


@query
def op9_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = chat.turns_as_calls(table(spark, sf_dir, "conversations"))
    found = chat.linked(calls, results, chat.TURN_SCHEMAS)
    return found.withColumn("errors", F.array_join("errors", ", "))


@query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), 85).drop("text_key")


@query
def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.found(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    gain = resampling.gains(docs, table(spark, sf_dir, "benchmark"))
    found = resampling.scored(docs, gain, keep=["doc_id"]).drop("row")
    return resampling.ranked(found).select("doc_id", "n_features", "weight", "score", "rank")


@query
def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = infill.transformed(table(spark, sf_dir, "documents"), keep=["doc_id"], with_output=False)
    return found.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
