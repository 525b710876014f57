"""Capture tables: their schemas, reading them, and the nested form of a stream."""

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor.operators.spread import unbroadcast
from spoor.operators.writes import dedupe_commands

COLUMN = "struct<expr_id:bigint,col_name:string,is_partition:boolean>"
LEAF = "struct<leaf_ord:int,leaf_class:string,leaf_expr_id:bigint>"
INPUT = (
    "struct<leaf_pos:int,relation_class:string,in_db:string,in_table:string,"
    f"columns:array<{COLUMN}>>"
)
ENTRY = (
    "struct<out_pos:int,out_name:string,expr_id:bigint,n_children:int,expr_text:string,"
    f"leaves:array<{LEAF}>>"
)
# One executed write with all it read, for streams. Ids may be of any type that sorts.
RECORD_SCHEMA = (
    "write_id bigint, thread_id bigint, exec_ts timestamp, status string, "
    "command_class string, out_db string, current_db string, out_table string, "
    "query_root string, sql_text string, run_user string, "
    f"inputs array<{INPUT}>, projections array<{ENTRY}>"
)

TABLES = ("writes", "inputs", "relation_columns", "projections", "projection_leaves")


@dataclass(frozen=True)
class Capture:
    """The tables lineage is derived from, keyed by ``write_id``.

    ``inputs`` is unique on ``(write_id, leaf_pos)``, ``projections`` on
    ``(write_id, out_pos)``.
    """

    writes: DataFrame
    inputs: DataFrame
    relation_columns: DataFrame
    projections: DataFrame
    projection_leaves: DataFrame


def read_capture(spark: SparkSession, path: str, fmt: str = "parquet") -> Capture:
    """The capture tables stored below ``path``, one folder each."""
    return Capture(*[spark.read.format(fmt).load(f"{path}/{name}") for name in TABLES])


def write_capture(capture: Capture, path: str, mode: str = "append") -> None:
    for name in TABLES:
        getattr(capture, name).write.mode(mode).parquet(f"{path}/{name}")


def write_records(records: DataFrame, path: str, mode: str = "append") -> None:
    """Nested records as stored captures: each command once, rows of one outcome, class and
    query root together, so that a harvest's filters skip row groups.

    All that lineage needs of a write lies in its row, so that nothing is shuffled to read
    it back: ``harvest_records(read_records(...), dedupe=False)``.
    """
    kept = dedupe_commands(records)
    kept.sortWithinPartitions("status", "command_class", "query_root").write.mode(mode).parquet(path)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def parse_records(received: DataFrame, schema: str = RECORD_SCHEMA) -> DataFrame:
    """Nested write records from JSON in ``value``; see ``unparsed_records``."""
    value = F.col("value").cast("string")
    return (
        received.select(F.from_json(value, schema).alias("record"))
        .select("record.*")
        .filter(F.col("write_id").isNotNull())
    )


def unparsed_records(received: DataFrame, schema: str = RECORD_SCHEMA) -> DataFrame:
    """Rows of ``received`` that are not a write record."""
    write_id = F.from_json(F.col("value").cast("string"), schema)["write_id"]
    return received.filter(write_id.isNull())


def stream_capture(
    spark: SparkSession,
    path: str | None = None,
    schema: str = RECORD_SCHEMA,
    fmt: str = "parquet",
    **options,
) -> DataFrame:
    """A stream of nested write records.

    Files added to the folder ``path``, or with ``fmt="kafka"`` JSON messages of the
    topics named in ``options``.
    """
    stream = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return parse_records(stream.load(), schema)
    return stream.schema(schema).load(path)


def unnest(records: DataFrame) -> Capture:
    """The flat tables of nested write records."""
    inputs = records.select("write_id", F.inline("inputs"))
    entries = records.select("write_id", F.inline("projections"))
    return Capture(
        records.drop("inputs", "projections"),
        inputs.drop("columns"),
        inputs.select("write_id", "leaf_pos", F.inline("columns")),
        entries.drop("leaves"),
        entries.select("write_id", "out_pos", F.inline("leaves")),
    )


def nest(capture: Capture) -> DataFrame:
    """Nested write records of the flat tables; a record is one row by definition.

    Each table is shuffled once, on ``write_id``, to as many partitions as the session has:
    given by number, they are not put together by their compressed size, which says little
    of the nested rows that are sorted in them.
    """
    parts = int(capture.writes.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def with_rows(heads: DataFrame, rows: DataFrame, at: str, name: str) -> DataFrame:
        keys = ["write_id", at]
        head = F.struct(*[col for col in heads.columns if col not in keys]).alias("head")
        row = F.struct(*[col for col in rows.columns if col not in keys]).alias("row")
        both = heads.select(*keys, head).unionByName(rows.select(*keys, row), allowMissingColumns=True)
        # Rows without a head drop out; the write's partitioning serves its positions too.
        return (
            both.repartition(parts, "write_id")
            .groupBy(*keys)
            .agg(F.collect_list("head").alias("heads"), F.sort_array(F.collect_list("row")).alias(name))
            .select(*keys, F.explode("heads").alias("head"), name)
            .select(*keys, "head.*", name)
        )

    def listed(df: DataFrame, name: str) -> DataFrame:
        rows = F.sort_array(F.collect_list(F.struct(*[col for col in df.columns if col != "write_id"])))
        return df.groupBy("write_id").agg(rows.alias(name))

    columns = capture.relation_columns.select("write_id", "leaf_pos", "expr_id", "col_name", "is_partition")
    leaves = capture.projection_leaves.select("write_id", "out_pos", "leaf_ord", "leaf_class", "leaf_expr_id")
    records = capture.writes.repartition(parts, "write_id")
    for lists, name in (
        (with_rows(capture.inputs, columns, "leaf_pos", "columns"), "inputs"),
        (with_rows(capture.projections, leaves, "out_pos", "leaves"), "projections"),
    ):
        records = records.join(unbroadcast(listed(lists, name)), "write_id", "left")
        records = records.withColumn(name, F.coalesce(name, F.array()))
    return records
