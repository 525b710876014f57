"""Statement text of a stream of executions."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spoor.operators.statements import HOUR, statement_context
from spoor.streaming.lineage import stored

PARSE_COLUMNS = ("event_id", "thread_id", "ts", "sql_text")
EVENT_SCHEMA = (
    "event_id bigint, thread_id bigint, ts timestamp, is_parse boolean, sql_text string, "
    "status string"
)


def last_texts(parse: DataFrame) -> DataFrame:
    """The last parse of every thread: all a later execution can need."""
    latest = F.max(F.struct("ts", "event_id", "sql_text")).alias("latest")
    return parse.groupBy("thread_id").agg(latest).select("thread_id", "latest.*")


COMPACT = 16
"""Every so many batches the texts left by them are put together."""
PARTS = 64


def _part() -> Column:
    return F.pmod(F.xxhash64("thread_id"), F.lit(PARTS)).cast("int")


def texts_before(spark: SparkSession, state: str, batch_id: int, schema, parts: list[int], compact: int = COMPACT) -> DataFrame:
    """The texts left for a batch: the last compaction's, and each later batch's own.

    Of the compaction only the folders ``parts`` are opened.
    """
    base = batch_id // compact * compact - 1
    own = [f"{state}/batch={k}" for k in range(base + 1, batch_id)]
    found = spark.read.schema(schema).parquet(*own) if own else spark.createDataFrame([], schema)
    if base < 0:
        return found
    whole = spark.read.schema(f"{_ddl(schema)}, part int").parquet(f"{state}/base={base}")
    return found.unionByName(whole.filter(F.col("part").isin(parts)).drop("part"))


def _ddl(schema) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def keep_texts(
    parse: DataFrame, state: str, batch_id: int, compact: int = COMPACT, forget: str | None = None
) -> None:
    """Leave a batch's last texts for later ones: the threads that parsed in it, no others.

    Every ``compact`` batches all are put together, one row a thread; ``forget`` is an
    interval after which a thread that parses nothing more is dropped then.
    """
    spark = parse.sparkSession
    last_texts(parse).write.mode("overwrite").parquet(f"{state}/batch={batch_id}")
    if (batch_id + 1) % compact == 0:
        own = spark.read.schema(parse.schema).parquet(f"{state}/batch={batch_id}")
        whole = last_texts(
            own.unionByName(texts_before(spark, state, batch_id, parse.schema, list(range(PARTS)), compact))
        )
        if forget is not None:
            newest = own.agg(F.max("ts")).first()[0]
            if newest is not None:
                whole = whole.filter(F.col("ts") >= F.lit(newest) - F.expr(f"INTERVAL {forget}"))
        (
            whole.withColumn("part", _part())
            .repartition("part")
            .write.partitionBy("part")
            .mode("overwrite")
            .parquet(f"{state}/base={batch_id}")
        )


def statement_stream(
    events: DataFrame,
    out: str,
    state: str,
    staging: str,
    checkpoint: str,
    trigger: dict | None = None,
    slice_seconds: int = HOUR,
    compact: int = COMPACT,
    forget: str | None = None,
) -> StreamingQuery:
    """Executions with their text, for a stream of parses and executions.

    What the threads of a batch parsed last is kept as a small table below ``state``, and
    put together every ``compact`` batches, so a batch rewrites nothing of threads it does
    not touch. The batch job does the rest, and a busy thread is still many tasks. A
    replayed batch starts from the tables before it.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        rows = stored(batch, staging, batch_id)
        spark = rows.sparkSession
        parse = rows.filter("is_parse").select(*PARSE_COLUMNS)
        execs = rows.filter("NOT is_parse").drop("is_parse", "sql_text")
        threads = execs.select(F.col("thread_id").alias("mine")).distinct()
        parts = [r.part for r in rows.select(_part().alias("part")).distinct().collect()]  # PARTS at most
        before = texts_before(spark, state, batch_id, parse.schema, parts, compact)
        carried = last_texts(before.join(threads, F.col("thread_id").eqNullSafe(F.col("mine")), "left_semi"))
        found = statement_context(parse.unionByName(carried), execs, slice_seconds)
        found.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        keep_texts(parse, state, batch_id, compact, forget)

    return (
        events.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
