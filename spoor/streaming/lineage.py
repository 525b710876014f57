"""Lineage of a stream of nested write records, one micro-batch at a time.

Every batch is written down first and then harvested like stored records.
Results go to a folder per batch that a replay overwrites, so each batch counts once.
"""

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from spoor import constants as c
from spoor.operators.column_lineage import column_edges
from spoor.operators.entities import hook_notifications
from spoor.operators.writes import most_captures
from spoor.plans.harvest import RecordHarvest, harvest_records, messages_of
from spoor.sinks.outbox import publish_stored
from spoor.sinks.publish import Sink, publish

RESULTS = ("table_edges", "table_lineage", "column_lineage", "rejected")

BatchSink = Callable[[RecordHarvest, int], None]

# Nested records are small when stored and dear to resolve: small row groups let a batch of a
# few files be read by many tasks.
STAGED = {"parquet.block.size": str(4 << 20)}

NO_DAY = "none"


def _day(pattern: str) -> Column:
    return F.coalesce(F.date_format(F.to_date(F.col("exec_ts").cast("timestamp")), pattern), F.lit(NO_DAY))


def seen_on(spark: SparkSession, seen: str, days: list[str], id_type: str) -> DataFrame:
    """``write_id, at, batch`` of the captures that earlier batches had on these days.

    Only the folders of these days are listed and opened.
    """
    schema = f"write_id {id_type}, at timestamp, day string, batch long"
    # An empty table gives ``seen`` a folder that always matches.
    empty = spark.createDataFrame([], schema).withColumns({"day": F.lit(NO_DAY), "batch": F.lit(-1)})
    empty.write.mode("overwrite").parquet(f"{seen}/day={NO_DAY}/batch=-1")
    wanted = ",".join(sorted({*days, NO_DAY}))
    return (
        spark.read.schema(schema).option("basePath", seen).parquet(f"{seen}/day={{{wanted}}}").filter("batch >= 0")
    )


def first_captures(
    batch: DataFrame, seen: str, batch_id: int, delay: str, pattern: str = "yyyy-MM-dd"
) -> DataFrame:
    """The rows of a batch whose command no earlier batch had within ``delay``.

    Each batch leaves its ids in ``seen``, in a folder for each day of execution, and reads
    those of the days that its own captures and the delay reach; a late capture adds its
    own day, not those between. Late captures stay if they are the first; a replayed batch
    overwrites its ids and does not see them. Repeats within the batch stay, as harvesting
    drops them. pattern: of the folders' dates; ``yyyy-MM`` makes fewer of them, for
    batches that reach over years.
    """
    spark = batch.sparkSession
    at, reach = F.col("exec_ts").cast("timestamp"), F.expr(f"INTERVAL {delay}")
    around = F.sequence(F.to_date(at - reach), F.to_date(at + reach), F.expr("INTERVAL 1 DAY"))
    # One row for each day of the batch.
    days = [
        r.day
        for r in batch.select(F.to_date(at).alias("exec_ts")).distinct()
        .select(F.explode(around).alias("exec_ts")).select(_day(pattern).alias("day")).distinct().collect()
    ]
    id_type = batch.schema["write_id"].dataType.simpleString()
    earlier = (
        seen_on(spark, seen, days, id_type)
        .filter(F.col("batch") < batch_id)
        .select(F.col("write_id").alias("e_id"), F.col("at").alias("e_at"))
    )
    near = F.col("e_at").isNull() | F.col("exec_ts").isNull() | at.between(F.col("e_at") - reach, F.col("e_at") + reach)
    fresh = batch.join(earlier, (F.col("write_id") == F.col("e_id")) & near, "left_anti")
    own = batch.select("write_id", at.alias("at"), _day(pattern).alias("day"), F.lit(batch_id).cast("long").alias("batch"))
    # The files of a day are as few as its rows need, and a hot day is split.
    (
        own.hint("rebalance", "day")
        .write.partitionBy("day", "batch")
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(seen)
    )
    return fresh


def stored(batch: DataFrame, path: str, batch_id: int, **options) -> DataFrame:
    """The batch as written to its folder, so it is computed once and survives lost tasks."""
    folder = f"{path}/batch={batch_id}"
    batch.write.options(**options).mode("overwrite").parquet(folder)
    return batch.sparkSession.read.schema(batch.schema).parquet(folder)


def at_once(spark: SparkSession, *jobs: Callable[[], object]) -> None:
    """Run jobs of one batch side by side: each has as few tasks as the batch has files. All
    have ended when this returns; the first error is raised."""
    # The threads' jobs are of the query's group, so that stopping it stops them.
    inherit = inheritable_thread_target(spark)
    with ThreadPoolExecutor(len(jobs)) as pool:
        running = [pool.submit(inherit(job)) for job in jobs]
    for job in running:
        job.result()


def lineage_tables(path: str) -> BatchSink:
    """A sink that keeps all lineage tables below ``path``."""

    def write(result: RecordHarvest, batch_id: int) -> None:
        def keep(name: str) -> DataFrame:
            return stored(getattr(result, name), f"{path}/{name}", batch_id)

        def keep_columns() -> None:
            # Edges come from the columns just written, not from deriving them again.
            stored(column_edges(keep("column_lineage")), f"{path}/column_edges", batch_id)

        others = [partial(keep, name) for name in RESULTS if name != "column_lineage"]
        at_once(result.writes.sparkSession, keep_columns, *others)

    return write


def lineage_messages(
    sink: Sink,
    run_id: str,
    source_ip: str,
    user: str,
    created_ms: int | None = None,
    properties: dict | None = None,
    dead_letters: Sink | None = None,
    max_bytes: int = c.MAX_MESSAGE_BYTES,
    outbox: str | None = None,
    **retry,
) -> BatchSink:
    """A sink that publishes every write's bundle, keyed by its output table.

    Message ids are those of the writes, so readers can drop what a replay sends again.
    Without ``created_ms`` messages carry the time their batch is sent. With ``outbox`` each
    batch's messages are written there once, and go out from it in the order of their
    writes; a replayed batch goes on where it stopped. ``retry`` is passed on to ``publish``
    or ``publish_stored``.
    """

    def send(result: RecordHarvest, batch_id: int) -> None:
        asked = hook_notifications(result.bundles, user)
        created = time.time_ns() // 1_000_000 if created_ms is None else created_ms
        sent = messages_of(asked, run_id, source_ip, user, created, max_bytes)
        if outbox is None:
            publish(sent, sink, properties, dead_letters, **retry)
        else:
            publish_stored(sent, f"{outbox}/batch={batch_id}", sink, properties, dead_letters, **retry)

    return send


def harvest_stream(
    records: DataFrame,
    sinks: list[BatchSink],
    staging: str,
    checkpoint: str,
    dedupe_delay: str | None = None,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Harvest each micro-batch and hand the result to every sink.

    ``options`` go to ``harvest_records``; ``staging`` keeps the raw records of each batch. With
    ``dedupe_delay`` a command counts once as far as its captures are that close. Repeats
    within a batch are dropped only where its ids show that there are some: a batch without
    any is harvested in the rows it has, with nothing shuffled.
    """

    def process(batch: DataFrame, batch_id: int) -> None:
        kept = stored(batch, staging, batch_id, **STAGED)
        given = {"dedupe": most_captures(kept) > 1} | options
        if dedupe_delay is not None:
            kept = first_captures(kept, f"{staging}-seen", batch_id, dedupe_delay)
        result = harvest_records(kept, **given)
        for sink in sinks:
            sink(result, batch_id)

    return (
        records.writeStream.foreachBatch(process)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
