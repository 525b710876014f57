"""Publishing from an outbox: rows written once, sent in units that are marked when sent.

The rows lie in ranges of their key and order, one file each, so that a key of any size
is many files and none is a task's whole work. Rows of one key go out range after range:
the first ranges of all keys at once, in a few units, then the ranges that continue a
key, one wave after another. A unit is marked when its sink call has returned; attempts
and replays send the units without a mark, and only those end as dead letters.
"""

import logging
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor import constants as c
from spoor.sinks.publish import Sink, dead_letter, topic

log = logging.getLogger(__name__)

ORDER = ("exec_ts", "msg_seq", "split_idx")
UNITS = 8
"""Sink calls that the first ranges of all keys are dealt to."""
# One row group a file: a file is read by one task, whatever its size.
FILE_OPTIONS = {"parquet.block.size": str(1 << 30)}
ROW = ("key", "value", "topic")


def write_outbox(
    msgs: DataFrame, path: str, properties: dict | None = None, order: tuple = ORDER, ranges: int | None = None
) -> None:
    """Write ``msg_key, value`` rows below ``path``, once: what is complete there stays.

    order: columns that order the messages of a key; those that msgs lacks are left out.
    """
    spark = msgs.sparkSession
    if _marks(spark, path).filter("unit = -1").count():
        return
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = [F.col(name) for name in order if name in msgs.columns]
    rows = msgs.select(F.col("msg_key").alias("key"), "value", F.lit(topic(properties or {})).alias("topic"), *by)
    # The row's hash ends a range between rows that tie.
    place = [F.col("key"), *[F.col(name) for name in order if name in msgs.columns], F.xxhash64("value")]
    (
        rows.repartitionByRange(ranges, *place)
        .withColumn("part", F.spark_partition_id())
        .sortWithinPartitions("part", *place)
        .write.partitionBy("part")
        .options(**FILE_OPTIONS)
        .mode("overwrite")
        .parquet(f"{path}/rows")
    )
    _mark(spark, path, -1)


def _marks(spark: SparkSession, path: str) -> DataFrame:
    """The units sent; -1 stands for the rows being complete."""
    spark.range(0).withColumn("unit", F.lit(-2)).write.mode("overwrite").parquet(f"{path}/sent/unit=-2")
    return spark.read.schema("id long, unit int").parquet(f"{path}/sent")


def _mark(spark: SparkSession, path: str, unit: int) -> None:
    spark.range(1).write.mode("overwrite").parquet(f"{path}/sent/unit={unit}")


class Outbox:
    """The rows of ``write_outbox`` and their units, in the order they may be sent."""

    def __init__(self, spark: SparkSession, path: str, units: int = UNITS):
        self.spark, self.path, self.units = spark, path, units
        self.rows = spark.read.schema("key string, value string, topic string, part int").parquet(f"{path}/rows")
        # Ranges continue at most one key each, so this is a row for each range at most.
        spans = (
            self.rows.filter("key IS NOT NULL")
            .groupBy("key")
            .agg(F.min("part").alias("first"), F.max("part").alias("last"))
            .filter("first < last")
            .collect()
        )
        self.continued = {
            part: (span.key, part - span.first) for span in spans for part in range(span.first + 1, span.last + 1)
        }
        self.waves = max((wave for _, wave in self.continued.values()), default=0)

    def unit(self, number: int) -> DataFrame:
        """The rows of a unit: below ``units`` first ranges, beyond the continuing waves."""
        if number < self.units:
            mine = self.rows.filter(F.col("part") % self.units == number)
            ends = {part: key for part, (key, _) in self.continued.items() if part % self.units == number}
            return mine.filter(~self._continues(ends)) if ends else mine
        wave = number - self.units + 1
        ends = {part: key for part, (key, w) in self.continued.items() if w == wave}
        return self.rows.filter(F.col("part").isin(*ends) & self._continues(ends))

    @staticmethod
    def _continues(ends: dict) -> Column:
        """Whether a row is of the key that its range continues."""
        pairs = F.create_map(*[F.lit(x) for pair in ends.items() for x in pair])
        return F.coalesce(F.try_element_at(pairs, F.col("part")) == F.col("key"), F.lit(False))

    def waves_of_units(self) -> list[list[int]]:
        """The units by wave; those of one wave hold different keys."""
        return [list(range(self.units)), *[[self.units + k] for k in range(self.waves)]]

    def unsent(self) -> set[int]:
        sent = {r.unit for r in _marks(self.spark, self.path).select("unit").collect()}
        return {unit for wave in self.waves_of_units() for unit in wave} - sent

    def mark(self, unit: int) -> None:
        _mark(self.spark, self.path, unit)


def publish_stored(
    msgs: DataFrame,
    path: str,
    sink: Sink,
    properties: dict | None = None,
    dead_letters: Sink | None = None,
    attempts: int = c.PUBLISH_ATTEMPTS,
    wait_ms: int = c.RETRY_WAIT_MS,
    order: tuple = ORDER,
    ranges: int | None = None,
    units: int = UNITS,
) -> bool:
    """Send ``msg_key, value`` rows through the outbox at ``path``, trying again a few times.

    ``msgs`` is derived once, whatever the attempts. A wave that failed in part keeps the
    waves behind it back, so that no message overtakes an earlier one of its key. After the
    last failure the rows not sent go to ``dead_letters`` and the caller goes on; the result
    says whether all were sent. Delivery is at least once.
    """
    write_outbox(msgs, path, properties, order, ranges)
    box = Outbox(msgs.sparkSession, path, units)
    unsent, failure = box.unsent(), None
    for attempt in range(1, max(attempts, 1) + 1):
        if attempt > 1:
            time.sleep(wait_ms / 1000)
        for wave in box.waves_of_units():
            for unit in wave:
                if unit in unsent:
                    try:
                        sink(box.unit(unit).select(*ROW))
                        box.mark(unit)
                        unsent.discard(unit)
                    except Exception as error:
                        failure = error
                        log.error("publish attempt %d, unit %d failed: %s", attempt, unit, error)
            if unsent & set(wave):
                break
        if not unsent:
            return True
    log.error("giving up after %d attempts", max(attempts, 1))
    if dead_letters is not None:
        for unit in sorted(unsent):
            dead_letters(dead_letter(box.unit(unit).select(*ROW), str(failure)))
    return False
