"""Keyed publishing to Kafka, to an outbox of files, or to a sink of one's own."""

import logging
import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor import constants as c

log = logging.getLogger(__name__)

Sink = Callable[[DataFrame], None]


def namespace(properties: dict) -> str:
    return properties.get(c.NAMESPACE_OPTION, c.DEFAULT_NAMESPACE)


def topic(properties: dict) -> str:
    return properties.get(c.TOPIC_OPTION, c.DEFAULT_TOPIC)


def kafka_options(properties: dict) -> dict:
    """Options of Spark's Kafka sink from prefixed properties.

    The serializers are fixed by the sink and may not be given.
    """
    given = {
        key.removeprefix(c.KAFKA_OPTION_PREFIX): value
        for key, value in properties.items()
        if key.startswith(c.KAFKA_OPTION_PREFIX)
    }
    given.setdefault("session.timeout.ms", c.SESSION_TIMEOUT_MS)
    given.setdefault("retries", str(c.PUBLISH_ATTEMPTS))
    given.setdefault("retry.backoff.ms", str(c.RETRY_WAIT_MS))
    fixed = ("key.serializer", "value.serializer")
    return {"kafka." + key: value for key, value in given.items() if key not in fixed}


def outbox(msgs: DataFrame, properties: dict | None = None) -> DataFrame:
    """``key, value, topic`` as the Kafka sink takes them; no key leaves a row unkeyed."""
    return msgs.select(
        F.col("msg_key").alias("key"), "value", F.lit(topic(properties or {})).alias("topic")
    )


def kafka_sink(properties: dict) -> Sink:
    def write(records: DataFrame) -> None:
        records.write.format("kafka").options(**kafka_options(properties)).save()

    return write


# Large messages are base64 of compressed bytes, which a codec without entropy coding leaves as long.
FILE_OPTIONS = {"parquet": {"compression": "zstd"}}


def file_sink(path: str, fmt: str = "parquet", mode: str = "append") -> Sink:
    def write(records: DataFrame) -> None:
        records.write.format(fmt).options(**FILE_OPTIONS.get(fmt, {})).mode(mode).save(path)

    return write


def in_key_order(msgs: DataFrame, order: list[str]) -> DataFrame:
    """Messages of one key together and in order, for topics whose readers rely on it.

    One key is then one task, as it is one partition of the topic. ``publish`` without
    this needs no shuffle.
    """
    return msgs.repartition("msg_key").sortWithinPartitions("msg_key", *order)


def dead_letter(records: DataFrame, error: str) -> DataFrame:
    """Rows that could not be published, with the reason."""
    return records.withColumn("error", F.lit(error))


def publish(
    msgs: DataFrame,
    sink: Sink,
    properties: dict | None = None,
    dead_letters: Sink | None = None,
    attempts: int = c.PUBLISH_ATTEMPTS,
    wait_ms: int = c.RETRY_WAIT_MS,
) -> bool:
    """Send ``msg_key, value`` rows, trying again a few times.

    After the last failure the rows go to ``dead_letters`` and the caller goes on;
    the result says whether the rows were sent. Delivery is at least once.
    """
    records = outbox(msgs, properties)
    failure = None
    for attempt in range(1, max(attempts, 1) + 1):
        if attempt > 1:
            time.sleep(wait_ms / 1000)
        try:
            sink(records)
            return True
        except Exception as error:
            failure = error
            log.error("publish attempt %d failed: %s", attempt, error)
    log.error("giving up after %d attempts", max(attempts, 1))
    if dead_letters is not None:
        dead_letters(dead_letter(records, str(failure)))
    return False
