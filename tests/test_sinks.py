"""Publishing: options, outbox, retry, dead letters."""

from functools import partial

import pytest
from spoor import constants as c
from spoor.sinks import publish as sinks
from workload import message_queries

PREFIX = c.KAFKA_OPTION_PREFIX


@pytest.fixture(scope="module")
def msgs(spark):
    return spark.createDataFrame([("k", "v"), (None, "w")], "msg_key string, value string")


def test_kafka_options():
    given = {
        c.NAMESPACE_OPTION: "prod",
        PREFIX + "bootstrap.servers": "h:9092",
        PREFIX + "key.serializer": "x",
        PREFIX + "sasl.jaas.config": "j",
        "other": "y",
    }
    options = sinks.kafka_options(given)
    assert options == {
        "kafka.bootstrap.servers": "h:9092",
        "kafka.sasl.jaas.config": "j",
        "kafka.session.timeout.ms": "30000",
        "kafka.retries": "3",
        "kafka.retry.backoff.ms": "3000",
    }
    assert sinks.kafka_options({PREFIX + "session.timeout.ms": "5"})[
        "kafka.session.timeout.ms"
    ] == "5"
    assert sinks.namespace(given) == "prod" and sinks.namespace({}) == "5k"
    assert sinks.topic({}) == c.DEFAULT_TOPIC
    assert sinks.topic({c.TOPIC_OPTION: "T2"}) == "T2"


def test_outbox(msgs):
    rows = sinks.outbox(msgs, {c.TOPIC_OPTION: "T"}).collect()
    assert {tuple(r) for r in rows} == {("k", "v", "T"), (None, "w", "T")}


@pytest.mark.parametrize("fmt", ["parquet", "json"])
def test_file_sink(spark, msgs, tmp_path, fmt):
    path = str(tmp_path / "outbox")
    assert sinks.publish(msgs, sinks.file_sink(path, fmt))
    assert spark.read.format(fmt).load(path).count() == 2


def test_second_attempt_succeeds(msgs):
    calls = []

    def flaky(records):
        calls.append(records.count())
        if len(calls) < 3:
            raise RuntimeError("broker away")

    assert sinks.publish(msgs, flaky, wait_ms=1)
    assert calls == [2, 2, 2]


def test_giving_up_keeps_the_rows_and_does_not_raise(spark, msgs, tmp_path):
    path = str(tmp_path / "dead")

    def broken(records):
        raise RuntimeError("broker away")

    assert not sinks.publish(
        msgs, broken, dead_letters=sinks.file_sink(path), attempts=2, wait_ms=1
    )
    rows = spark.read.parquet(path).collect()
    assert {r.value for r in rows} == {"v", "w"} and {r.error for r in rows} == {"broker away"}


def test_kafka_sink_without_connector_is_a_dead_letter(spark, msgs, tmp_path):
    path = str(tmp_path / "dead")
    sink = sinks.kafka_sink({PREFIX + "bootstrap.servers": "localhost:1"})
    if sinks.publish(msgs, sink, dead_letters=sinks.file_sink(path), attempts=1):
        pytest.skip("a Kafka connector and a broker are here")
    assert spark.read.parquet(path).count() == 2


def test_in_key_order(spark):
    rows = spark.range(300).selectExpr("concat('k', id % 3) AS msg_key", "-id AS at", "'v' AS value")
    ordered = sinks.in_key_order(rows, ["at"])
    for part in ordered.rdd.glom().collect():
        assert part == sorted(part, key=lambda r: (r.msg_key, r.at))
    assert ordered.count() == 300


def test_what_was_not_sent_is_not_read_as_an_outbox(spark, msgs, monkeypatch):
    def broken(records):
        raise RuntimeError("broker away")

    monkeypatch.setattr(message_queries, "publish", partial(sinks.publish, attempts=1))
    monkeypatch.setattr(message_queries, "file_sink", lambda folder: broken)
    with pytest.raises(RuntimeError, match="not sent"):
        message_queries.received(spark, msgs)


def test_published_files_are_entropy_coded(spark, msgs, tmp_path):
    path = tmp_path / "outbox"
    assert sinks.publish(msgs, sinks.file_sink(str(path)))
    assert [f.name for f in path.glob("part-*") if not f.name.endswith(".zstd.parquet")] == []
