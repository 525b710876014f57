"""Publishing from an outbox: written once, sent in order, marked by units."""

import pytest
from captures import AT, entry, records, write
from pyspark.sql import functions as F
from spoor.sinks import outbox
from spoor.sinks.publish import file_sink
from spoor.sources.capture import stream_capture
from spoor.streaming import lineage


@pytest.fixture
def msgs(spark):
    """A key with half of all messages, unkeyed ones, and others."""
    key = "CASE WHEN id % 2 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE concat('k', id % 7) END"
    return spark.range(2000).selectExpr(f"{key} AS msg_key", "concat('v', id) AS value", "-id AS msg_seq", "1 AS split_idx")


def collecting(got, fail=()):
    """A sink that notes each call's rows, in order, and fails at some calls."""

    def send(rows):
        got.append([] if len(got) in fail else [tuple(r) for r in rows.collect()])
        if len(got) - 1 in fail:
            raise RuntimeError("broker away")

    return send


def test_keys_keep_their_order_and_hot_ones_are_many_parts(spark, msgs, tmp_path):
    got = []
    assert outbox.publish_stored(msgs, str(tmp_path), collecting(got), ranges=16)
    sent = [row for call in got for row in call]
    assert sorted(v for _, v, _ in sent) == sorted(f"v{k}" for k in range(2000))
    for key in {k for k, _, _ in sent if k}:
        numbers = [int(v[1:]) for k, v, _ in sent if k == key]
        assert numbers == sorted(numbers, reverse=True)
    assert max(sum(k == "hot" for k, _, _ in call) for call in got) <= 300
    box = outbox.Outbox(spark, str(tmp_path))
    assert box.waves >= 5 and not box.unsent()
    # Sent units are not sent again.
    again = []
    assert outbox.publish_stored(msgs, str(tmp_path), collecting(again), ranges=16) and not again


def test_attempts_send_what_is_left_and_derive_once(spark, msgs, tmp_path):
    derived = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            derived.add(batch.num_rows)
            yield batch

    counted = msgs.mapInArrow(count, msgs.schema)
    got = []
    assert outbox.publish_stored(counted, str(tmp_path), collecting(got, fail={1, 9}), wait_ms=1, ranges=4)
    sent = [v for call in got for _, v, _ in call]
    assert len(sent) == len(set(sent)) == 2000
    # Sampling the ranges reads the input a second time, attempts do not.
    assert derived.value <= 4000


def test_only_unsent_rows_are_buried(spark, msgs, tmp_path):
    dead, got = str(tmp_path / "dead"), []

    def broken(rows):
        found = [r.value for r in rows.collect()]
        if "v1999" in found:
            raise RuntimeError("too large")
        got.extend(found)

    assert not outbox.publish_stored(
        msgs.filter("msg_key <> 'hot' OR msg_key IS NULL"), str(tmp_path / "box"), broken, None,
        file_sink(dead), attempts=2, wait_ms=1, ranges=8,
    )
    buried = {r.value for r in spark.read.parquet(dead).collect()}
    assert "v1999" in buried and not buried & set(got) and len(buried) + len(got) == 1000


def test_empty_messages(spark, msgs, tmp_path):
    got = []
    assert outbox.publish_stored(msgs.filter(F.lit(False)), str(tmp_path), collecting(got), ranges=3)
    assert not any(got)


def test_batches_carry_their_own_times_and_order(spark, tmp_path):
    folder = str(tmp_path)
    send = lineage.lineage_messages(
        file_sink(f"{folder}/topic"), "r", "h", "u", outbox=f"{folder}/outbox", ranges=2, units=2
    )
    for number in (1, 2):
        records(spark, write(number, exec_ts=AT, projections=[entry(0, "Id", 1)])).write.mode("append").parquet(f"{folder}/in")
        lineage.harvest_stream(
            stream_capture(spark, f"{folder}/in"), [send], f"{folder}/staging", f"{folder}/checkpoint"
        ).awaitTermination()
    rows = spark.read.parquet(f"{folder}/topic")
    times = rows.select(F.get_json_object("value", "$.msgCreationTime")).distinct().count()
    assert rows.count() == times == 2


def test_a_batch_opens_only_its_days(spark, tmp_path):
    from datetime import timedelta

    seen = str(tmp_path / "seen")
    for batch_id, days in enumerate(([0, 5, 9], [5], [30, 0])):
        rows = [write(10 * batch_id + d, exec_ts=AT + timedelta(days=d)) for d in days]
        batch = records(spark, *rows)
        fresh = lineage.first_captures(batch, seen, batch_id, "1 hour")
        assert fresh.count() == len(days)
        # A replay sees neither its own ids nor leaves them twice.
        assert lineage.first_captures(batch, seen, batch_id, "1 hour").count() == len(days)
    opened = lineage.seen_on(spark, seen, ["2024-05-06"], "bigint")
    assert opened.count() == 2
    assert all("day=2024-05-06" in f or f"day={lineage.NO_DAY}" in f for f in opened.inputFiles())
    late = records(spark, write(5, exec_ts=AT + timedelta(days=5, minutes=59)), write(5, exec_ts=AT + timedelta(days=6)))
    assert [r.exec_ts for r in lineage.first_captures(late, seen, 3, "1 hour").collect()] == [AT + timedelta(days=6)]
