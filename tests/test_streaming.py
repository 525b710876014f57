"""Streams: replay, state across batches, dedupe, and the batch result."""

import threading
from datetime import timedelta

import pytest
from captures import AT, entry, records, write
from pyspark.sql import functions as F
from spoor.sinks.publish import file_sink
from spoor.sources.capture import stream_capture
from spoor.streaming import lineage, statements
from workload import fixtures as fx
from workload import stream_queries


def columns_in(spark, path):
    rows = spark.read.parquet(path).collect()
    return sorted((r.write_id, r.output_column, r["batch"]) for r in rows)


def test_two_batches_and_a_replay(spark, tmp_path):
    folder = str(tmp_path)
    source, out = f"{folder}/in", f"{folder}/out"

    def run(checkpoint):
        lineage.harvest_stream(
            stream_capture(spark, source),
            [lineage.lineage_tables(out)],
            f"{folder}/staging",
            f"{folder}/{checkpoint}",
        ).awaitTermination()

    records(spark, write(1, projections=[entry(0, "Id", 1)])).write.parquet(source)
    run("first")
    more = records(spark, write(2, projections=[entry(0, "Id", 1)]), write(3, inputs=[]))
    more.write.mode("append").parquet(source)
    run("first")
    found = columns_in(spark, f"{out}/column_lineage")
    assert found == [(1, "mart.Out.id@5k", 0), (2, "mart.Out.id@5k", 1)]
    assert spark.read.parquet(f"{out}/rejected").count() == 1
    assert spark.read.parquet(f"{out}/column_edges").count() == 2


def test_a_replayed_batch_overwrites_itself(spark, tmp_path):
    from spoor.plans.harvest import harvest
    from spoor.sources.capture import unnest

    out = str(tmp_path / "out")
    result = harvest(unnest(records(spark, write(1, projections=[entry(0, "Id", 1)]))))
    keep = lineage.lineage_tables(out)
    keep(result, 0)
    keep(result, 0)
    assert spark.read.parquet(f"{out}/column_lineage").count() == 1


def test_stream_dedupe_across_batches(spark, tmp_path):
    folder = str(tmp_path)
    for at in (AT, AT + timedelta(minutes=1)):
        records(spark, write(1, exec_ts=at)).write.mode("append").parquet(f"{folder}/in")
        stream = stream_capture(spark, f"{folder}/in")
        lineage.harvest_stream(
            stream,
            [lineage.lineage_tables(f"{folder}/out")],
            f"{folder}/staging",
            f"{folder}/checkpoint",
            dedupe_delay="1 hour",
        ).awaitTermination()
    assert spark.read.parquet(f"{folder}/out/table_lineage").count() == 1


def test_a_late_first_capture_stays(spark, tmp_path):
    folder = str(tmp_path)
    days = {1: timedelta(0), 2: timedelta(days=2), 3: timedelta(days=-1)}
    for write_id, later in days.items():
        records(spark, write(write_id, exec_ts=AT + later)).write.mode("append").parquet(f"{folder}/in")
        lineage.harvest_stream(
            stream_capture(spark, f"{folder}/in"),
            [lineage.lineage_tables(f"{folder}/out")],
            f"{folder}/staging",
            f"{folder}/checkpoint",
            dedupe_delay="1 hour",
        ).awaitTermination()
    found = spark.read.parquet(f"{folder}/out/table_lineage").collect()
    assert sorted(r.write_id for r in found) == [1, 2, 3]


def test_stream_publishes_and_buries(spark, tmp_path):
    folder = str(tmp_path)
    records(spark, write(1)).write.parquet(f"{folder}/in")

    def broken(rows):
        raise RuntimeError("broker away")

    lineage.harvest_stream(
        stream_capture(spark, f"{folder}/in"),
        [
            lineage.lineage_messages(file_sink(f"{folder}/outbox"), "r", "h", "u", 1),
            lineage.lineage_messages(
                lambda rows: (_ for _ in ()).throw(RuntimeError("away")),
                "r",
                "h",
                "u",
                1,
                dead_letters=file_sink(f"{folder}/dead"),
                wait_ms=1,
            ),
        ],
        f"{folder}/staging",
        f"{folder}/checkpoint",
    ).awaitTermination()
    assert spark.read.parquet(f"{folder}/outbox").first().key == "mart.Out@5k"
    assert spark.read.parquet(f"{folder}/dead").first().error == "away"


@pytest.mark.parametrize("replay", [False, True])
def test_last_text_is_kept_between_batches(spark, tmp_path, replay):
    folder = str(tmp_path)

    def event(event_id, minute, text=None, thread=1):
        at = AT + timedelta(minutes=minute)
        return (event_id, thread, at, text is not None, text, None if text else "success")

    batches = [
        [event(1, 0, "a"), event(2, 1), event(3, 0, thread=2)],
        [event(4, 200), event(5, 201, "b"), event(6, 202), event(7, 203, thread=2)],
        [event(8, 500, thread=1)],
    ]
    for rows in batches:
        frame = spark.createDataFrame(rows, statements.EVENT_SCHEMA)
        frame.write.mode("append").parquet(f"{folder}/in")
        statements.statement_stream(
            stream_capture(spark, f"{folder}/in", statements.EVENT_SCHEMA),
            f"{folder}/out",
            f"{folder}/state",
            f"{folder}/staging",
            f"{folder}/checkpoint",
        ).awaitTermination()
    if replay:
        # All from the start again, over what is already there.
        statements.statement_stream(
            stream_capture(spark, f"{folder}/in", statements.EVENT_SCHEMA, maxFilesPerTrigger=1),
            f"{folder}/out2",
            f"{folder}/state2",
            f"{folder}/staging2",
            f"{folder}/checkpoint2",
        ).awaitTermination()
    out = spark.read.parquet(f"{folder}/out")
    found = {r.event_id: r.sql_text for r in out.collect()}
    assert found == {2: "a", 3: None, 4: "a", 6: "b", 7: None, 8: "b"}
    assert set(out.columns) >= {"event_id", "thread_id", "ts", "status", "sql_text"}


@pytest.mark.parametrize("repeats", [False, True])
def test_only_a_batch_with_repeats_is_shuffled(spark, tmp_path, repeats):
    folder, plans = str(tmp_path), []
    given = [write(k, projections=[entry(0, "Id", 1)]) for k in range(3)]
    if repeats:
        given.append(write(1, exec_ts=AT + timedelta(minutes=1), out_table="Later"))
    records(spark, *given).write.parquet(f"{folder}/in")

    def look(result, batch_id):
        plans.append(result.column_lineage._jdf.queryExecution().executedPlan().toString())

    lineage.harvest_stream(
        stream_capture(spark, f"{folder}/in"),
        [look, lineage.lineage_tables(f"{folder}/out")],
        f"{folder}/staging",
        f"{folder}/checkpoint",
    ).awaitTermination()
    assert ["Exchange" in text for text in plans] == [repeats]
    found = columns_in(spark, f"{folder}/out/column_lineage")
    assert found == [(k, "mart.Out.id@5k", 0) for k in range(3)]


def test_jobs_of_a_batch_run_side_by_side(spark):
    # Each waits for the other; one after the other they would not get past this.
    meet, done = threading.Barrier(2, timeout=30), []

    def fails():
        meet.wait()
        raise ValueError("broken")

    def works():
        meet.wait()
        done.append(spark.sparkContext.getLocalProperty("spoor.test"))

    spark.sparkContext.setLocalProperty("spoor.test", "batch")
    try:
        with pytest.raises(ValueError, match="broken"):
            lineage.at_once(spark, fails, works)
    finally:
        spark.sparkContext.setLocalProperty("spoor.test", None)
    assert done == ["batch"]


def test_records_of_a_stream_are_in_few_files(spark, small_dir, tmp_path, monkeypatch):
    read = []
    monkeypatch.setattr(stream_queries, "stream_capture", lambda _, path, **options: read.append((path, options)))
    cores, parts = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(20 * cores))
    try:
        stream_queries._records(spark, small_dir, str(tmp_path))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    ((path, options),) = read
    stored = spark.read.parquet(path)
    assert options == {"maxFilesPerTrigger": 4} and len(stored.inputFiles()) <= 2 * cores
    assert sorted(r.write_id for r in stored.select("write_id").collect()) == sorted(
        r.write_id for r in fx.writes(spark, small_dir).select("write_id").collect()
    )
    entries = stored.select(F.sum(F.size("projections")).alias("n")).first().n
    assert entries == fx.projections(spark, small_dir).count() > 0
