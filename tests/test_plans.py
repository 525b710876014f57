"""What the plans look like, and that hot keys are spread and change nothing."""

import re
import time
from dataclasses import replace

import pytest
from captures import column, entry, leaf, records, write
from pyspark.sql import functions as F
from spoor.operators import table_lineage, writes
from spoor.operators.spread import BLOCK, position_block, spread_join
from spoor.plans import harvest as harvest_plans
from spoor.plans.harvest import harvest
from spoor.session import CLEANUP, written
from spoor.sources.capture import nest, read_capture, unnest, write_capture
from workload import fixtures as fx
from workload import message_queries, registry, stream_queries


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", sorted(n for n in registry.QUERIES if "stream" not in n))
def test_no_cross_joins(spark, small_dir, name, no_broadcast):
    text = plan(registry.QUERIES[name](spark, small_dir))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


GROWING = [
    *("column_edges", "column_entities", "column_lineage", "column_process_refs", "computed_columns"),
    *("dependency_types", "entity_bundles", "normalized_lineage", "raw_capture_lineage", "hook_notifications"),
    *("harvest_datasource_ctas", "harvest_hive_ctas", "harvest_hive_insert", "bundled_entities"),
    *("direct_columns", "copied_columns", "unowned_entries", "direct_matches", "leaf_matches", "table_edges"),
]


@pytest.mark.parametrize("name", GROWING)
def test_what_grows_is_not_broadcast(spark, small_dir, name):
    # The test tables are far below Spark's own limit, so it would broadcast them all.
    assert "Broadcast" not in plan(registry.QUERIES[name](spark, small_dir))


def test_what_is_published_is_not_broadcast(spark, small_dir, monkeypatch):
    # The query's own plan begins at the outbox.
    sent = []
    monkeypatch.setattr(message_queries, "received", lambda _, msgs: sent.append(msgs) or _whole(msgs))
    registry.QUERIES["published_lineage"](spark, small_dir)
    assert [df for df in sent if "Broadcast" in plan(df)] == [] != sent


def test_publishing_has_no_shuffle_of_the_harvest_behind_it(spark, small_dir, monkeypatch):
    sent, stored = [], []
    monkeypatch.setattr(message_queries, "received", lambda _, msgs: sent.append(msgs) or _whole(msgs))
    monkeypatch.setattr(harvest_plans, "written", lambda df, folder: stored.append(df) or written(df, folder))
    registry.QUERIES["published_lineage"](spark, small_dir)
    assert "Exchange" not in plan(sent[0])
    assert "Exchange" in plan(stored[0]) and "Broadcast" not in plan(stored[0])


def _shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f.getName() for f in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(manager.getAllFiles())}


def test_what_is_written_leaves_no_shuffle_files(spark, tmp_path):
    before = _shuffle_files(spark)
    dealt = spark.range(1000).repartition(4, "id")
    again = written(dealt, str(tmp_path / "out"))
    for _ in range(50):
        left = {name for name in _shuffle_files(spark) - before if name.startswith("shuffle_")}
        if not left:
            break
        time.sleep(0.2)
    assert left == set() and again.count() == 1000
    assert spark.conf.get(CLEANUP) == "false"


def test_both_branches_share_the_shuffle_of_the_columns(spark, small_dir, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(registry.QUERIES["entity_bundles"](spark, small_dir))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # One for the relations, one for their columns.
    assert len(re.findall(r"- Exchange hashpartitioning\(l_orderkey#\d+L, l_linenumber#\d+, ", text)) == 2


def _whole(msgs):
    return msgs.selectExpr("msg_key AS key", "'t' AS topic", "value AS msg_json")


def test_what_is_stored_is_not_broadcast(spark, small_dir, monkeypatch):
    # The query's own plan begins at the stored tables.
    stored, write = [], stream_queries.write_capture

    def checked(capture, path):
        stored.extend([capture.writes, capture.inputs, capture.relation_columns])
        stored.extend([capture.projections, capture.projection_leaves])
        write(capture, path)

    monkeypatch.setattr(stream_queries, "write_capture", checked)
    found = registry.QUERIES["stored_capture_lineage"](spark, small_dir)
    assert [df for df in [*stored, found] if "Broadcast" in plan(df)] == [] and len(stored) == 5


@pytest.mark.parametrize("made", [fx.inputs, fx.relation_columns])
def test_what_is_made_of_lines_keeps_its_partitions(spark, small_dir, made):
    # Put together by compressed size, their sorted rows would take a task's memory.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df = made(spark, small_dir)
    # The one exchange is of the lines, not of groups that a file's split would hold.
    text = plan(df)
    assert text.count("Exchange") == 1 and "REPARTITION_BY_NUM" in text
    assert df.rdd.getNumPartitions() == parts > 1


def test_entries_are_grouped_in_the_partitions_given(spark, small_dir):
    text = plan(registry.QUERIES["direct_columns"](spark, small_dir))
    assert re.search(r"hashpartitioning\(write_id#\d+L, _block#\d+L, \d+\), REPARTITION_BY_NUM", text)


def test_nesting_shuffles_what_is_stored_once(spark, tmp_path):
    given = records(
        spark,
        write(1, inputs=[leaf(0, "S", [column(2, "b"), column(1, "a")])], projections=[entry(0, "a", 1, "f(a)", [2, 1])]),
        write(2, inputs=[], projections=[]),
    )
    write_capture(unnest(given), str(tmp_path))
    capture = read_capture(spark, str(tmp_path))
    orphan = capture.relation_columns.withColumn("leaf_pos", F.lit(9))
    again = nest(replace(capture, relation_columns=capture.relation_columns.unionByName(orphan)))
    # By number: adaptive execution does not put them together.
    text = plan(again)
    assert text.count("REPARTITION_BY_NUM") == 3 and text.count("Exchange") == 3
    found = {r.write_id: r for r in again.collect()}
    assert [x.col_name for x in found[1].inputs[0].columns] == ["a", "b"] and len(found[1].inputs) == 1
    assert [x.leaf_expr_id for x in found[1].projections[0].leaves] == [2, 1]
    assert found[2].inputs == [] and found[2].projections == []


def test_scans_read_only_what_is_needed(spark, small_dir):
    text = plan(table_lineage.table_edges(fx.writes(spark, small_dir), fx.inputs(spark, small_dir)))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("o_orderpriority" not in s and "l_comment" not in s for s in schemas)
    good = writes.successful(spark.read.parquet(f"{small_dir}/orders.parquet").selectExpr(
        "o_orderkey", "o_orderstatus AS status"))
    assert "PushedFilters: [IsNotNull(o_orderstatus), EqualTo(o_orderstatus,success)]" in plan(good)


def test_spread_join_equals_a_join(spark, no_broadcast):
    hot = spark.range(5000).selectExpr("if(id < 4000, 0, id % 7) AS k", "id AS pos", "id * 2 AS v")
    one = spark.range(6).selectExpr("id AS k", "concat('n', id) AS name")
    plain = hot.join(one, "k").select("k", "pos", "v", "name")
    spread = spread_join(hot, one, ["k"], position_block(F.col("pos"))).select(*plain.columns)
    assert sorted(spread.collect()) == sorted(plain.collect())


@pytest.fixture(scope="module")
def hot_write(spark):
    """One write with most of all columns, entries and leaves."""
    n = 6 * BLOCK
    wide = leaf(0, "Wide", [column(k, f"c{k}") for k in range(n)])
    entries = [entry(k, f"o{k}", 10**6 + k, f"f(c{k}#{k}, c7#7)", [k, 7]) for k in range(n)]
    small = [
        write(k, inputs=[leaf(0, "S", [column(1, "Id")])], projections=[entry(0, "Id", 1)])
        for k in range(1, 200)
    ]
    given = records(spark, write(0, inputs=[wide], projections=entries), *small)
    return unnest(given), n


def test_hot_write_is_many_tasks(spark, hot_write, no_broadcast):
    capture, n = hot_write
    # Small partitions must stay apart for the count to mean anything.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        lineage = harvest(capture).column_lineage
        rows = lineage.withColumn("task", F.spark_partition_id()).cache()
        assert rows.count() == n + 199
        per_task = rows.filter("write_id = 0").groupBy("task").count().collect()
        assert max(r["count"] for r in per_task) <= n // 2
        sample = rows.filter("write_id = 0 AND out_pos = 5").first()
        assert sample.input_columns == ["raw.wide.c5@5k", "raw.wide.c7@5k"]
    finally:
        rows.unpersist()
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_hot_column_is_split_by_adaptive_execution(spark, hot_write, no_broadcast):
    # Every entry refers to column 7, so its id is a hot join key.
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        capture, n = hot_write
        lineage = harvest(capture).column_lineage
        assert len(lineage.collect()) == n + 199
        # The plan as it was run.
        assert "skew=true" in plan(lineage)
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_hot_thread_is_many_tasks(spark, no_broadcast):
    from spoor.operators.statements import statement_context

    day = spark.range(40000).selectExpr(
        "id AS event_id",
        "if(id % 3 = 0, id % 50, 7) AS thread_id",
        "timestamp_seconds(1700000000 + id * 10) AS ts",
        "id % 4 = 0 AS is_parse",
        "concat('q', id) AS sql_text",
    )
    parse = day.filter("is_parse").drop("is_parse")
    execs = day.filter("NOT is_parse").drop("is_parse", "sql_text")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = statement_context(parse, execs).withColumn("task", F.spark_partition_id())
        hot = found.filter("thread_id = 7").groupBy("task").count().collect()
        assert len(hot) == 8 and max(r["count"] for r in hot) < sum(r["count"] for r in hot) / 2
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_many_captures_of_one_command_meet_combined(spark, no_broadcast):
    again = spark.range(1000).selectExpr("1 AS write_id", "timestamp_seconds(id) AS exec_ts", "id")
    text = plan(writes.dedupe_commands(again))
    # One aggregation on each side of the shuffle.
    assert re.search(r"Aggregate.*Exchange.*Aggregate", text, re.S)
    assert writes.dedupe_commands(again).first().id == 0


def test_dedupe_of_all_writes_is_idempotent(spark, small_dir):
    w = fx.writes(spark, small_dir)
    once = writes.dedupe_commands(w)
    assert once.exceptAll(w).count() == 0 and w.exceptAll(once).count() == 0
    assert writes.dedupe_commands(once.unionByName(w)).exceptAll(once).count() == 0
