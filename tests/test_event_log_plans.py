"""How event logs are read: each text once, and nothing that grows sent to every executor."""

import json

import pytest
from pyspark.sql import functions as F
from spoor.sources import event_log
from test_event_log import HIVE_PLAN, line
from workload import fixtures as fx
from workload import stream_queries


@pytest.fixture(scope="module")
def log(spark):
    insert = "InsertIntoHiveTable `mart`.`out`, x, [id]"
    ctas = "CreateHiveTableAsSelectCommand [Database: mart, TableName: out, InsertIntoHiveTable]"
    project = "Project [id#1L]\n      +- Relation spark_catalog.raw.t[id#1L] parquet"
    old = json.loads(line("app", 4, HIVE_PLAN.format(command=insert, query=project), root=2)[1])
    del old["rootExecutionId"]
    rows = [
        line("application_1_1", 2, HIVE_PLAN.format(command=ctas, query=project)),
        line("application_1_1", 3, HIVE_PLAN.format(command=insert, query=project), root=2),
        ("application_1_1", json.dumps(old)),
        line("application_1_1", 5, HIVE_PLAN.format(command="Aggregate InsertIntoHiveTable", query=project), root=2),
    ]
    rows = [("file:/log/application_1_1", value) for _, value in rows]
    return event_log.executions(spark.createDataFrame(rows, "file_path string, value string"))


def test_events_are_read_once(log):
    # Filters on fields of the event were pushed below it, with the event's text read for each.
    assert log._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_creations_are_not_broadcast(spark, log, tmp_path):
    # The test log is far below Spark's own limit, so it would be broadcast.
    log.write.parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    for df in (event_log.write_outcomes(stored), event_log.records_from_log(stored)):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()


def test_outcomes_of_one_pass(log):
    # An insert without a root, as older logs have it, was in no outcome and gave no record.
    found = {r.write_id.split("/")[1]: r.outcome for r in event_log.write_outcomes(log).collect()}
    assert found == {"2": "record", "3": "repeat", "4": "record", "5": "no_command"}
    records = {r.write_id.split("/")[1] for r in event_log.records_from_log(log).collect()}
    assert records == {"2", "4"}


def test_events_are_built_in_compiled_methods(spark, small_dir):
    # The JVM does not compile methods above 8000 bytes; plans filled in shape by shape made one.
    lines = stream_queries._shaped_lines(spark, small_dir)
    codes = spark._jvm.org.apache.spark.sql.execution.debug.package.codegenStringSeq(
        lines._jdf.queryExecution().executedPlan()
    )
    sizes = [codes.apply(k)._3().maxMethodCodeSize() for k in range(codes.size())]
    assert sizes and max(sizes) < 8000
    assert lines.count() == 2 * fx.writes(spark, small_dir).select(F.when(F.col("write_id") % 6 == 5, 3).otherwise(1).alias("n")).agg(F.sum("n")).first()[0]
