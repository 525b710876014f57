"""A real session's writes, read back from its event log."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from spoor.plans.harvest import harvest
from spoor.sources import event_log
from spoor.sources.capture import unnest

SESSION = """
import sys
from pyspark.sql import SparkSession
folder, data, compress = sys.argv[1:]
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", folder + "/log")
    .config("spark.eventLog.compress", compress)
    .config("spark.sql.ui.explainMode", "extended")
    .config("spark.sql.debug.maxToStringFields", "100000")
    .config("spark.sql.shuffle.partitions", "2")
    .config("spark.sql.warehouse.dir", folder + "/tables").getOrCreate()
)
spark.read.parquet(data + "/customer.parquet").write.saveAsTable("customer")
spark.read.parquet(data + "/nation.parquet").write.saveAsTable("nation")
spark.sql("CREATE DATABASE mart")
job = spark.sparkContext.setJobDescription
job("CREATE TABLE mart.C1 AS SELECT ...")
spark.sql(
    "CREATE TABLE mart.C1 USING parquet AS SELECT c_custkey AS k, c_acctbal + 1 AS b, "
    "concat(c_name, ', ', n_name) AS both, c_name, 'x,(y' AS lit "
    "FROM customer JOIN nation ON c_nationkey = n_nationkey"
)
job("CREATE TABLE overwrite_log AS SELECT * FROM customer")
spark.sql("CREATE TABLE overwrite_log USING parquet AS SELECT * FROM customer")
job("agg")
spark.sql("CREATE TABLE agg USING parquet AS SELECT c_nationkey, count(*) n FROM customer GROUP BY 1")
job("saved")
spark.table("customer").selectExpr("c_acctbal / 2 AS half").write.saveAsTable("saved")
try:
    spark.sql("CREATE TABLE bad USING parquet AS SELECT raise_error('no') AS e, c_name FROM customer")
except Exception:
    pass
spark.table("customer").write.parquet(folder + "/plain")
spark.stop()
"""


@pytest.fixture(scope="module", params=["false", "true"])
def log(request, spark, small_dir, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("session"))
    os.mkdir(folder + "/log")
    subprocess.run(
        [sys.executable, "-c", SESSION, folder, small_dir, request.param],
        check=True,
        timeout=300,
        capture_output=True,
    )
    return event_log.scan_event_log(spark, folder + "/log", request.param == "true").cache()


@pytest.fixture(scope="module")
def found(log):
    capture = unnest(event_log.records_from_log(log))
    return harvest(capture, accepted=event_log.LOG_RELATIONS)


def test_outcomes(log):
    outcome = {(r.status, r.description) for r in log.select("status", "description").collect()}
    assert ("success", "agg") in outcome
    assert any(status == "failure" for status, _ in outcome)


def test_tables(found):
    edges = {(e.input_table, e.output_table) for e in found.table_edges.collect()}
    assert edges == {
        ("default.customer@5k", "mart.C1@5k"),
        ("default.nation@5k", "mart.C1@5k"),
        ("default.customer@5k", "default.overwrite_log@5k"),
        ("default.customer@5k", "default.agg@5k"),
        ("default.customer@5k", "default.saved@5k"),
    }


def test_write_mode_from_the_text(found):
    names = [r.qualified_name for r in found.table_lineage.collect()]
    assert [n for n in names if ":INSERT_OVERWRITE:" in n] == [
        "QUERY:default.customer@5k->:INSERT_OVERWRITE:default.overwrite_log@5k"
    ]


def test_columns(found):
    rows = found.column_lineage.collect()
    columns = {r.output_column: (r.input_columns, r.dependency_type) for r in rows}
    customer, nation = "default.customer.{}@5k".format, "default.nation.{}@5k".format
    assert columns["mart.C1.k@5k"] == ([customer("c_custkey")], "SIMPLE")
    assert columns["mart.C1.b@5k"] == ([customer("c_acctbal")], "EXPRESSION")
    assert columns["mart.C1.both@5k"] == (
        [customer("c_name"), nation("n_name")],
        "EXPRESSION",
    )
    assert columns["mart.C1.c_name@5k"] == ([customer("c_name")], "SIMPLE")
    assert columns["mart.C1.lit@5k"] == ([], "EXPRESSION")
    assert columns["default.saved.half@5k"] == ([customer("c_acctbal")], "EXPRESSION")
    copied = [name for name in columns if name.startswith("default.overwrite_log.")]
    assert len(copied) == 5
    assert not [name for name in columns if ".agg." in name or ".bad." in name]


def test_nothing_unreadable(log):
    assert event_log.unreadable_writes(log).count() == 0


def line(app, execution_id, plan=None, error="", root=None):
    if plan is None:
        event = {"Event": event_log.END, "executionId": execution_id, "time": 2}
        event["errorMessage"] = error
    else:
        event = {
            "Event": event_log.START,
            "executionId": execution_id,
            "rootExecutionId": execution_id if root is None else root,
            "time": 1,
            "description": "INSERT OVERWRITE x",
            "physicalPlanDescription": plan,
        }
    return (f"file:/logs/{app}", json.dumps(event))


HIVE_PLAN = (
    "== Optimized Logical Plan ==\n"
    "{command}\n"
    "+- {query}\n"
    "   +- HiveTableRelation [`spark_catalog`.`raw`.`t`, org.apache.Serde, "
    "Data Cols: [id#1L, amount#2], Partition Cols: [dt#3]]\n\n== Physical Plan ==\nx"
)


def test_hive_commands(spark):
    insert = "InsertIntoHiveTable `spark_catalog`.`mart`.`out`, org.apache.Serde, false, false, [a]"
    ctas = "CreateHiveTableAsSelectCommand [Database: mart, TableName: Made, InsertIntoHiveTable]"
    project = "Project [id#1L, cast(amount#2 as int) AS n#9, dt#3 AS day#10]"
    relation = "HiveTableRelation [`spark_catalog`.`raw`.`t`, org.apache.Serde, " \
        "Data Cols: [id#1L, amount#2], Partition Cols: [dt#3]]"
    rows = [
        line("application_1_1", 1, HIVE_PLAN.format(command=insert, query=project)),
        line("application_1_1", 1),
        line("application_1_1", 2, HIVE_PLAN.format(command=ctas, query=project)),
        line("application_1_1", 3, HIVE_PLAN.format(command=insert, query=project), root=2),
        line("application_1_1", 3),
        line("application_1_1", 2),
        line("application_1_2", 1, HIVE_PLAN.format(command=insert, query=relation).replace(
            f"\n   +- {relation}", "")),
        line("application_1_2", 1),
        line("application_1_2", 2, HIVE_PLAN.format(command=insert, query=project)),
        line("application_1_2", 3, "InsertIntoHiveTable only, plan in short form"),
        line("application_1_2", 4, HIVE_PLAN.format(command=insert, query="Project [... 3 more fields]")),
    ]
    lines = spark.createDataFrame(rows, "file_path string, value string")
    log = event_log.executions(lines)
    assert {r.status for r in log.filter("app_id = 'application_1_2'").collect()} == {
        "success",
        "running",
    }
    reasons = {r.execution_id: r.reason for r in event_log.unreadable_writes(log).collect()}
    assert reasons == {3: "no_optimized_plan", 4: "cut_plan"}
    result = harvest(unnest(event_log.records_from_log(log)))
    columns = result.column_lineage.withColumn("inputs", F.array_join("input_columns", ","))
    found = {(r.write_id, r.output_column): (r.inputs, r.dependency_type) for r in columns.collect()}
    selected = {
        "id": ("raw.t.id@5k", "SIMPLE"),
        "n": ("raw.t.amount@5k", "EXPRESSION"),
        "day": ("raw.t.dt@5k", "SIMPLE"),
    }
    expected = {}
    for write_id, table in (("application_1_1/1", "mart.out"), ("application_1_1/2", "mart.Made")):
        expected |= {(write_id, f"{table}.{k}@5k"): v for k, v in selected.items()}
    for name in ("id", "amount", "dt"):
        expected["application_1_2/1", f"mart.out.{name}@5k"] = (f"raw.t.{name}@5k", "SIMPLE")
    assert found == expected
