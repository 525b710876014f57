"""Trees and select lists of printed plans, and a real session with several shapes."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F
from spoor.plans.harvest import harvest
from spoor.sources import event_log, printed_plan
from spoor.sources.capture import unnest


def evaluate(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) else 'array<string>'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first().x


TREE = (
    "Union false, false\n:- Union\n:  :- A [x]\n:  :  +- Project [a\nb AS c#1]\n:  :     +- A [inner]\n"
    ":  +- B [y]\n:     +- Leaf\n+- Filter\n   +- A [below a filter]"
)


def test_tree(spark):
    nodes = printed_plan.joined_lines(printed_plan.indented(F.col("text")))
    found = [tuple(n) for n in evaluate(spark, nodes, text=TREE)]
    assert found[:5] == [(0, "Union false, false"), (1, "Union"), (2, "A [x]"), (3, "Project [a\nb AS c#1]"), (4, "A [inner]")]
    assert [depth for depth, _ in found[5:]] == [2, 3, 1, 2]
    assert evaluate(spark, printed_plan.reached(nodes, ("A", "B")), text=TREE) == [2, 5]
    below = [n.text for n in evaluate(spark, printed_plan.below(nodes, F.lit(2)), text=TREE)]
    assert below == ["Project [a\nb AS c#1]", "A [inner]"]
    assert evaluate(spark, printed_plan.below(nodes, F.lit(6)), text=TREE) == []
    assert evaluate(spark, printed_plan.reached(nodes, ("A",)), text="A [x]") == [0]
    assert evaluate(spark, printed_plan.reached(nodes, ("A",)), text="") == []


@pytest.mark.parametrize(
    ("printed", "names", "want"),
    [
        ("a#1, f(b#2, c#3L) AS d#4", ["a", "d"], ["a#1", "f(b#2, c#3L) AS d#4"]),
        ("x,(y AS lit#1, a#2", ["lit", "a"], ["x,(y AS lit#1", "a#2"]),
        ("f(a#1, ( AS a#5, b#2", ["a", "b"], ["f(a#1, ( AS a#5", "b#2"]),
        ("f(a, a#1) AS a#2", ["a"], ["f(a, a#1) AS a#2"]),
        ("a#1, b#2", ["a"], None),
        ("a#1", ["a", "b"], None),
        ("a#1, b#2", ["b", "a"], None),
    ],
)
def test_named_entries(spark, printed, names, want):
    entries = printed_plan.named_entries(F.col("printed"), F.col("names"))
    assert evaluate(spark, entries, printed=printed, names=names) == want


def test_balanced_entries(spark):
    entries = printed_plan.balanced_entries(F.col("printed"))
    assert evaluate(spark, entries, printed="a#1, f(b#2, c#3L) AS d#4") == ["a#1", "f(b#2, c#3L) AS d#4"]
    assert evaluate(spark, entries, printed="x,(y AS lit#1, a#2") is None


def test_attributes(spark):
    found = evaluate(spark, printed_plan.attributes(F.col("text")), text="(a#1 + f(b c#22L, 'x'))[0] see #3 d#")
    assert [tuple(x) for x in found] == [("a", 1), ("c", 22)]


SESSION = """
import sys
from pyspark.sql import SparkSession
folder, data = sys.argv[1:]
spark = (
    SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
    .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", folder + "/log")
    .config("spark.sql.ui.explainMode", "extended").config("spark.sql.debug.maxToStringFields", "100000")
    .config("spark.sql.warehouse.dir", folder + "/tables").getOrCreate()
)
spark.read.parquet(data + "/nation.parquet").createOrReplaceTempView("seen")
spark.sql("CREATE TABLE nation USING parquet AS SELECT * FROM seen")
spark.sql("CREATE TABLE one (k BIGINT) USING parquet")
spark.sql("CREATE TABLE two (n STRING) USING parquet")
spark.sql("FROM nation INSERT INTO one SELECT n_nationkey INSERT OVERWRITE two SELECT n_name")
spark.sql("CREATE TABLE odd USING parquet AS SELECT 'a (b' AS lit, n_name AS nm, 'n_name#1, (' AS mark FROM nation")
spark.sql("SELECT 'InsertIntoHiveTable' AS word FROM nation").collect()
spark.stop()
"""


def test_a_session_with_several_writes(spark, small_dir, tmp_path):
    os.mkdir(tmp_path / "log")
    subprocess.run(
        [sys.executable, "-c", SESSION, str(tmp_path), small_dir], check=True, timeout=300, capture_output=True
    )
    log = event_log.scan_event_log(spark, str(tmp_path / "log"), commands=event_log.WRITE_COMMANDS).cache()
    outcomes = event_log.write_outcomes(log).groupBy("command_class", "outcome").count().collect()
    assert {(r.command_class, r.outcome) for r in outcomes} == {
        (event_log.c.DATASOURCE_CTAS, "record"),
        (event_log.HADOOP_INSERT, "repeat"),
        (event_log.HADOOP_INSERT, "unsupported"),
        (None, "no_command"),
    }
    found = harvest(unnest(event_log.records_from_log(log)), accepted=event_log.LOG_RELATIONS)
    # Both parts of the multi-insert are reported, the inserts inside a creation are not.
    assert sorted(r.out_table for r in found.unsupported.collect()) == ["one", "two"]
    columns = {r.output_column: r.input_columns for r in found.column_lineage.collect()}
    assert columns["default.odd.nm@5k"] == ["default.nation.n_name@5k"]
    assert columns["default.odd.lit@5k"] == [] and columns["default.odd.mark@5k"] == []
    assert event_log.unreadable_writes(log).count() == 0
