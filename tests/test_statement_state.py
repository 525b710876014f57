"""The texts a stream keeps between batches."""

from datetime import timedelta

from captures import AT
from spoor.streaming import statements

SCHEMA = "event_id bigint, thread_id bigint, ts timestamp, sql_text string"


def parses(spark, *rows):
    return spark.createDataFrame([(k, t, AT + timedelta(minutes=m), text) for k, (t, m, text) in enumerate(rows)], SCHEMA)


def kept(spark, path):
    return {r.thread_id: r.sql_text for r in spark.read.parquet(path).collect()}


def test_untouched_threads_are_not_rewritten(spark, tmp_path):
    state = str(tmp_path)
    batches = [
        [(1, 0, "a"), (1, 1, "b"), (2, 0, "c"), (None, 0, "n")],
        [(2, 5, "d")],
        [(3, 9, "e"), (2, 4, "late")],
        [(1, 500, "f")],
        [],
    ]
    for number, rows in enumerate(batches):
        statements.keep_texts(parses(spark, *rows), state, number, compact=2, forget="6 hours")
    assert [kept(spark, f"{state}/batch={k}") for k in range(4)] == [
        {1: "b", 2: "c", None: "n"}, {2: "d"}, {3: "e", 2: "late"}, {1: "f"},
    ]
    assert kept(spark, f"{state}/base=1") == {1: "b", 2: "d", None: "n"}
    # Threads without a parse for six hours are forgotten.
    assert kept(spark, f"{state}/base=3") == {1: "f"}
    schema, every = parses(spark).schema, list(range(statements.PARTS))
    for number, want in ((0, {}), (1, {1: "b", 2: "c", None: "n"}), (2, {1: "b", 2: "d", None: "n"}), (5, {1: "f"})):
        before = statements.last_texts(statements.texts_before(spark, state, number, schema, every, compact=2))
        assert {r.thread_id: r.sql_text for r in before.collect()} == want
    three = statements.last_texts(statements.texts_before(spark, state, 3, schema, every, compact=2))
    assert {r.thread_id: r.sql_text for r in three.collect()} == {1: "b", 2: "d", 3: "e", None: "n"}
    # Only the folders of the threads at hand are opened.
    part = parses(spark, (3, 0, "x")).select(statements._part()).first()[0]
    before = statements.texts_before(spark, state, 2, schema, [part], compact=2)
    text = before._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part#" in text and "= " + str(part) in text
