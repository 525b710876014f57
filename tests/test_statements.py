"""Statement context against a plain loop over the history."""

from datetime import datetime, timedelta

import pytest
from spoor.operators.statements import statement_context

START = datetime(2024, 1, 1)


def history(n):
    """A third of all events on thread 0; equal times and long silences included."""
    events = []
    for k in range(n):
        thread = 0 if k % 3 == 0 else k % 7
        seconds = (k * k) % 9000 + (k // 50) * 20000
        at = START + timedelta(seconds=seconds // 3 * 3)
        events.append((k, thread, at, f"sql {k}" if k % 5 in (0, 3) else None))
    return events


def by_loop(events):
    last, found = {}, {}
    order = sorted(events, key=lambda e: (e[2], e[3] is None, e[0]))
    for event_id, thread, _, text in order:
        if text is None:
            found[event_id] = last.get(thread)
        else:
            last[thread] = text
    return found


@pytest.mark.parametrize("slice_seconds", [1, 600, 3600, 10**9])
def test_any_slicing_gives_the_same(spark, slice_seconds):
    events = history(700)
    schema = "event_id int, thread_id int, ts timestamp, sql_text string"
    parse = spark.createDataFrame([e for e in events if e[3]], schema)
    execs = spark.createDataFrame([e[:3] for e in events if not e[3]], schema[:-17])
    rows = statement_context(parse, execs, slice_seconds).collect()
    assert {r.event_id: r.sql_text for r in rows} == by_loop(events)
    assert len(rows) == len(by_loop(events))


def test_no_parse_at_all(spark):
    parse = spark.createDataFrame([], "event_id int, thread_id int, ts timestamp, sql_text string")
    execs = spark.createDataFrame([(1, 1, START)], "event_id int, thread_id int, ts timestamp")
    assert [r.sql_text for r in statement_context(parse, execs).collect()] == [None]
