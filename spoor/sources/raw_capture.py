"""What a session's hooks see, before any pairing: parsed texts, executions and plan nodes.

``paired`` makes capture tables of it in one plan: every execution gets the text last
parsed on its thread, its plan's nodes are collected and unwrapped to the write commands,
and each command takes thread, time, outcome and text from its execution.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor.operators.spread import spread_join, unbroadcast
from spoor.operators.statements import HOUR, statement_context
from spoor.operators.writes import write_commands
from spoor.sources.capture import Capture

WRITE_SALTS = 64


@dataclass(frozen=True)
class RawCapture:
    """parses: ``event_id, thread_id, ts, sql_text``. executions: ``query_id, thread_id, ts,
    status``, unique on ``query_id``. nodes: ``query_id, node_id, parent_id, node_class,
    write_id``. commands: what a write has by itself, unique on ``write_id``. The others
    are as in ``Capture``."""

    parses: DataFrame
    executions: DataFrame
    nodes: DataFrame
    commands: DataFrame
    inputs: DataFrame
    relation_columns: DataFrame
    projections: DataFrame
    projection_leaves: DataFrame


def paired(raw: RawCapture, slice_seconds: int = HOUR) -> Capture:
    """The capture tables of the write commands that the executed plans hold.

    Commands of no plan drop out, and so do V2 writes. A command below a union is met
    twice and counts once; one that several executions share stays with each, for the
    dedupe of ``harvest``. An execution without an earlier parse has a null text.
    """
    executions = raw.executions.withColumnRenamed("query_id", "event_id")
    texts = statement_context(raw.parses, executions, slice_seconds)
    found = write_commands(raw.nodes).filter(F.col("write_id").isNotNull()).distinct()
    salt = F.pmod(F.xxhash64("write_id"), F.lit(WRITE_SALTS))
    # A query may hold any number of writes, so its one execution is met by parts of them.
    context = texts.select(F.col("event_id").alias("query_id"), "thread_id", F.col("ts").alias("exec_ts"), "status", "sql_text")
    executed = spread_join(found, context, ["query_id"], salt).drop("query_id")
    writes = executed.join(unbroadcast(raw.commands), "write_id")
    return Capture(writes, raw.inputs, raw.relation_columns, raw.projections, raw.projection_leaves)
