"""Table-level lineage. ``w`` holds the writes to derive for, ``i`` their leaves."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor import constants as c
from spoor.functions import names
from spoor.operators.relations import ACCEPTED, input_relations, with_input_name
from spoor.operators.spread import position_block, spread_join, unbroadcast
from spoor.operators.writes import with_output_name, with_write_mode


def write_inputs(w: DataFrame, i: DataFrame, accepted=ACCEPTED) -> DataFrame:
    """Every accepted leaf with the columns of its write."""
    leaves = input_relations(i, accepted)
    return spread_join(leaves, w, ["write_id"], position_block(F.col("leaf_pos")))


def table_edges(
    w: DataFrame, i: DataFrame, ns: str = c.DEFAULT_NAMESPACE, accepted=ACCEPTED
) -> DataFrame:
    """Input table to output table, one edge per leaf; a self join gives two."""
    w = w.select("write_id", "out_db", "current_db", "out_table")
    edges = with_input_name(write_inputs(with_output_name(w, ns), i, accepted), ns)
    return edges.select("write_id", "leaf_pos", "input_table", "output_table")


def relation_lists(i: DataFrame, accepted=ACCEPTED) -> DataFrame:
    """Per write its accepted relations in leaf order, as one array ``leaves``.

    The process name holds all of them and is one value of the result, so one write's
    relations end up in one row; map tasks combine their share before the shuffle.
    """
    leaf = F.struct("leaf_pos", "in_db", "in_table")
    return (
        input_relations(i, accepted)
        .groupBy("write_id")
        .agg(F.sort_array(F.collect_set(leaf)).alias("leaves"))
    )


def named_writes(
    w: DataFrame, i: DataFrame, ns: str = c.DEFAULT_NAMESPACE, accepted=ACCEPTED
) -> DataFrame:
    """Writes with output name, mode and inputs; writes without inputs drop out.

    ``input_tables`` is in leaf order, ``sorted_inputs`` joined by bare table name.
    """
    lists = with_input_names(relation_lists(i, accepted), ns)
    return with_write_mode(with_output_name(w, ns)).join(unbroadcast(lists), "write_id")


def with_input_names(lists: DataFrame, ns: str) -> DataFrame:
    """Adds ``input_tables`` and ``sorted_inputs``, the names of the relations in ``leaves``."""
    lists = lists.withColumn(
        "input_tables",
        F.transform("leaves", lambda x: names.input_table_name(x["in_db"], x["in_table"], ns)),
    )
    # The position keeps the order of inputs that share a name.
    by_name = F.sort_array(
        F.transform(
            "input_tables",
            lambda table, position: F.struct(
                names.input_sort_key(table).alias("key"),
                position.alias("position"),
                table.alias("table"),
            ),
        )
    )
    return lists.withColumn(
        "sorted_inputs", F.array_join(F.transform(by_name, lambda x: x["table"]), ":")
    )


def process_names(
    w: DataFrame, i: DataFrame, ns: str = c.DEFAULT_NAMESPACE, accepted=ACCEPTED
) -> DataFrame:
    """The process name of every write that has inputs."""
    name = names.process_name(F.col("sorted_inputs"), F.col("write_mode"), F.col("output_table"))
    return named_writes(w, i, ns, accepted).select(
        "write_id", "output_table", name.alias("process_name")
    )


def process_records(named: DataFrame, ns: str, *keep: str) -> DataFrame:
    """One process record per row of ``named_writes``, with the columns ``keep``."""
    query = F.lower("sql_text")
    target = names.process_name(F.col("sorted_inputs"), F.col("write_mode"), F.col("output_table"))
    return named.select(
        "write_id",
        "input_tables",
        "output_table",
        target.alias("qualified_name"),
        F.col("output_table").alias("name"),
        F.lit(c.PROCESS_USER).alias("user_name"),
        F.col("exec_ts").alias("start_time"),
        F.col("exec_ts").alias("end_time"),
        "operation_type",
        query.alias("query_id"),
        query.alias("query_text"),
        F.when(F.col("sql_text").isNotNull(), F.array(query)).alias("recent_queries"),
        F.lit(c.QUERY_PLAN).alias("query_plan"),
        F.lit(ns).alias("cluster_name"),
        *keep,
    )


def table_lineage(
    w: DataFrame, i: DataFrame, ns: str = c.DEFAULT_NAMESPACE, accepted=ACCEPTED
) -> DataFrame:
    """One process record per write; ``w`` carries its ``operation_type``."""
    return process_records(named_writes(w, i, ns, accepted), ns)


def rejected_writes(w: DataFrame, i: DataFrame, accepted=ACCEPTED) -> DataFrame:
    """Writes without any accepted input: nothing can be derived for them."""
    known = input_relations(i, accepted).select("write_id").distinct()
    return w.join(unbroadcast(known), "write_id", "left_anti").select(
        "write_id", F.lit("no_inputs").alias("reason")
    )
