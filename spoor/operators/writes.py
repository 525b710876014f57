"""Captured write commands: filters, dispatch, names."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor import constants as c
from spoor.functions import names
from spoor.operators.spread import spread_join

SUPPORTED = tuple(c.OPERATION_TYPES)


def successful(w: DataFrame) -> DataFrame:
    """Executions that ended well; failed ones give no lineage."""
    return w.filter(F.col("status") == "success")


def with_operation_type(w: DataFrame) -> DataFrame:
    """Adds ``operation_type``, null for command classes without lineage."""
    operation = F.lit(None).cast("string")
    for command, name in c.OPERATION_TYPES.items():
        operation = F.when(F.col("command_class") == command, name).otherwise(operation)
    return w.withColumn("operation_type", operation)


def supported_writes(w: DataFrame, classes=SUPPORTED) -> DataFrame:
    return with_operation_type(w.filter(F.col("command_class").isin(*classes)))


def unsupported_writes(w: DataFrame) -> DataFrame:
    """The side output of the dispatch: classes nothing is derived for."""
    known = F.coalesce(F.col("command_class").isin(*SUPPORTED), F.lit(False))
    return w.filter(~known)


def dedupe_commands(w: DataFrame) -> DataFrame:
    """Each command once: its earliest capture.

    ``min`` over the whole row is combined before the shuffle, so many captures of one
    command do not meet in one task.
    """
    rest = [name for name in w.columns if name not in ("write_id", "exec_ts")]
    return (
        w.groupBy("write_id")
        .agg(F.min(F.struct("exec_ts", *rest)).alias("first"))
        .select("write_id", *[F.col(f"first.{name}") for name in w.columns if name != "write_id"])
        .select(*w.columns)
    )


def most_captures(w: DataFrame) -> int:
    """The captures of the command that has most; only ids are read and shuffled."""
    return w.groupBy("write_id").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0


def harvestable(w: DataFrame, classes=SUPPORTED, dedupe: bool = True) -> DataFrame:
    """Successful, supported writes, each once.

    ``dedupe=False`` is for capture tables whose ``write_id`` is known to be unique.
    """
    # All captures of a command are of one class, so others need not be shuffled.
    w = successful(w).filter(F.col("command_class").isin(*classes))
    return with_operation_type(dedupe_commands(w) if dedupe else w)


def with_output_name(w: DataFrame, ns: str = c.DEFAULT_NAMESPACE) -> DataFrame:
    database = names.output_database(F.col("out_db"), F.col("current_db"))
    return w.withColumn("output_db", database).withColumn(
        "output_table", names.table_name(F.col("output_db"), F.col("out_table"), ns)
    )


def with_write_mode(w: DataFrame) -> DataFrame:
    return w.withColumn("write_mode", names.write_mode(F.col("sql_text")))


def with_user(w: DataFrame, default: str) -> DataFrame:
    """The acting user: first that is not empty of run user, login user, ``default``."""
    given = [name for name in ("run_user", "login_user") if name in w.columns]
    candidates = [F.nullif(F.col(name), F.lit("")) for name in given]
    return w.withColumn("user", F.coalesce(*candidates, F.lit(default)))


def lower_case_names(w: DataFrame, i: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lower-case all database and table names, so both ends of an edge agree."""
    for name in ("out_db", "current_db", "out_table"):
        w = w.withColumn(name, F.lower(name))
    for name in ("in_db", "in_table"):
        i = i.withColumn(name, F.lower(name))
    return w, i


# --- executed plan nodes -----------------------------------------------------------

CANDIDATE_CLASSES = (c.WRITE_NODE, c.V2_WRITE_NODE, c.LEAF_NODE)
UNION_SALTS = 64


def union_children(nodes: DataFrame) -> DataFrame:
    """The direct children of every union node."""
    unions = nodes.filter(F.col("node_class") == c.UNION_NODE).select(
        "query_id", F.col("node_id").alias("parent_id")
    )
    children = nodes.filter(F.col("parent_id").isNotNull())
    salt = F.pmod(F.xxhash64("node_id"), F.lit(UNION_SALTS))
    joined = spread_join(children, unions, ["query_id", "parent_id"], salt)
    return joined.select(*nodes.columns)


def candidate_nodes(nodes: DataFrame) -> DataFrame:
    """Write, V2 write and leaf nodes, and the children of unions.

    A write below a union is there twice, as in the walk over the plan tree.
    """
    direct = nodes.filter(F.col("node_class").isin(*CANDIDATE_CLASSES))
    return direct.unionByName(union_children(nodes))


def write_commands(nodes: DataFrame) -> DataFrame:
    """Only nodes that carry a command; V2 writes and leaves end here."""
    return (
        candidate_nodes(nodes)
        .filter(F.col("node_class") == c.WRITE_NODE)
        .select("query_id", "write_id")
    )


def write_counts(nodes: DataFrame) -> DataFrame:
    """Write commands per query, before dedupe, 0 included."""
    is_write = (F.col("node_class") == c.WRITE_NODE).cast("int")
    direct = nodes.select("query_id", F.coalesce(is_write, F.lit(0)).alias("n"))
    below = union_children(nodes).filter(F.col("node_class") == c.WRITE_NODE)
    return (
        direct.unionByName(below.select("query_id", F.lit(1).alias("n")))
        .groupBy("query_id")
        .agg(F.sum("n").alias("n_writes"))
    )
