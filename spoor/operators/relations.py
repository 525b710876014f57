"""Relations read by a write, and their columns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spoor import constants as c
from spoor.functions import names
from spoor.operators.spread import unbroadcast

ACCEPTED = (c.HIVE_RELATION,)


def input_relations(i: DataFrame, accepted=ACCEPTED) -> DataFrame:
    """Leaves of the accepted relation classes; any other leaf is invisible."""
    return i.filter(F.col("relation_class").isin(*accepted))


def with_input_name(i: DataFrame, ns: str = c.DEFAULT_NAMESPACE) -> DataFrame:
    return i.withColumn(
        "input_table", names.input_table_name(F.col("in_db"), F.col("in_table"), ns)
    )


def relation_columns(relations: DataFrame) -> DataFrame:
    """One row per column of a relation, from its data and its partition columns.

    ``relations`` has ``write_id, leaf_pos`` and two arrays of
    ``(expr_id, col_name)`` structs, ``data_cols`` and ``partition_cols``.
    """

    def flagged(name: str, is_partition: bool):
        columns = F.coalesce(F.col(name), F.array())
        return F.transform(
            columns,
            lambda col: F.struct(
                col["expr_id"].alias("expr_id"),
                col["col_name"].alias("col_name"),
                F.lit(is_partition).alias("is_partition"),
            ),
        )

    both = F.concat(flagged("data_cols", False), flagged("partition_cols", True))
    # The plain form would build the arrays once more, to filter out empty ones.
    columns = relations.select("write_id", "leaf_pos", F.inline_outer(both))
    return columns.filter(F.col("expr_id").isNotNull())


def with_column_name(rc: DataFrame, i: DataFrame, ns: str = c.DEFAULT_NAMESPACE) -> DataFrame:
    """Adds the qualified ``column_name``; columns of unknown relations are dropped."""
    relation = i.select("write_id", "leaf_pos", "in_db", "in_table")
    name = names.input_column_name(F.col("in_db"), F.col("in_table"), F.col("col_name"), ns)
    return (
        rc.join(unbroadcast(relation), ["write_id", "leaf_pos"])
        .withColumn("column_name", name)
        .drop("in_db", "in_table")
    )
