"""Lineage of nested write records, resolved within each record's row.

A record holds all that its write read and selected, so that ids meet their columns by
look-ups in arrays, without a join. The flat tables of ``column_lineage`` give the same
where a capture is kept in them, or where one write is too large for a row.

An id belongs to one relation; where several have it, the last one counts.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor import constants as c
from spoor.functions import names, text
from spoor.operators.column_lineage import column_records, is_simple
from spoor.operators.relations import ACCEPTED
from spoor.operators.table_lineage import with_input_names
from spoor.operators.writes import with_output_name, with_write_mode


def _accepted_inputs(accepted) -> Column:
    return F.filter("inputs", lambda x: x["relation_class"].isin(*accepted))


def lower_case_records(records: DataFrame) -> DataFrame:
    """Records whose table names are lower-cased, on both sides."""
    lowered = F.transform(
        "inputs",
        lambda x: x.withField("in_db", F.lower(x["in_db"])).withField("in_table", F.lower(x["in_table"])),
    )
    for name in ("out_db", "current_db", "out_table"):
        records = records.withColumn(name, F.lower(name))
    return records.withColumn("inputs", lowered)


def named_records(records: DataFrame, ns: str = c.DEFAULT_NAMESPACE, accepted=ACCEPTED) -> DataFrame:
    """What ``named_writes`` gives, with ``inputs`` and ``projections`` kept; ``inputs`` are
    the accepted ones. Writes without any drop out."""
    leaves = F.transform(
        "inputs",
        lambda x: F.struct(
            x["leaf_pos"].alias("leaf_pos"), x["in_db"].alias("in_db"), x["in_table"].alias("in_table")
        ),
    )
    known = (
        records.withColumn("inputs", _accepted_inputs(accepted))
        .filter(F.size("inputs") > 0)
        .withColumn("leaves", F.sort_array(F.array_distinct(leaves)))
    )
    return with_write_mode(with_output_name(with_input_names(known, ns), ns))


def rejected_records(records: DataFrame, accepted=ACCEPTED) -> DataFrame:
    """Writes without any accepted input: nothing can be derived for them."""
    none = F.coalesce(F.size(_accepted_inputs(accepted)), F.lit(0)) < 1
    return records.filter(none).select("write_id", F.lit("no_inputs").alias("reason"))


def table_edges(named: DataFrame) -> DataFrame:
    """Input table to output table, one edge per leaf."""
    edge = F.arrays_zip(F.col("leaves.leaf_pos").alias("leaf_pos"), F.col("input_tables").alias("input_table"))
    return named.select("write_id", "output_table", F.inline(edge)).select(
        "write_id", "leaf_pos", "input_table", "output_table"
    )


def _projected(ns: str, strip_ids: bool) -> Column:
    """The entries of ``projections`` that give lineage, looked up in ``ids`` and ``names``."""

    def name_of(expr_id: Column) -> Column:
        return F.get("names", (F.array_position("ids", expr_id) - 1).cast("int"))

    def found(entry: Column) -> Column:
        direct = name_of(entry["expr_id"])
        read = F.filter(
            F.transform(
                entry["leaves"],
                lambda leaf: F.struct(leaf["leaf_ord"].alias("ord"), name_of(leaf["leaf_expr_id"]).alias("name")),
            ),
            lambda leaf: leaf["name"].isNotNull(),
        )
        printed = entry["expr_text"]
        return F.struct(
            entry["out_pos"].cast("long").alias("out_pos"),
            entry["out_name"].alias("out_name"),
            entry["n_children"].alias("n_children"),
            direct.alias("direct"),
            F.coalesce(F.sort_array(F.array_distinct(read))["name"], F.array().cast("array<string>")).alias("read"),
            F.coalesce(text.strip_expression_ids(printed) if strip_ids else printed, F.lit("")).alias("printed"),
        )

    def record(entry: Column) -> Column:
        is_direct = entry["direct"].isNotNull()
        inputs = F.when(is_direct, F.array(entry["direct"])).otherwise(entry["read"])
        simple = is_simple(is_direct, inputs, entry["printed"])
        return _column(
            entry["out_pos"],
            entry["out_name"],
            inputs,
            F.when(simple, c.SIMPLE).otherwise(c.EXPRESSION),
            F.when(~simple, entry["printed"]),
        )

    entries = F.filter(
        F.transform("projections", found), lambda x: x["direct"].isNotNull() | (x["n_children"] > 0)
    )
    return F.transform(entries, record)


def _column(position, name, inputs, kind, expression) -> Column:
    return F.struct(
        position.alias("out_pos"),
        name.alias("out_name"),
        inputs.alias("input_columns"),
        kind.alias("dependency_type"),
        expression.alias("expression"),
    )


def _copied(ns: str) -> Column:
    """Every column of the relations, once for a name in each, by the least id."""

    def relation(leaf: Column) -> Column:
        columns = F.transform(
            leaf["columns"], lambda x: F.struct(x["col_name"].alias("name"), x["expr_id"].alias("id"))
        )
        # Sorted by name and id, the first of a name is the one that counts.
        ordered = F.sort_array(columns)
        firsts = F.filter(
            ordered, lambda x, at: (at == 0) | (F.get(ordered, at - 1)["name"] != x["name"])
        )
        kept = F.when(F.size(F.array_distinct(columns["name"])) == F.size(columns), columns).otherwise(firsts)
        return F.transform(
            kept,
            lambda x: _column(
                x["id"].cast("long"),
                x["name"],
                F.array(names.input_column_name(leaf["in_db"], leaf["in_table"], x["name"], ns)),
                F.lit(c.SIMPLE),
                F.lit(None).cast("string"),
            ),
        )

    return F.flatten(F.transform("inputs", relation))


def with_columns(
    named: DataFrame, ns: str = c.DEFAULT_NAMESPACE, strip_ids: bool = False, accepted=ACCEPTED
) -> DataFrame:
    """``named_records`` with the lineage of their columns as an array ``columns``, null
    where the query's root gives none."""
    # Last relations first, as a look-up takes the first of equal ids.
    backward = F.reverse(F.sort_array("inputs"))
    owned = F.flatten(
        F.transform(
            backward,
            lambda leaf: F.transform(
                leaf["columns"],
                lambda x: F.struct(
                    x["expr_id"].alias("id"),
                    names.input_column_name(leaf["in_db"], leaf["in_table"], x["col_name"], ns).alias("name"),
                ),
            ),
        )
    )
    is_project, is_copy = F.col("query_root") == c.PROJECT_ROOT, F.col("query_root").isin(*accepted)
    looked_up = named.withColumn("owned", F.when(is_project, owned)).withColumns(
        {"ids": F.col("owned.id"), "names": F.col("owned.name")}
    )
    return looked_up.withColumn(
        "columns", F.when(is_project, _projected(ns, strip_ids)).when(is_copy, _copied(ns))
    ).drop("owned", "ids", "names", "inputs", "projections")


def column_lineage(resolved: DataFrame, ns: str = c.DEFAULT_NAMESPACE) -> DataFrame:
    """One record per output column of records ``with_columns``."""
    # The outer form: Spark would add a filter that resolves the columns once more.
    columns = resolved.select(
        "write_id",
        "output_db",
        "out_table",
        "output_table",
        "write_mode",
        "sorted_inputs",
        "exec_ts",
        F.inline_outer("columns"),
    ).filter("out_name IS NOT NULL OR out_pos IS NOT NULL")
    return column_records(columns, ns)
