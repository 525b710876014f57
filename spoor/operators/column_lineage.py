"""Column-level lineage.

``w`` holds the writes to derive for, ``i`` their leaves, ``rc`` the columns of the
leaves, ``p`` the top-level select list and ``pl`` the leaves of its entries.

``rc`` is the biggest table. It is shuffled on ``(write_id, expr_id)`` and meets only
the ids the select lists refer to. Entries and their matches then share one shuffle on
``(write_id, block of positions)``, on which they are grouped and joined to their write;
names are built last, from the write's list of relations.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor import constants as c
from spoor.functions import names, text
from spoor.operators.relations import ACCEPTED, input_relations, with_column_name
from spoor.operators.spread import position_block, unbroadcast
from spoor.operators.table_lineage import named_writes, relation_lists

# Order of an entry's own id, before all its leaves.
OWN = -1


def expression_text(p: DataFrame, strip_ids: bool = False) -> DataFrame:
    """Adds ``expression``: the printed children joined by a comma."""
    whole = F.array_join("children", ",") if "children" in p.columns else F.col("expr_text")
    return p.withColumn("expression", text.strip_expression_ids(whole) if strip_ids else whole)


def own_references(p: DataFrame) -> DataFrame:
    """The id an entry has itself: a relation's id when the entry is a bare column."""
    return p.select("write_id", "out_pos", F.lit(OWN).alias("leaf_ord"), "expr_id")


def leaf_references(pl: DataFrame) -> DataFrame:
    """The ids at the leaves of an entry; literals have none."""
    return pl.filter(F.col("leaf_expr_id").isNotNull()).select(
        "write_id", "out_pos", "leaf_ord", F.col("leaf_expr_id").alias("expr_id")
    )


def matched_references(
    refs: DataFrame, i: DataFrame, rc: DataFrame, ns: str = c.DEFAULT_NAMESPACE, accepted=ACCEPTED
) -> DataFrame:
    """References that an accepted relation owns, with the column's name."""
    columns = rc.select("write_id", "leaf_pos", "expr_id", "col_name")
    owned = refs.join(unbroadcast(columns), ["write_id", "expr_id"])
    return with_column_name(owned, input_relations(i, accepted), ns).select(
        "write_id", "out_pos", "leaf_ord", "expr_id", "column_name"
    )


def unowned_entries(
    i: DataFrame, rc: DataFrame, p: DataFrame, ns: str = c.DEFAULT_NAMESPACE, accepted=ACCEPTED
) -> DataFrame:
    """Entries without children that no accepted relation owns: skipped."""
    direct = matched_references(own_references(p), i, rc, ns, accepted)
    bare = p.filter(F.col("n_children") == 0)
    found = unbroadcast(direct.select("write_id", "out_pos"))
    return bare.join(found, ["write_id", "out_pos"], "left_anti")


def with_dependency_type(cl: DataFrame) -> DataFrame:
    """Adds ``dependency_type`` and clears the expression of simple entries.

    A computed entry is simple when it has one input and its text no pair of
    parentheses.
    """
    printed = F.coalesce(F.col("expression"), F.lit(""))
    simple = is_simple(F.col("is_direct"), F.col("input_columns"), printed)
    return cl.withColumn(
        "dependency_type", F.when(simple, c.SIMPLE).otherwise(c.EXPRESSION)
    ).withColumn("expression", F.when(~simple, printed))


def is_simple(is_direct: Column, input_columns: Column, printed: Column) -> Column:
    plain = ~(F.contains(printed, F.lit("(")) & F.contains(printed, F.lit(")")))
    return is_direct | ((F.size(input_columns) == 1) & plain)


def _found(refs: DataFrame, rc: DataFrame) -> DataFrame:
    """References with the relation column of their id, accepted or not."""
    # Without a position it is of no relation. As whole-table copies join on it, both then read
    # the same rows, and a shuffle behind them is used for both.
    columns = rc.select("write_id", "leaf_pos", "expr_id", "col_name").filter("leaf_pos IS NOT NULL")
    return refs.join(unbroadcast(columns), ["write_id", "expr_id"]).select(
        "write_id", "out_pos", "leaf_ord", F.struct("leaf_pos", "col_name").alias("column")
    )


def _relation_names() -> Column:
    """Leaf position to lower-cased ``db.table`` for the write's accepted relations."""
    return F.map_from_entries(
        F.transform(
            "leaves",
            lambda leaf: F.struct(
                leaf["leaf_pos"], names.relation_name(leaf["in_db"], leaf["in_table"])
            ),
        )
    )


def _column_name(column: Column, ns: str) -> Column:
    """Name of a found column, null when its relation is not accepted."""
    relation = F.try_element_at("relations", column["leaf_pos"])
    return names.column_of_relation(relation, column["col_name"], ns)


def projected_columns(
    w: DataFrame,
    rc: DataFrame,
    p: DataFrame,
    pl: DataFrame | None,
    ns: str = c.DEFAULT_NAMESPACE,
    strip_ids: bool = False,
) -> DataFrame:
    """Select-list entries of the writes ``w`` with their inputs, direct and computed.

    ``w`` has the write's accepted relations in ``leaves``, as ``relation_lists`` gives
    them; its other columns are kept.
    """
    block = position_block(F.col("out_pos"))
    parts = int(p.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    refs = own_references(p)
    if pl is not None:
        refs = refs.unionByName(leaf_references(pl))
    entries = expression_text(p, strip_ids).select(
        "write_id", "out_pos", "out_name", "n_children", "expression"
    )
    together = (
        entries.unionByName(_found(refs, rc), allowMissingColumns=True)
        .withColumn("_block", block)
        # By number: adaptive execution would put partitions together by compressed size.
        .repartition(parts, "write_id", "_block")
    )
    own = F.col("leaf_ord") == OWN
    grouped = together.groupBy("write_id", "_block", "out_pos").agg(
        F.max("out_name").alias("out_name"),
        F.max("n_children").alias("n_children"),
        F.max("expression").alias("expression"),
        F.max(F.when(own, F.col("column"))).alias("own"),
        # A set, because one relation may be listed twice below a union.
        F.collect_set(F.when(~own, F.struct("leaf_ord", "column"))).alias("found"),
    )
    blocks = p.select("write_id", block.alias("_block")).distinct()
    w = w.withColumn("relations", _relation_names()).drop("leaves")
    with_names = blocks.join(unbroadcast(w), "write_id")
    joined = grouped.join(unbroadcast(with_names), ["write_id", "_block"]).drop("_block")

    direct = _column_name(F.col("own"), ns)
    named = F.transform(
        "found",
        lambda x: F.struct(
            x["leaf_ord"].alias("leaf_ord"), _column_name(x["column"], ns).alias("name")
        ),
    )
    accepted = F.sort_array(F.array_distinct(F.filter(named, lambda x: x["name"].isNotNull())))
    resolved = (
        joined.withColumn("direct", F.when(F.col("own").isNotNull(), direct))
        .withColumn("is_direct", F.col("direct").isNotNull())
        .filter(F.col("is_direct") | (F.col("n_children") > 0))
        .withColumn(
            "input_columns",
            F.when(F.col("is_direct"), F.array("direct")).otherwise(
                F.transform(accepted, lambda x: x["name"])
            ),
        )
    )
    keep = [name for name in w.columns if name not in ("write_id", "query_root", "relations")]
    return with_dependency_type(resolved).select(
        "write_id",
        F.col("out_pos").cast("long").alias("out_pos"),
        "out_name",
        "is_direct",
        "input_columns",
        "dependency_type",
        "expression",
        *keep,
    )


def _with_root(w: DataFrame, *roots: str) -> DataFrame:
    return w.filter(F.col("query_root").isin(*roots))


def direct_columns(w, i, rc, p, ns=c.DEFAULT_NAMESPACE, accepted=ACCEPTED) -> DataFrame:
    """Entries that are a relation's column as it is."""
    lists = _with_root(w, c.PROJECT_ROOT).select("write_id").join(
        unbroadcast(relation_lists(i, accepted)), "write_id"
    )
    return projected_columns(lists, rc, p, None, ns).filter("is_direct").drop("is_direct")


def computed_columns(
    w, i, rc, p, pl, ns=c.DEFAULT_NAMESPACE, strip_ids=False, accepted=ACCEPTED
) -> DataFrame:
    """Renames and expressions, with every owned leaf in order."""
    # Without accepted relations an expression still is one, with no inputs.
    lists = _with_root(w, c.PROJECT_ROOT).select("write_id").join(
        unbroadcast(relation_lists(i, accepted)), "write_id", "left"
    )
    columns = projected_columns(lists, rc, p, pl, ns, strip_ids)
    return columns.filter("NOT is_direct").drop("is_direct")


def copied_columns(w, rc, ns=c.DEFAULT_NAMESPACE, accepted=ACCEPTED) -> DataFrame:
    """Whole-table copies, where the query is an accepted relation itself.

    ``w`` is as in ``projected_columns``. Columns of the same name count once.
    ``out_pos`` is the column's id, which orders them as in the table.
    """
    keep = [name for name in w.columns if name not in ("write_id", "query_root", "leaves")]
    relations = _with_root(w, *accepted).select("write_id", *keep, F.inline("leaves"))
    columns = rc.select("write_id", "leaf_pos", "expr_id", "col_name").join(
        unbroadcast(relations), ["write_id", "leaf_pos"]
    )
    name = names.input_column_name(F.col("in_db"), F.col("in_table"), F.col("col_name"), ns)
    # All but the id depends on the first three, so the rows are hashed, not sorted. The
    # shuffle spreads the columns of one relation and leaves the join free to be split.
    same = ["write_id", "leaf_pos", "col_name", "in_db", "in_table", *keep]
    return (
        columns.repartition("write_id", "leaf_pos", "col_name")
        .groupBy(*same)
        .agg(F.min("expr_id").alias("out_pos"))
        .select(
            "write_id",
            F.col("out_pos").cast("long").alias("out_pos"),
            F.col("col_name").alias("out_name"),
            F.array(name).alias("input_columns"),
            F.lit(c.SIMPLE).alias("dependency_type"),
            F.lit(None).cast("string").alias("expression"),
            *keep,
        )
    )


def lineage_columns(
    named: DataFrame,
    rc: DataFrame,
    p: DataFrame,
    pl: DataFrame,
    ns: str = c.DEFAULT_NAMESPACE,
    strip_ids: bool = False,
    accepted=ACCEPTED,
) -> DataFrame:
    """Projected and copied columns of ``named`` writes, whose other columns are kept."""
    projected = projected_columns(_with_root(named, c.PROJECT_ROOT), rc, p, pl, ns, strip_ids)
    copied = copied_columns(named, rc, ns, accepted)
    return projected.drop("is_direct").unionByName(copied)


def column_lineage(
    w: DataFrame,
    i: DataFrame,
    rc: DataFrame,
    p: DataFrame,
    pl: DataFrame,
    ns: str = c.DEFAULT_NAMESPACE,
    strip_ids: bool = False,
    accepted=ACCEPTED,
) -> DataFrame:
    """One record per output column of every write with inputs.

    ``process_name`` refers to the process of the write.
    """
    named = named_writes(w, i, ns, accepted).select(
        "write_id",
        "query_root",
        "leaves",
        "output_db",
        "out_table",
        "output_table",
        "write_mode",
        "sorted_inputs",
        "exec_ts",
    )
    return column_records(lineage_columns(named, rc, p, pl, ns, strip_ids, accepted), ns)


def column_records(columns: DataFrame, ns: str) -> DataFrame:
    """The records of columns that carry their write's names, mode and inputs."""
    database, table, column = F.col("output_db"), F.col("out_table"), F.col("out_name")
    label = names.column_process_label(database, table, column, ns)

    def process(target):
        return names.process_name(F.col("sorted_inputs"), F.col("write_mode"), target)

    return columns.select(
        "write_id",
        "out_pos",
        names.output_column_name(database, table, column, ns).alias("output_column"),
        "input_columns",
        "dependency_type",
        "expression",
        process(label).alias("qualified_name"),
        label.alias("name"),
        process(F.col("output_table")).alias("process_name"),
        "exec_ts",
    )


def column_edges(cl: DataFrame) -> DataFrame:
    """Input column to output column, one row each; no input gives one null edge."""
    return cl.select(
        "write_id",
        "out_pos",
        "output_column",
        F.posexplode_outer("input_columns").alias("input_pos", "input_column"),
    )
