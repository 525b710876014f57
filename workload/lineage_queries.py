"""Registered queries: filters, names, joins and lineage, with their oracle SQL."""

from pyspark.sql import functions as F

from spoor import constants as c
from spoor.functions import names
from spoor.operators import column_lineage as cols
from spoor.operators import relations, statements, table_lineage, writes
from spoor.operators.spread import position_block, spread_join, unbroadcast
from spoor.plans.harvest import harvest
from spoor.sources.raw_capture import paired
from workload import fixtures as fx
from workload.sql import on_raw_writes

QUERIES = {}
ORACLE = {}


def query(sql: str | None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def _harvestable(spark, sf):
    return writes.harvestable(fx.writes(spark, sf))


def _text(df, name="input_columns", separator=","):
    return df.withColumn(name, F.array_join(name, separator))


# --- sources and filters --------------------------------------------------------------


@query("SELECT write_id, leaf_pos, expr_id, col_name, is_partition FROM fx_relation_column")
def relation_columns(spark, sf):
    return relations.relation_columns(fx.relations(spark, sf))


@query("SELECT write_id, command_class FROM fx_write WHERE status = 'success'")
def successful_writes(spark, sf):
    return writes.successful(fx.writes(spark, sf)).select("write_id", "command_class")


@query("SELECT * FROM candidate")
def candidate_nodes(spark, sf):
    return writes.candidate_nodes(fx.plan_nodes(spark, sf))


@query("SELECT query_id, write_id FROM candidate WHERE node_class = 'DataWritingCommandExec'")
def write_commands(spark, sf):
    return writes.write_commands(fx.plan_nodes(spark, sf))


@query("""
SELECT c.query_id, c.node_id, c.node_class
FROM fx_plan_node c JOIN fx_plan_node u
  ON c.query_id = u.query_id AND c.parent_id = u.node_id AND u.node_class = 'UnionExec'""")
def union_children(spark, sf):
    nodes = fx.plan_nodes(spark, sf)
    return writes.union_children(nodes).select("query_id", "node_id", "node_class")


@query("""
SELECT q.query_id, count(c.write_id) AS n_writes
FROM (SELECT DISTINCT query_id FROM fx_plan_node) q
LEFT JOIN candidate c ON q.query_id = c.query_id AND c.node_class = 'DataWritingCommandExec'
GROUP BY q.query_id""")
def write_counts(spark, sf):
    return writes.write_counts(fx.plan_nodes(spark, sf))


@query("""
SELECT write_id, command_class,
       CASE WHEN command_class = 'InsertIntoHiveTable' THEN 'INSERT_INTO_HIVE_TABLE'
            WHEN command_class IN ('CreateHiveTableAsSelectCommand', 'CreateDataSourceTableAsSelectCommand')
            THEN 'CREATETABLE_AS_SELECT' END AS operation_type
FROM fx_write""")
def operation_types(spark, sf):
    w = writes.with_operation_type(fx.writes(spark, sf))
    return w.select("write_id", "command_class", "operation_type")


@query("""
SELECT write_id, command_class FROM fx_write WHERE command_class = 'InsertIntoHadoopFsRelationCommand'""")
def unsupported_writes(spark, sf):
    return writes.unsupported_writes(fx.writes(spark, sf)).select("write_id", "command_class")


@query("SELECT write_id, leaf_pos, in_db, in_table FROM fx_input WHERE relation_class = 'HiveTableRelation'")
def input_relations(spark, sf):
    leaves = relations.input_relations(fx.inputs(spark, sf))
    return leaves.select("write_id", "leaf_pos", "in_db", "in_table")


@query("""
SELECT query_root, count(*) AS n_writes,
       count(CASE WHEN query_root = 'Project' THEN 1 END) AS n_per_column,
       count(CASE WHEN query_root = 'HiveTableRelation' THEN 1 END) AS n_whole_copy
FROM harvestable GROUP BY query_root""")
def query_routes(spark, sf):
    root = F.col("query_root")
    return (
        _harvestable(spark, sf)
        .groupBy("query_root")
        .agg(
            F.count("*").alias("n_writes"),
            F.count(F.when(root == c.PROJECT_ROOT, 1)).alias("n_per_column"),
            F.count(F.when(root == c.HIVE_RELATION, 1)).alias("n_whole_copy"),
        )
    )


@query("""
SELECT p.write_id, p.out_pos, p.out_name FROM fx_projection p
LEFT JOIN direct_entry d ON d.write_id = p.write_id AND d.out_pos = p.out_pos
WHERE p.n_children = 0 AND d.write_id IS NULL""")
def unowned_entries(spark, sf):
    cap = fx.capture(spark, sf)
    skipped = cols.unowned_entries(cap.inputs, cap.relation_columns, cap.projections)
    return skipped.select("write_id", "out_pos", "out_name")


@query("""
SELECT write_id, min(exec_ts) AS exec_ts, min(out_table) AS out_table
FROM (SELECT l_orderkey AS write_id, o_orderdate AS exec_ts,
             concat('T_', CAST(o_custkey % 200 AS STRING)) AS out_table
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
GROUP BY write_id""")
def dedupe_commands(spark, sf):
    # Every line item stands for one more capture of its order's command.
    captures = fx.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("write_id"))
    again = captures.join(fx.writes(spark, sf), "write_id")
    return writes.dedupe_commands(again).select("write_id", "exec_ts", "out_table")


# --- names ----------------------------------------------------------------------------


@query("""
SELECT write_id, coalesce(out_db, current_db) AS output_db,
       concat(coalesce(out_db, current_db), '.', out_table, '@5k') AS output_table FROM fx_write""")
def output_names(spark, sf):
    named = writes.with_output_name(fx.writes(spark, sf))
    return named.select("write_id", "output_db", "output_table")


@query("""
SELECT write_id, leaf_pos, concat(coalesce(in_db, 'default'), '.', in_table, '@5k') AS input_table
FROM fx_input""")
def input_names(spark, sf):
    named = relations.with_input_name(fx.inputs(spark, sf))
    return named.select("write_id", "leaf_pos", "input_table")


@query("SELECT write_id, leaf_pos, expr_id, column_name FROM column_map")
def column_names(spark, sf):
    leaves = relations.input_relations(fx.inputs(spark, sf))
    named = relations.with_column_name(fx.relation_columns(spark, sf), leaves)
    return named.select("write_id", "leaf_pos", "expr_id", "column_name")


@query("""
SELECT p.write_id, p.out_pos,
       concat(coalesce(w.out_db, w.current_db), '.', w.out_table, '.', lower(p.out_name), '@5k') AS output_column
FROM fx_projection p JOIN fx_write w ON p.write_id = w.write_id""")
def output_column_names(spark, sf):
    w = writes.with_output_name(fx.writes(spark, sf)).select("write_id", "output_db", "out_table")
    p = fx.projections(spark, sf).select("write_id", "out_pos", "out_name")
    joined = spread_join(p, w, ["write_id"], position_block(F.col("out_pos")))
    name = names.output_column_name(
        F.col("output_db"), F.col("out_table"), F.col("out_name"), c.DEFAULT_NAMESPACE
    )
    return joined.select("write_id", "out_pos", name.alias("output_column"))


@query("""
SELECT write_id,
       CASE WHEN lower(sql_text) LIKE '%overwrite%' THEN 'INSERT_OVERWRITE' ELSE 'INSERT' END AS write_mode
FROM fx_write""")
def write_modes(spark, sf):
    return writes.with_write_mode(fx.writes(spark, sf)).select("write_id", "write_mode")


@query("""
SELECT write_id, out_pos, expr_text AS expression,
       regexp_replace(expr_text, '#[0-9]+L?', '', 'g') AS stable_expression
FROM fx_projection""")
def expression_texts(spark, sf):
    p = fx.projections(spark, sf)
    stable = cols.expression_text(p, strip_ids=True).withColumnRenamed(
        "expression", "stable_expression"
    )
    return cols.expression_text(stable).select(
        "write_id", "out_pos", "expression", "stable_expression"
    )


@query("""
SELECT l_orderkey AS write_id, l_linenumber AS out_pos,
       concat('q#', CAST(l_partkey AS STRING), 'L,', l_returnflag, ',(s#', CAST(l_suppkey AS STRING), ' + 1)')
         AS expression
FROM lineitem""")
def printed_children(spark, sf):
    children = F.array(
        F.concat(F.lit("q#"), "l_partkey", F.lit("L")),
        F.col("l_returnflag"),
        F.concat(F.lit("(s#"), "l_suppkey", F.lit(" + 1)")),
    )
    p = fx.table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("write_id"),
        F.col("l_linenumber").alias("out_pos"),
        children.alias("children"),
    )
    return cols.expression_text(p).select("write_id", "out_pos", "expression")


@query("""
SELECT dependency_type, out_name, count(*) AS n_columns, count(expression) AS n_expressions
FROM (SELECT * FROM direct_column UNION ALL SELECT * FROM computed_column)
GROUP BY dependency_type, out_name""")
def dependency_types(spark, sf):
    cap = fx.capture(spark, sf)
    written = cap.writes.select("write_id")
    lists = written.join(unbroadcast(table_lineage.relation_lists(cap.inputs)), "write_id", "left")
    entries = cols.projected_columns(
        lists, cap.relation_columns, cap.projections, cap.projection_leaves
    )
    return entries.groupBy("dependency_type", "out_name").agg(
        F.count("*").alias("n_columns"), F.count("expression").alias("n_expressions")
    )


@query("""
SELECT c_custkey, c_name, coalesce(o_totalprice, 0) AS o_totalprice, coalesce(o_orderkey, 0) AS o_orderkey,
       o_orderpriority
FROM fx_nullable""")
def numeric_null_fill(spark, sf):
    return statements.fill_numeric_nulls(fx.nullable_orders(spark, sf))


@query("SELECT write_id, coalesce(nullif(run_user, ''), 'spark') AS acting_user FROM fx_write")
def acting_users(spark, sf):
    w = writes.with_user(fx.writes(spark, sf), "spark")
    return w.select("write_id", F.col("user").alias("acting_user"))


# --- joins ----------------------------------------------------------------------------


@query("""
SELECT e.event_id, e.thread_id, e.ts, e.status, p.sql_text
FROM fx_exec e ASOF LEFT JOIN fx_parse p ON e.thread_id = p.thread_id AND e.ts >= p.ts""")
def statement_context(spark, sf):
    return statements.statement_context(fx.parses(spark, sf), fx.executions(spark, sf))


@query("SELECT write_id, out_pos, expr_id, column_name FROM direct_match")
def direct_matches(spark, sf):
    cap = fx.capture(spark, sf)
    own = cols.own_references(cap.projections)
    matched = cols.matched_references(own, cap.inputs, cap.relation_columns)
    return matched.select("write_id", "out_pos", "expr_id", "column_name")


@query("SELECT write_id, out_pos, leaf_ord, expr_id, column_name FROM leaf_match")
def leaf_matches(spark, sf):
    cap = fx.capture(spark, sf)
    leaves = cols.leaf_references(cap.projection_leaves)
    return cols.matched_references(leaves, cap.inputs, cap.relation_columns)


@query("""
SELECT i.write_id, i.leaf_pos, i.in_table, w.out_table, w.command_class
FROM named_input i JOIN harvestable w ON i.write_id = w.write_id""")
def write_inputs(spark, sf):
    joined = table_lineage.write_inputs(_harvestable(spark, sf), fx.inputs(spark, sf))
    return joined.select("write_id", "leaf_pos", "in_table", "out_table", "command_class")


# --- lineage --------------------------------------------------------------------------


@query("""
SELECT i.write_id, i.leaf_pos, i.input_table, w.output_table
FROM named_input i JOIN named_write w ON i.write_id = w.write_id""")
def table_edges(spark, sf):
    return table_lineage.table_edges(_harvestable(spark, sf), fx.inputs(spark, sf))


@query("SELECT write_id, output_table, qualified_name AS process_name FROM lineage_table")
def process_names(spark, sf):
    return table_lineage.process_names(_harvestable(spark, sf), fx.inputs(spark, sf))


@query("""
SELECT write_id, input_tables, output_table, qualified_name, output_table AS name, 'Spark' AS user_name,
       exec_ts AS start_time, exec_ts AS end_time, operation_type, lower(sql_text) AS query_id,
       lower(sql_text) AS query_text, lower(sql_text) AS recent_queries, 'Not Supported' AS query_plan,
       '5k' AS cluster_name
FROM lineage_table""")
def table_lineage_records(spark, sf):
    tl = table_lineage.table_lineage(_harvestable(spark, sf), fx.inputs(spark, sf))
    return _text(_text(tl, "input_tables"), "recent_queries")


@query("""
SELECT write_id, 'no_inputs' AS reason FROM harvestable
WHERE write_id NOT IN (SELECT write_id FROM named_input)""")
def rejected_writes(spark, sf):
    return table_lineage.rejected_writes(_harvestable(spark, sf), fx.inputs(spark, sf))


@query("""
SELECT d.* FROM direct_column d JOIN harvestable w ON d.write_id = w.write_id""")
def direct_columns(spark, sf):
    cap = fx.capture(spark, sf)
    w = _harvestable(spark, sf)
    return _text(cols.direct_columns(w, cap.inputs, cap.relation_columns, cap.projections))


@query("""
SELECT d.* FROM computed_column d JOIN harvestable w ON d.write_id = w.write_id""")
def computed_columns(spark, sf):
    cap = fx.capture(spark, sf)
    return _text(
        cols.computed_columns(
            _harvestable(spark, sf),
            cap.inputs,
            cap.relation_columns,
            cap.projections,
            cap.projection_leaves,
        )
    )


@query("""
SELECT d.* FROM copied_column d JOIN harvestable w ON d.write_id = w.write_id""")
def copied_columns(spark, sf):
    w = _harvestable(spark, sf).select("write_id", "query_root")
    lists = w.join(unbroadcast(table_lineage.relation_lists(fx.inputs(spark, sf))), "write_id")
    return _text(cols.copied_columns(lists, fx.relation_columns(spark, sf)))


LINEAGE_SQL = """
SELECT write_id, out_pos, output_column, input_columns, dependency_type, expression, qualified_name
FROM lineage_column"""


def _lineage(spark, sf, **options):
    cl = harvest(fx.capture(spark, sf), **options).column_lineage
    return _text(cl).select(
        "write_id",
        "out_pos",
        "output_column",
        "input_columns",
        "dependency_type",
        "expression",
        "qualified_name",
    )


@query(LINEAGE_SQL)
def column_lineage(spark, sf):
    return _lineage(spark, sf)


@query("""
SELECT write_id, out_pos, output_column, CAST(pos - 1 AS INTEGER) AS input_pos,
       list_extract(parts, pos) AS input_column
FROM (SELECT *, string_split(input_columns, ',') AS parts,
             unnest(range(1, len(string_split(input_columns, ',')) + 1)) AS pos
      FROM lineage_column WHERE input_columns <> '')
UNION ALL
SELECT write_id, out_pos, output_column, NULL, NULL FROM lineage_column WHERE input_columns = ''""")
def column_edges(spark, sf):
    return harvest(fx.capture(spark, sf)).column_edges


def _by_class(name, command):
    @query(LINEAGE_SQL + f" WHERE command_class = '{command}'")
    def one_class(spark, sf):
        return _lineage(spark, sf, classes=(command,))

    QUERIES[name] = QUERIES.pop("one_class")
    ORACLE[name] = ORACLE.pop("one_class")


_by_class("harvest_hive_ctas", c.HIVE_CTAS)
_by_class("harvest_hive_insert", c.HIVE_INSERT)
_by_class("harvest_datasource_ctas", c.DATASOURCE_CTAS)


@query("""
SELECT write_id, out_pos, lower(output_column) AS output_column, input_columns, dependency_type,
       regexp_replace(expression, '#[0-9]+L?', '', 'g') AS expression
FROM lineage_column""")
def normalized_lineage(spark, sf):
    # Both ends of every edge in lower case, expressions without plan ids.
    return _lineage(spark, sf, normalize_case=True, strip_ids=True).drop("qualified_name")


# --- from what a session's hooks see ----------------------------------------------------


@query(on_raw_writes(LINEAGE_SQL))
def raw_capture_lineage(spark, sf):
    found = harvest(paired(fx.raw_capture(spark, sf))).column_lineage
    return _text(found).select(
        "write_id",
        "out_pos",
        "output_column",
        "input_columns",
        "dependency_type",
        "expression",
        "qualified_name",
    )


@query(on_raw_writes("SELECT write_id, thread_id, status, command_class, sql_text, run_user FROM fx_write"))
def paired_writes(spark, sf):
    found = paired(fx.raw_capture(spark, sf)).writes
    return found.select("write_id", "thread_id", "status", "command_class", "sql_text", "run_user")
