"""Building oracle SQL from named parts."""

import re

from workload.fixtures import SQL

PARTS = {
    **SQL,
    "harvestable": """
SELECT * FROM fx_write
WHERE status = 'success' AND command_class IN
  ('CreateHiveTableAsSelectCommand', 'InsertIntoHiveTable', 'CreateDataSourceTableAsSelectCommand')""",
    "named_write": """
SELECT *, coalesce(out_db, current_db) AS output_db,
       concat(coalesce(out_db, current_db), '.', out_table, '@5k') AS output_table,
       CASE WHEN lower(sql_text) LIKE '%overwrite%' THEN 'INSERT_OVERWRITE' ELSE 'INSERT' END AS write_mode,
       CASE WHEN command_class = 'InsertIntoHiveTable' THEN 'INSERT_INTO_HIVE_TABLE'
            ELSE 'CREATETABLE_AS_SELECT' END AS operation_type
FROM harvestable""",
    "named_input": """
SELECT *, concat(coalesce(in_db, 'default'), '.', in_table, '@5k') AS input_table
FROM fx_input WHERE relation_class = 'HiveTableRelation'""",
    "input_list": """
SELECT write_id, string_agg(input_table, ':' ORDER BY in_table, leaf_pos) AS sorted_inputs,
       string_agg(input_table, ',' ORDER BY leaf_pos) AS input_tables, count(*) AS n_inputs
FROM named_input GROUP BY write_id""",
    "column_map": """
SELECT rc.write_id, rc.leaf_pos, rc.expr_id, rc.col_name,
       lower(concat(coalesce(i.in_db, 'default'), '.', i.in_table, '.', rc.col_name, '@5k')) AS column_name
FROM fx_relation_column rc JOIN named_input i ON rc.write_id = i.write_id AND rc.leaf_pos = i.leaf_pos""",
    "direct_match": """
SELECT p.write_id, p.out_pos, p.out_name, m.expr_id, m.column_name
FROM fx_projection p JOIN column_map m ON p.write_id = m.write_id AND p.expr_id = m.expr_id""",
    "leaf_match": """
SELECT l.write_id, l.out_pos, l.leaf_ord, l.leaf_expr_id AS expr_id, m.column_name
FROM fx_projection_leaf l JOIN column_map m ON l.write_id = m.write_id AND l.leaf_expr_id = m.expr_id""",
    "leaf_list": """
SELECT write_id, out_pos, string_agg(column_name, ',' ORDER BY leaf_ord) AS inputs, count(*) AS n
FROM leaf_match GROUP BY write_id, out_pos""",
    "direct_column": """
SELECT write_id, CAST(out_pos AS BIGINT) AS out_pos, out_name, column_name AS input_columns,
       'SIMPLE' AS dependency_type, CAST(NULL AS STRING) AS expression
FROM direct_match""",
    "computed_column": """
SELECT p.write_id, CAST(p.out_pos AS BIGINT) AS out_pos, p.out_name,
       coalesce(l.inputs, '') AS input_columns,
       CASE WHEN l.n = 1 AND NOT (p.expr_text LIKE '%(%' AND p.expr_text LIKE '%)%')
            THEN 'SIMPLE' ELSE 'EXPRESSION' END AS dependency_type,
       CASE WHEN l.n = 1 AND NOT (p.expr_text LIKE '%(%' AND p.expr_text LIKE '%)%')
            THEN NULL ELSE p.expr_text END AS expression
FROM fx_projection p
LEFT JOIN leaf_list l ON p.write_id = l.write_id AND p.out_pos = l.out_pos
LEFT JOIN direct_entry d ON d.write_id = p.write_id AND d.out_pos = p.out_pos
WHERE p.n_children > 0 AND d.write_id IS NULL""",
    "direct_entry": "SELECT DISTINCT write_id, out_pos FROM direct_match",
    "copied_column": """
SELECT m.write_id, min(m.expr_id) AS out_pos, m.col_name AS out_name, m.column_name AS input_columns,
       'SIMPLE' AS dependency_type, CAST(NULL AS STRING) AS expression
FROM column_map m JOIN fx_write w ON m.write_id = w.write_id AND w.query_root = 'HiveTableRelation'
GROUP BY m.write_id, m.leaf_pos, m.col_name, m.column_name""",
    "lineage_column": """
SELECT c.write_id, c.out_pos,
       concat(w.output_db, '.', w.out_table, '.', lower(c.out_name), '@5k') AS output_column,
       c.input_columns, c.dependency_type, c.expression,
       concat(w.output_table, ':', lower(c.out_name)) AS name,
       concat('QUERY:', i.sorted_inputs, '->:', w.write_mode, ':', w.output_table, ':', lower(c.out_name))
         AS qualified_name,
       concat('QUERY:', i.sorted_inputs, '->:', w.write_mode, ':', w.output_table) AS process_name,
       w.exec_ts, w.command_class
FROM (SELECT * FROM direct_column UNION ALL SELECT * FROM computed_column
      UNION ALL SELECT * FROM copied_column) c
JOIN named_write w ON c.write_id = w.write_id
JOIN input_list i ON c.write_id = i.write_id""",
    "lineage_table": """
SELECT w.*, i.sorted_inputs, i.input_tables, i.n_inputs,
       concat('QUERY:', i.sorted_inputs, '->:', w.write_mode, ':', w.output_table) AS qualified_name
FROM named_write w JOIN input_list i ON w.write_id = i.write_id""",
    "candidate": """
SELECT query_id, node_id, parent_id, node_class, write_id FROM fx_plan_node
WHERE node_class IN ('DataWritingCommandExec', 'WriteToDataSourceV2Exec', 'LeafExecNode')
UNION ALL
SELECT c.query_id, c.node_id, c.parent_id, c.node_class, c.write_id
FROM fx_plan_node c JOIN fx_plan_node u
  ON c.query_id = u.query_id AND c.parent_id = u.node_id AND u.node_class = 'UnionExec'""",
}


RAW_WRITES = """
SELECT w.write_id, e.thread_id, e.ts AS exec_ts, e.status, w.command_class, w.out_db, w.current_db,
       w.out_table, w.query_root, e.sql_text, w.run_user
FROM fx_write w
JOIN (SELECT DISTINCT query_id, write_id FROM candidate WHERE node_class = 'DataWritingCommandExec') n
  ON n.write_id = w.write_id
JOIN fx_raw_text e ON e.query_id = n.query_id"""


def _reads(name: str, wanted: str) -> bool:
    return any(
        other == wanted or _reads(other, wanted)
        for other in PARTS
        if other != name and re.search(rf"\b{other}\b", PARTS[name])
    )


def on_raw_writes(body: str) -> str:
    """``body`` and its parts, read from RAW_WRITES in place of the captured writes."""
    moved = ["fx_write", *(name for name in list(PARTS) if _reads(name, "fx_write"))]

    def renamed(text: str) -> str:
        return re.sub(rf"\b({'|'.join(moved)})\b", r"raw_\1", text)

    for name in moved:
        PARTS[f"raw_{name}"] = RAW_WRITES if name == "fx_write" else renamed(PARTS[name])
    return renamed(body)


# Parts that many others read: worked out once.
SHARED = {
    "fx_raw_text",
    "raw_fx_write",
    "raw_lineage_column",
    "fx_write",
    "fx_input",
    "fx_projection",
    "fx_relation_column",
    "column_map",
    "direct_match",
    "direct_entry",
    "leaf_list",
    "lineage_column",
}


def _needed(text: str, found: list) -> None:
    for name, part in PARTS.items():
        if name not in found and re.search(rf"\b{name}\b", text):
            _needed(part, found)
            if name not in found:
                found.append(name)


def statement(body: str) -> str:
    """``body`` with the parts it names, each before its first use."""
    found: list = []
    _needed(body, found)
    parts = ",\n".join(
        f"{name} AS {'MATERIALIZED ' if name in SHARED else ''}({PARTS[name]})" for name in found
    )
    return f"WITH {parts}\n{body}" if found else body
