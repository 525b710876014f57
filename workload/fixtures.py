"""Capture tables derived from the test tables: for Spark, and as SQL for the oracle."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor.operators.spread import unbroadcast
from spoor.sources.capture import Capture
from spoor.sources.raw_capture import RawCapture


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _by_number(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of a key together, in as many partitions as the session has.

    Before an aggregation that hardly combines: its map side would hold all groups of a
    file's split, and given by number the partitions are not put together by their
    compressed size, which says little of the rows that are sorted in them.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def _statement_text() -> F.Column:
    head = F.when(F.col("event_type") == "view", "INSERT INTO t /* ").otherwise(
        "INSERT OVERWRITE t /* "
    )
    return F.concat(head, "props", F.lit(" */"))


PARSE_EVENTS = ("view", "click")


def parses(spark, sf_dir):
    events = table(spark, sf_dir, "events").filter(F.col("event_type").isin(*PARSE_EVENTS))
    return events.select(
        "event_id", F.col("user_id").alias("thread_id"), "ts", _statement_text().alias("sql_text")
    )


def executions(spark, sf_dir):
    events = table(spark, sf_dir, "events").filter(~F.col("event_type").isin(*PARSE_EVENTS))
    status = F.when(F.col("event_type") == "error", "failure").otherwise("success")
    return events.select(
        "event_id", F.col("user_id").alias("thread_id"), "ts", status.alias("status")
    )


def writes(spark, sf_dir):
    # A plan whose root is a relation has one leaf.
    lines = _by_number(table(spark, sf_dir, "lineitem"), "l_orderkey")
    lines = lines.groupBy(F.col("l_orderkey").alias("o_orderkey"))
    leaves = lines.agg((F.max("l_linenumber") == F.min("l_linenumber")).alias("one_leaf"))
    return table(spark, sf_dir, "orders").join(unbroadcast(leaves), "o_orderkey", "left").selectExpr(
        "o_orderkey AS write_id",
        "o_custkey % 16 AS thread_id",
        "o_orderdate AS exec_ts",
        "if(o_orderstatus = 'P', 'failure', 'success') AS status",
        """CASE o_orderpriority
             WHEN '1-URGENT' THEN 'CreateHiveTableAsSelectCommand'
             WHEN '3-MEDIUM' THEN 'CreateDataSourceTableAsSelectCommand'
             WHEN '4-NOT SPECIFIED' THEN 'InsertIntoHadoopFsRelationCommand'
             ELSE 'InsertIntoHiveTable' END AS command_class""",
        "if(o_custkey % 3 = 0, NULL, 'Mart') AS out_db",
        "'work' AS current_db",
        "concat('T_', o_custkey % 200) AS out_table",
        """CASE WHEN one_leaf THEN 'HiveTableRelation' WHEN o_orderkey % 4 = 1 THEN 'Aggregate'
             ELSE 'Project' END AS query_root""",
        """CASE o_orderkey % 5
             WHEN 0 THEN 'INSERT OVERWRITE TABLE x SELECT * FROM y'
             WHEN 1 THEN 'CREATE TABLE Overwrite_log AS SELECT * FROM y'
             ELSE 'INSERT INTO x SELECT * FROM y' END AS sql_text""",
        """CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN ''
             ELSE concat('u', o_custkey % 4) END AS run_user""",
    )


def inputs(spark, sf_dir):
    def lowest_is(name: str, value: str):
        # ``min(name) = value`` over flags, so that rows are hashed instead of sorted.
        return ~F.bool_or(F.col(name) < value) & F.bool_or(F.col(name) == value)

    return (
        _by_number(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")
        .groupBy(F.col("l_orderkey").alias("write_id"), F.col("l_linenumber").alias("leaf_pos"))
        .agg(
            lowest_is("l_returnflag", "R").alias("is_logical"),
            lowest_is("l_linestatus", "F").alias("no_db"),
            F.min("l_suppkey").alias("supplier"),
        )
        .selectExpr(
            "write_id",
            "leaf_pos",
            "if(is_logical, 'LogicalRelation', 'HiveTableRelation') AS relation_class",
            "if(no_db, NULL, 'Raw') AS in_db",
            "concat('S_', supplier % 20) AS in_table",
        )
    )


def relations(spark, sf_dir):
    """Every leaf with its data and partition columns as arrays."""

    def column(position: int, name: str):
        expr_id = (F.col("leaf_pos") * 10 + position).cast("long")
        return F.struct(expr_id.alias("expr_id"), F.lit(name).alias("col_name"))

    return inputs(spark, sf_dir).select(
        "write_id",
        "leaf_pos",
        F.array(column(0, "Id"), column(1, "Amount"), column(2, "Name")).alias("data_cols"),
        F.array(column(3, "dt")).alias("partition_cols"),
    )


def _rows(schema: dict, rows: list[tuple]) -> str:
    """SQL that repeats an input row once per given tuple of SQL values."""
    structs = [
        "named_struct("
        + ", ".join(
            f"'{name}', CAST({value} AS {kind})" for value, (name, kind) in zip(row, schema.items())
        )
        + ")"
        for row in rows
    ]
    return f"inline(array({', '.join(structs)}))"


COLUMN_ROWS = _rows(
    {"expr_id": "BIGINT", "col_name": "STRING", "is_partition": "BOOLEAN"},
    [
        ("leaf_pos * 10", "'Id'", "false"),
        ("leaf_pos * 10 + 1", "'Amount'", "false"),
        ("leaf_pos * 10 + 2", "'Name'", "false"),
        ("leaf_pos * 10 + 3", "'dt'", "true"),
    ],
)
ENTRY_ROWS = _rows(
    {
        "out_pos": "INT",
        "out_name": "STRING",
        "expr_id": "BIGINT",
        "n_children": "INT",
        "expr_text": "STRING",
    },
    [
        (0, "'Id'", 10, 0, "NULL"),
        (1, "'Renamed'", 1001, 1, "'Amount#11'"),
        (2, "'Total'", 1002, 1, "'(Amount#11 + Amount#21)'"),
        (3, "'label'", 1003, 1, "'upper(Name#12)'"),
        (4, "'ghost'", 9999, 0, "NULL"),
        (5, "'rnd'", 1005, 1, "'rand(7)'"),
        (6, "'dt'", 13, 0, "NULL"),
        (7, "'twice'", 1007, 1, "'(Amount#11 + Amount#11)'"),
        (8, "'plus1'", 1008, 1, "'(Amount#11 + 1)'"),
    ],
)
LEAF_ROWS = _rows(
    {"out_pos": "INT", "leaf_ord": "INT", "leaf_class": "STRING", "leaf_expr_id": "BIGINT"},
    [
        (0, 0, "'AttributeReference'", 10),
        (1, 0, "'AttributeReference'", 11),
        (2, 0, "'AttributeReference'", 11),
        (2, 1, "'AttributeReference'", 21),
        (3, 0, "'AttributeReference'", 12),
        (4, 0, "'AttributeReference'", 9999),
        (5, 0, "'Literal'", "NULL"),
        (6, 0, "'AttributeReference'", 13),
        (7, 0, "'AttributeReference'", 11),
        (7, 1, "'AttributeReference'", 11),
        (8, 0, "'AttributeReference'", 11),
        (8, 1, "'Literal'", "NULL"),
    ],
)


def relation_columns(spark, sf_dir):
    return inputs(spark, sf_dir).selectExpr("write_id", "leaf_pos", COLUMN_ROWS)


def projections(spark, sf_dir):
    return writes(spark, sf_dir).filter("query_root = 'Project'").selectExpr("write_id", ENTRY_ROWS)


def capture(spark: SparkSession, sf_dir: str) -> Capture:
    w, i = writes(spark, sf_dir), inputs(spark, sf_dir)
    projects = w.filter("query_root = 'Project'")
    return Capture(
        w,
        i,
        i.selectExpr("write_id", "leaf_pos", COLUMN_ROWS),
        projects.selectExpr("write_id", ENTRY_ROWS),
        projects.selectExpr("write_id", LEAF_ROWS),
    )


def plan_nodes(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    roots = (
        orders.select("o_custkey")
        .distinct()
        .selectExpr(
            "o_custkey AS query_id",
            "-1L AS node_id",
            "CAST(NULL AS BIGINT) AS parent_id",
            "if(o_custkey % 2 = 0, 'UnionExec', 'ProjectExec') AS node_class",
            "CAST(NULL AS BIGINT) AS write_id",
        )
    )
    children = orders.selectExpr(
        "o_custkey AS query_id",
        "o_orderkey AS node_id",
        "-1L AS parent_id",
        """CASE o_orderkey % 7 WHEN 0 THEN 'LeafExecNode' WHEN 1 THEN 'WriteToDataSourceV2Exec'
             WHEN 2 THEN 'FilterExec' ELSE 'DataWritingCommandExec' END AS node_class""",
        "if(o_orderkey % 7 > 2, o_orderkey, NULL) AS write_id",
    )
    return roots.unionByName(children)


def payloads(spark, sf_dir):
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS msg_seq",
        "if(doc_id % 10 = 0, NULL, concat('mart.t_', doc_id % 50, '@5k')) AS msg_key",
        "text AS payload",
    )


RAW_TEXT = """CASE o_orderkey % 5
             WHEN 0 THEN 'INSERT OVERWRITE TABLE x SELECT * FROM y'
             WHEN 1 THEN 'CREATE TABLE Overwrite_log AS SELECT * FROM y'
             ELSE 'INSERT INTO x SELECT * FROM y' END"""


def raw_capture(spark: SparkSession, sf_dir: str) -> RawCapture:
    """A plan for each customer with orders, run at the last of them; texts parsed before."""
    orders, whole = table(spark, sf_dir, "orders"), capture(spark, sf_dir)
    parses = orders.filter("o_orderkey % 3 = 0").selectExpr(
        "o_orderkey AS event_id", "o_custkey % 16 AS thread_id", "o_orderdate AS ts", RAW_TEXT + " AS sql_text"
    )
    runs = orders.groupBy("o_custkey").agg(F.max("o_orderdate").alias("ts")).selectExpr(
        "o_custkey AS query_id",
        "o_custkey % 16 AS thread_id",
        "ts",
        "if(o_custkey % 9 = 0, 'failure', 'success') AS status",
    )
    return RawCapture(
        parses,
        runs,
        plan_nodes(spark, sf_dir),
        whole.writes.drop("thread_id", "exec_ts", "status", "sql_text"),
        whole.inputs,
        whole.relation_columns,
        whole.projections,
        whole.projection_leaves,
    )


VERSION_TEXT = """CASE o_orderkey % 9
    WHEN 0 THEN CAST(o_custkey % 4 AS STRING)
    WHEN 1 THEN concat(CAST(o_custkey % 3 AS STRING), '.0')
    WHEN 2 THEN concat(CAST(o_custkey % 3 AS STRING), '.x')
    WHEN 3 THEN concat(CAST(o_custkey % 2 AS STRING), '.', CAST(o_custkey % 12 AS STRING))
    WHEN 4 THEN concat(CAST(o_custkey % 3 AS STRING), '.0.0')
    WHEN 5 THEN concat('0.', CAST(o_custkey % 11 AS STRING), '.9')
    WHEN 6 THEN concat('1.0.', CAST(o_custkey % 2 AS STRING))
    WHEN 7 THEN concat('1..', CAST(o_custkey % 2 AS STRING))
    ELSE concat(CAST(o_custkey % 3 AS STRING), '.', CAST(o_orderkey % 7 AS STRING), '.')
  END"""


def message_versions(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS msg_seq", VERSION_TEXT + " AS version"
    )


def separated_lists(spark, sf_dir):
    return table(spark, sf_dir, "conversations").selectExpr(
        "conv_id", "turn", "concat(' ', role, ' ,, ', text, ',  ') AS csv"
    )


def nullable_orders(spark, sf_dir):
    big = table(spark, sf_dir, "orders").filter("o_totalprice > 400000")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return customers.join(big, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        "c_custkey", "c_name", "o_totalprice", "o_orderkey", "o_orderpriority"
    )


# --- the same rows for the oracle ---------------------------------------------------

SQL = {
    "fx_parse": """
SELECT event_id, user_id AS thread_id, ts,
       concat(CASE WHEN event_type = 'view' THEN 'INSERT INTO t /* ' ELSE 'INSERT OVERWRITE t /* ' END, props, ' */') AS sql_text
FROM events WHERE event_type IN ('view', 'click')""",
    "fx_exec": """
SELECT event_id, user_id AS thread_id, ts,
       CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status
FROM events WHERE event_type NOT IN ('view', 'click')""",
    "fx_write": """
SELECT o_orderkey AS write_id,
       o_custkey % 16 AS thread_id,
       o_orderdate AS exec_ts,
       CASE WHEN o_orderstatus = 'P' THEN 'failure' ELSE 'success' END AS status,
       CASE o_orderpriority
         WHEN '1-URGENT' THEN 'CreateHiveTableAsSelectCommand'
         WHEN '3-MEDIUM' THEN 'CreateDataSourceTableAsSelectCommand'
         WHEN '4-NOT SPECIFIED' THEN 'InsertIntoHadoopFsRelationCommand'
         ELSE 'InsertIntoHiveTable' END AS command_class,
       CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE 'Mart' END AS out_db,
       'work' AS current_db,
       concat('T_', CAST(o_custkey % 200 AS STRING)) AS out_table,
       CASE WHEN one_leaf THEN 'HiveTableRelation' WHEN o_orderkey % 4 = 1 THEN 'Aggregate' ELSE 'Project' END AS query_root,
       CASE o_orderkey % 5
         WHEN 0 THEN 'INSERT OVERWRITE TABLE x SELECT * FROM y'
         WHEN 1 THEN 'CREATE TABLE Overwrite_log AS SELECT * FROM y'
         ELSE 'INSERT INTO x SELECT * FROM y' END AS sql_text,
       CASE o_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE concat('u', CAST(o_custkey % 4 AS STRING)) END AS run_user
FROM orders LEFT JOIN (
  SELECT l_orderkey, max(l_linenumber) = min(l_linenumber) AS one_leaf FROM lineitem GROUP BY l_orderkey
) ON l_orderkey = o_orderkey""",
    "fx_input": """
SELECT l_orderkey AS write_id, l_linenumber AS leaf_pos,
       CASE WHEN min(l_returnflag) = 'R' THEN 'LogicalRelation' ELSE 'HiveTableRelation' END AS relation_class,
       CASE WHEN min(l_linestatus) = 'F' THEN NULL ELSE 'Raw' END AS in_db,
       concat('S_', CAST(min(l_suppkey) % 20 AS STRING)) AS in_table
FROM lineitem
GROUP BY l_orderkey, l_linenumber""",
    "fx_relation_column": """
SELECT i.write_id, i.leaf_pos, CAST(i.leaf_pos * 10 + c.col_pos AS BIGINT) AS expr_id, c.col_name, c.is_partition
FROM fx_input i
CROSS JOIN (VALUES (0, 'Id', false), (1, 'Amount', false), (2, 'Name', false), (3, 'dt', true)) AS c(col_pos, col_name, is_partition)""",
    "fx_projection": """
SELECT w.write_id, p.out_pos, p.out_name, CAST(p.expr_id AS BIGINT) AS expr_id, p.n_children, p.expr_text
FROM fx_write w
CROSS JOIN (VALUES (0, 'Id', 10, 0, NULL), (1, 'Renamed', 1001, 1, 'Amount#11'),
  (2, 'Total', 1002, 1, '(Amount#11 + Amount#21)'), (3, 'label', 1003, 1, 'upper(Name#12)'),
  (4, 'ghost', 9999, 0, NULL), (5, 'rnd', 1005, 1, 'rand(7)'), (6, 'dt', 13, 0, NULL),
  (7, 'twice', 1007, 1, '(Amount#11 + Amount#11)'), (8, 'plus1', 1008, 1, '(Amount#11 + 1)')
) AS p(out_pos, out_name, expr_id, n_children, expr_text)
WHERE w.query_root = 'Project'""",
    "fx_projection_leaf": """
SELECT w.write_id, l.out_pos, l.leaf_ord, l.leaf_class, CAST(l.leaf_expr_id AS BIGINT) AS leaf_expr_id
FROM fx_write w
CROSS JOIN (VALUES (0, 0, 'AttributeReference', 10), (1, 0, 'AttributeReference', 11),
  (2, 0, 'AttributeReference', 11), (2, 1, 'AttributeReference', 21), (3, 0, 'AttributeReference', 12),
  (4, 0, 'AttributeReference', 9999), (5, 0, 'Literal', NULL), (6, 0, 'AttributeReference', 13),
  (7, 0, 'AttributeReference', 11), (7, 1, 'AttributeReference', 11),
  (8, 0, 'AttributeReference', 11), (8, 1, 'Literal', NULL)
) AS l(out_pos, leaf_ord, leaf_class, leaf_expr_id)
WHERE w.query_root = 'Project'""",
    "fx_plan_node": """
SELECT DISTINCT o_custkey AS query_id, CAST(-1 AS BIGINT) AS node_id, CAST(NULL AS BIGINT) AS parent_id,
       CASE WHEN o_custkey % 2 = 0 THEN 'UnionExec' ELSE 'ProjectExec' END AS node_class, CAST(NULL AS BIGINT) AS write_id
FROM orders
UNION ALL
SELECT o_custkey, o_orderkey, CAST(-1 AS BIGINT),
       CASE o_orderkey % 7 WHEN 0 THEN 'LeafExecNode' WHEN 1 THEN 'WriteToDataSourceV2Exec' WHEN 2 THEN 'FilterExec' ELSE 'DataWritingCommandExec' END,
       CASE WHEN o_orderkey % 7 > 2 THEN o_orderkey ELSE NULL END
FROM orders""",
    "fx_raw_text": f"""
SELECT query_id, thread_id, ts, status, sql_text FROM (
  SELECT query_id, thread_id, ts, status, kind, last_value(sql_text IGNORE NULLS) OVER (
    PARTITION BY thread_id ORDER BY ts, kind, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS sql_text
  FROM (
    SELECT NULL AS query_id, o_orderkey AS event_id, o_custkey % 16 AS thread_id, o_orderdate AS ts, NULL AS status,
           {RAW_TEXT} AS sql_text, 0 AS kind FROM orders WHERE o_orderkey % 3 = 0
    UNION ALL
    SELECT o_custkey, o_custkey, o_custkey % 16, max(o_orderdate),
           CASE WHEN o_custkey % 9 = 0 THEN 'failure' ELSE 'success' END, NULL, 1 FROM orders GROUP BY o_custkey
  )
) WHERE kind = 1""",
    "fx_payload": """
SELECT doc_id AS msg_seq,
       CASE WHEN doc_id % 10 = 0 THEN NULL ELSE concat('mart.t_', CAST(doc_id % 50 AS STRING), '@5k') END AS msg_key,
       text AS payload
FROM documents""",
    "fx_version": f"SELECT o_orderkey AS msg_seq, {VERSION_TEXT} AS version FROM orders",
    "fx_strings": """
SELECT conv_id, turn, concat(' ', role, ' ,, ', text, ',  ') AS csv FROM conversations""",
    "fx_nullable": """
SELECT c_custkey, c_name, o_totalprice, o_orderkey, o_orderpriority
FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_totalprice > 400000""",
}
