"""Capture tables from Spark's own event logs.

A session is captured by turning its event log on, with plans written in full:

    spark.eventLog.enabled=true
    spark.sql.ui.explainMode=extended
    spark.sql.debug.maxToStringFields=100000

The log then holds the plan of every write, and ``records_from_log`` reads from its
printed lines what the write read and which columns it selected.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spoor import constants as c
from spoor.operators.spread import unbroadcast
from spoor.sources import printed_plan

# Event names and section heads of Spark's log.
EVENTS = "org.apache.spark.sql.execution.ui.SparkListenerSQLExecution"
START, END = EVENTS + "Start", EVENTS + "End"
OPTIMIZED = "== Optimized Logical Plan ==\n"
PHYSICAL = "\n\n== Physical Plan =="

EVENT_SCHEMA = (
    "Event string, executionId bigint, rootExecutionId bigint, time bigint, "
    "description string, physicalPlanDescription string, errorMessage string"
)
# Classes of other commands that write, which nothing is derived for.
HADOOP_INSERT = "InsertIntoHadoopFsRelationCommand"
OTHER_WRITES = (
    HADOOP_INSERT,
    "InsertIntoDataSourceCommand",
    "InsertIntoDataSourceDirCommand",
    "InsertIntoHiveDirCommand",
    "SaveIntoDataSourceCommand",
    "AppendData",
    "OverwriteByExpression",
    "OverwritePartitionsDynamic",
    "CreateTableAsSelect",
    "ReplaceTableAsSelect",
)
SUPPORTED = tuple(c.OPERATION_TYPES)
WRITE_COMMANDS = (*SUPPORTED, *OTHER_WRITES)
CREATING = (c.HIVE_CTAS, c.DATASOURCE_CTAS)
INSERTING = (c.HIVE_INSERT, HADOOP_INSERT)
LOGICAL_RELATION = "LogicalRelation"
# How a whole-table read is printed, and the relation class it stands for.
PRINTED_RELATIONS = {"Relation": LOGICAL_RELATION, c.HIVE_RELATION: c.HIVE_RELATION}
# What the log can hold: relations of file-based tables as well as Hive's own.
LOG_RELATIONS = (c.HIVE_RELATION, LOGICAL_RELATION)


def event_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the logs below ``path``, plain or ``.zstd``, as ``file_path, value``."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file_path"), "value")


def executions(lines: DataFrame, only_writes: bool = True, commands=SUPPORTED) -> DataFrame:
    """One row per SQL execution, its outcome, description and printed plan.

    With ``only_writes`` the executions that name none of ``commands`` are dropped before
    the shuffle; WRITE_COMMANDS keeps writes without support too, so that they are reported.
    """
    app = F.regexp_extract("file_path", r"((?:application_|app-|local-)\d[0-9A-Za-z_-]*)", 1)
    file_name = F.element_at(F.split("file_path", "/"), -1)
    # A generator: filters on the event's fields would otherwise read its text again, for
    # each mention of a field.
    events = (
        lines.filter(F.col("value").contains(EVENTS))
        .select(
            F.when(app != "", app).otherwise(file_name).alias("app_id"),
            F.inline_outer(F.array(F.from_json("value", EVENT_SCHEMA))),
        )
        .filter(F.col("Event").isin(START, END))
    )
    is_start = F.col("Event") == START
    plan = F.col("physicalPlanDescription")
    if only_writes:
        is_write = F.lit(False)
        for command in commands:
            is_write = is_write | plan.contains(command)
        events = events.filter(~is_start | is_write)
    failure = F.coalesce(F.col("errorMessage"), F.lit("")) != ""
    started = F.struct("rootExecutionId", "time", "description", plan.alias("plan"))
    ended = F.struct("time", F.when(failure, "failure").otherwise("success").alias("status"))
    return (
        events.groupBy("app_id", F.col("executionId").alias("execution_id"))
        .agg(
            F.max(F.when(is_start, started)).alias("started"),
            F.max(F.when(~is_start, ended)).alias("ended"),
        )
        .filter(F.col("started").isNotNull())
        .select(
            "app_id",
            "execution_id",
            F.col("started.rootExecutionId").alias("root_execution_id"),
            F.timestamp_millis(F.col("started.time")).alias("start_ts"),
            F.timestamp_millis(F.col("ended.time")).alias("end_ts"),
            F.coalesce("ended.status", F.lit("running")).alias("status"),
            F.col("started.description").alias("description"),
            F.col("started.plan").alias("plan"),
        )
    )


def scan_event_log(
    spark: SparkSession,
    path: str,
    compressed: bool = False,
    only_writes: bool = True,
    commands=SUPPORTED,
) -> DataFrame:
    """The executions of all event logs below ``path``.

    ``compressed`` takes only ``.zstd`` logs; without it all are read, by their endings.
    """
    lines = event_lines(spark, path)
    if compressed:
        lines = lines.filter(F.col("file_path").rlike(r"\.zstd(\.inprogress)?$"))
    return executions(lines, only_writes, commands)


# --- reading printed plans ------------------------------------------------------------


def _identifier_part(identifier: Column, from_end: int) -> Column:
    parts = F.split(F.translate(identifier, "`", ""), "[.]")
    return F.try_element_at(parts, F.lit(-from_end))


def _printed_inputs(lines: Column) -> Column:
    """Leaf relations from their printed lines."""

    def cut(line: Column) -> Column:
        is_hive = line.startswith(c.HIVE_RELATION)
        identifier = F.when(is_hive, F.regexp_extract(line, r"((?:`[^`]+`\.?)+)", 1)).otherwise(
            F.regexp_extract(line, r"^Relation ([^\[]+)\[", 1)
        )
        data = F.when(is_hive, F.regexp_extract(line, r"Data Cols: \[([^\]]*)\]", 1)).otherwise(
            F.regexp_extract(line, r"^Relation [^\[]+\[(.*)\] ", 1)
        )
        return F.struct(
            F.when(is_hive, c.HIVE_RELATION).otherwise(LOGICAL_RELATION).alias("relation_class"),
            F.split(F.translate(identifier, "`", ""), "[.]").alias("parts"),
            data.alias("data"),
            F.regexp_extract(line, r"Partition Cols: \[([^\]]*)\]", 1).alias("partition"),
        )

    def relation(x: Column, position: Column) -> Column:
        data = printed_plan.printed_columns(x["data"], False)
        partition = printed_plan.printed_columns(x["partition"], True)
        return F.struct(
            position.alias("leaf_pos"),
            x["relation_class"].alias("relation_class"),
            F.try_element_at(x["parts"], F.lit(-2)).alias("in_db"),
            F.try_element_at(x["parts"], F.lit(-1)).alias("in_table"),
            F.when(x["partition"] == "", data).otherwise(F.concat(data, partition)).alias("columns"),
        )

    # Cut first, so that what is used more than once is looked for once.
    return F.transform(F.transform(lines, cut), relation)


def _printed_entries(entries: Column, known: Column) -> Column:
    """Select-list entries from their printed texts: bare columns or aliases.

    known: the columns of the relations. What is printed like a column but is none of
    them, as a literal may be, is no leaf.
    """
    alias, bare = r"(?s)^(.*) AS (.+?)#(\d+)L?$", r"(?s)^(.+)#(\d+)L?$"

    def split(text: Column) -> Column:
        return F.struct(text.alias("text"), text.rlike(alias).alias("is_alias"))

    def cut(x: Column) -> Column:
        def part(alias_group: int, bare_group: int) -> Column:
            return F.when(x["is_alias"], F.regexp_extract(x["text"], alias, alias_group)).otherwise(
                F.regexp_extract(x["text"], bare, bare_group)
            )

        expression = F.when(x["is_alias"], F.regexp_extract(x["text"], alias, 1))
        return F.struct(
            x["is_alias"].cast("int").alias("n_children"),
            part(2, 1).alias("out_name"),
            part(3, 2).try_cast("bigint").alias("expr_id"),
            expression.alias("expr_text"),
            x["text"].alias("text"),
        )

    def entry(x: Column, position: Column) -> Column:
        def is_known(found: Column) -> Column:
            at = (F.array_position(known["expr_id"], found["id"]) - 1).cast("int")
            return F.coalesce(F.get(known["col_name"], at).endswith(found["name"]), F.lit(False))

        leaves = F.transform(
            F.filter(printed_plan.attributes(F.coalesce(x["expr_text"], x["text"])), is_known),
            lambda found, order: F.struct(
                order.alias("leaf_ord"),
                F.lit("AttributeReference").alias("leaf_class"),
                found["id"].alias("leaf_expr_id"),
            ),
        )
        return F.struct(
            position.alias("out_pos"),
            *[x[name].alias(name) for name in ("out_name", "expr_id", "n_children", "expr_text")],
            leaves.alias("leaves"),
        )

    return F.transform(F.transform(F.transform(entries, split), cut), entry)


def _optimized() -> Column:
    return F.substring_index(F.substring_index("plan", OPTIMIZED, -1), PHYSICAL, 1)


def _problem() -> Column:
    """Why a plan cannot be read, null when it can."""
    cut = _optimized().rlike(r"\.\.\. \d+ more fields")
    return F.when(~F.col("plan").contains(OPTIMIZED), "no_optimized_plan").when(cut, "cut_plan")


def _commands(log: DataFrame, bare: bool = False) -> DataFrame:
    """One row per write command of ``executions``: command, target, and its query's lines.
    With ``bare`` also one without a command for each execution that has none.

    A command counts at the root of the plan or below a union, as a multi-insert has it.
    The first of an execution has its id, others a number behind it.
    """
    head, query = F.col("head"), F.col("query")
    named = F.regexp_extract(head, r"^\w+ ((?:`[^`]+`\.?)+)", 1)
    inner = F.regexp_extract(head, r", ((?:`[^`]+`\.)*`[^`]+`)(?:, |$)", 1)
    v2 = F.regexp_extract(head, r"RelationV2\[[^\]]*\] ([^\s,]+)", 1)
    hive_db = F.regexp_extract(head, r"\[Database: ([^,]*), TableName: ", 1)
    hive_table = F.regexp_extract(head, r", TableName: ([^,\]]+)", 1)
    target = F.coalesce(*[F.nullif(found, F.lit("")) for found in (named, inner, v2)])
    identity = F.concat_ws("/", "app_id", "execution_id")
    trees = (
        log.filter(_problem().isNull())
        .withColumn("nodes", printed_plan.indented(_optimized()))
        .withColumn("nodes", printed_plan.joined_lines(F.col("nodes")))
        .withColumn("commands", printed_plan.reached(F.col("nodes"), WRITE_COMMANDS))
    )
    heads = (
        trees.select(*log.columns, "nodes", F.posexplode_outer("commands").alias("number", "at"))
        .filter(F.lit(bare) | F.col("at").isNotNull())
        .withColumn("head", F.get("nodes", F.col("at"))["text"])
        .withColumn("below", printed_plan.below(F.col("nodes"), F.col("at"))["text"])
        # What the planner puts between a command and its query.
        .withColumn("below", _without_first("below", r"^WriteFiles\b"))
        .withColumn("below", _without_first("below", r"(?s)^Sort \[.*\], false$"))
        .withColumn("query", F.coalesce(F.get("below", F.lit(0)), F.lit("")))
    )
    return (
        heads.withColumn("command_class", F.regexp_extract(head, r"^(\w+)", 1))
        .withColumn("write_id", F.when(F.col("number") == 0, identity).otherwise(F.concat_ws("/", identity, "number")))
        .withColumn("target", target)
        .withColumn("out_table", F.coalesce(_identifier_part(F.col("target"), 1), F.nullif(hive_table, F.lit(""))))
        .withColumn("out_db", F.coalesce(_identifier_part(F.col("target"), 2), F.nullif(hive_db, F.lit(""))))
        .drop("nodes", "plan", "at", "number", "target")
    )


def _parsed(commands: DataFrame) -> DataFrame:
    """``_commands`` with the relations read (``inputs``), the select list of a projection
    (``entries``), and ``verdict``, which is null where a record can be made of it."""
    query = F.col("query")
    names = F.split(F.regexp_extract("head", r"\[([^\[\]]*)\]$", 1), ", ")
    select_list = F.regexp_extract(query, r"(?s)^Project \[(.*)\]$", 1)
    is_project = query.startswith("Project [")
    relations = F.filter("below", lambda x: x.rlike(r"^(Relation [^\[\s]+\[|HiveTableRelation \[)"))
    entries = F.coalesce(
        printed_plan.named_entries(select_list, names), printed_plan.balanced_entries(select_list)
    )
    supported = F.col("command_class").isin(*SUPPORTED)
    parts = F.struct(
        _printed_inputs(relations).alias("inputs"), F.when(is_project, entries).alias("entries")
    )
    # A generator: a filter on the verdict would otherwise cut the select lists once more.
    return commands.select(
        *[name for name in commands.columns if name not in ("head", "below")],
        F.explode_outer(F.array(parts)).alias("parts"),
    ).select(
        "*",
        "parts.*",
        F.when(~supported, "unsupported")
        .when(is_project & F.col("parts.entries").isNull(), "unclear_select_list")
        .alias("verdict"),
    ).drop("parts")


def _without_first(name: str, pattern: str) -> Column:
    first = F.coalesce(F.get(name, F.lit(0)).rlike(pattern), F.lit(False))
    return F.when(first, F.slice(name, F.lit(2), F.size(name))).otherwise(F.col(name))


def _marked(log: DataFrame, bare: bool = False) -> DataFrame:
    """``_commands`` with ``is_repeat``: the insert that a create-table-as-select runs inside,
    as an execution of its own below the same root and with the same target. Inserts of
    file-based tables are printed with their path alone there.

    An execution without a root, as older logs have it, runs inside no other.
    """
    root = F.coalesce("root_execution_id", "execution_id")
    is_root = F.col("execution_id").eqNullSafe(root)
    creates = F.col("plan").contains(c.HIVE_CTAS) | F.col("plan").contains(c.DATASOURCE_CTAS)
    made = F.array(F.lower("out_table"), F.when(F.col("command_class") == c.DATASOURCE_CTAS, ""))
    created = (
        _commands(log.filter(creates))
        .filter(F.col("command_class").isin(*CREATING))
        .select("app_id", "root_execution_id", F.explode(made).alias("made"))
        .distinct()
        .withColumn("is_repeat", F.lit(True))
    )
    # Null for other commands, which meet no creation.
    inserted = F.when(F.col("command_class").isin(*INSERTING), F.coalesce(F.lower("out_table"), F.lit("")))
    inside = (
        _commands(log.filter(~is_root), bare)
        .withColumn("made", inserted)
        .join(unbroadcast(created), ["app_id", "root_execution_id", "made"], "left")
        .withColumn("is_repeat", F.coalesce("is_repeat", F.lit(False)))
        .drop("made")
    )
    return _commands(log.filter(is_root), bare).withColumn("is_repeat", F.lit(False)).unionByName(inside)


def unreadable_writes(log: DataFrame) -> DataFrame:
    """Writes no lineage can be read from, and why: the plan was not printed in full
    (``no_optimized_plan``, ``cut_plan``), or its select list cannot be cut in entries,
    which a literal with a lone parenthesis may cause (``unclear_select_list``)."""
    unclear = _parsed(_commands(log)).filter("verdict = 'unclear_select_list'")
    return (
        log.select("app_id", "execution_id", _problem().alias("reason"))
        .filter("reason IS NOT NULL")
        .unionByName(unclear.select("app_id", "execution_id", F.col("verdict").alias("reason")))
    )


def write_outcomes(log: DataFrame) -> DataFrame:
    """(write_id, status, command_class, outcome): what became of every write command, and
    of every execution whose plan has none that can be found.

    outcome: ``record``, ``unsupported``, ``repeat`` (of the create-table-as-select it runs
    in), a reason of ``unreadable_writes``, or ``no_command``.
    """
    outcome = (
        F.when(F.col("command_class").isNull(), "no_command")
        .when(F.col("is_repeat"), "repeat")
        .otherwise(F.coalesce("verdict", F.lit("record")))
    )
    whole = F.concat_ws("/", "app_id", "execution_id").alias("write_id")
    none = F.lit(None).cast("string").alias("command_class")
    unread = log.select(whole, "status", none, _problem().alias("outcome")).filter("outcome IS NOT NULL")
    found = _parsed(_marked(log, bare=True))
    return found.select("write_id", "status", "command_class", outcome.alias("outcome")).unionByName(unread)


def records_from_log(log: DataFrame, current_db: str = "default") -> DataFrame:
    """Nested write records of the writes in ``executions``; only inserts that run inside
    another execution are shuffled, to find out whether it is the same write.

    ``unnest`` turns them into capture tables; store them first, so the log is read
    once. Harvest with ``accepted=LOG_RELATIONS`` to see file-based tables too. The
    statement text is the execution's description, which is the text in the SQL shell
    or whatever the session set as job description. Writes without support are records
    too, which ``harvest`` reports; those that cannot be read are none, see
    ``unreadable_writes``.
    """
    found = _marked(log).filter("NOT is_repeat")
    root = F.regexp_extract("query", r"^(\w+)", 1)
    relation_class = F.lit(None).cast("string")
    for printed, name in PRINTED_RELATIONS.items():
        relation_class = F.when(root == printed, name).otherwise(relation_class)
    known = F.flatten(F.col("inputs.columns"))
    return (
        _parsed(found)
        .filter("verdict IS NULL OR verdict = 'unsupported'")
        .withColumn("known", F.struct(known["expr_id"].alias("expr_id"), known["col_name"].alias("col_name")))
        .select(
            "write_id",
            F.lit(None).cast("bigint").alias("thread_id"),
            F.col("end_ts").alias("exec_ts"),
            "status",
            "command_class",
            "out_db",
            F.lit(current_db).alias("current_db"),
            "out_table",
            F.coalesce(relation_class, root).alias("query_root"),
            F.col("description").alias("sql_text"),
            F.lit(None).cast("string").alias("run_user"),
            "inputs",
            _printed_entries(F.col("entries"), F.col("known")).alias("projections"),
        )
    )
