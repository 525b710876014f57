"""Registered queries that run streams and event-log scans over data Spark derives from
the test tables, written to the shared folder first."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from spoor import constants as c
from spoor.plans.harvest import harvest, harvest_records
from spoor.session import shared_folder
from spoor.sinks.outbox import publish_stored
from spoor.sinks.publish import file_sink
from spoor.sources import event_log
from spoor.sources.capture import (
    nest,
    read_capture,
    read_records,
    stream_capture,
    unnest,
    write_capture,
    write_records,
)
from spoor.streaming import lineage, statements
from workload import fixtures as fx
from workload.lineage_queries import LINEAGE_SQL
from workload.message_queries import BUNDLE_SQL

QUERIES = {}
ORACLE = {}

PARTITIONS_OF_A_FILE = 8

LINEAGE_COLUMNS = (
    "write_id",
    "out_pos",
    "output_column",
    "input_columns",
    "dependency_type",
    "expression",
    "qualified_name",
)


def query(sql: str | None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def _lineage(cl):
    return cl.withColumn("input_columns", F.array_join("input_columns", ",")).select(
        *LINEAGE_COLUMNS
    )


def _records(spark, sf, folder):
    """Nested write records of the test tables, as files a stream reads."""
    records = nest(fx.capture(spark, sf)).withColumn("exec_ts", F.col("exec_ts").cast("timestamp"))
    # A batch is a few files: they hold several partitions each where the cores have more than
    # enough, and have row groups for several tasks.
    cores = spark.sparkContext.defaultParallelism
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    files = cores * max(1, parts // (PARTITIONS_OF_A_FILE * cores))
    records.coalesce(files).write.options(**lineage.STAGED).parquet(f"{folder}/records")
    return stream_capture(spark, f"{folder}/records", maxFilesPerTrigger=4)


@query(LINEAGE_SQL)
def stored_capture_lineage(spark, sf):
    folder = shared_folder(spark)
    write_capture(fx.capture(spark, sf), folder)
    return _lineage(harvest(read_capture(spark, folder)).column_lineage)


@query(LINEAGE_SQL)
def record_lineage(spark, sf):
    folder = shared_folder(spark)
    write_records(nest(fx.capture(spark, sf)), folder)
    return _lineage(harvest_records(read_records(spark, folder), dedupe=False).column_lineage)


@query(LINEAGE_SQL)
def streamed_column_lineage(spark, sf):
    folder = shared_folder(spark)
    lineage.harvest_stream(
        _records(spark, sf, folder),
        [lineage.lineage_tables(f"{folder}/out")],
        f"{folder}/staging",
        f"{folder}/checkpoint",
    ).awaitTermination()
    return _lineage(spark.read.parquet(f"{folder}/out/column_lineage"))


@query(f"SELECT msg_key AS key, '{c.DEFAULT_TOPIC}' AS topic, n_entities FROM (" + BUNDLE_SQL + ")")
def streamed_messages(spark, sf):
    folder = shared_folder(spark)
    send = lineage.lineage_messages(
        file_sink(f"{folder}/outbox"), "run", "10.0.0.1", "spark", 1700000000000
    )
    lineage.harvest_stream(
        _records(spark, sf, folder), [send], f"{folder}/staging", f"{folder}/checkpoint"
    ).awaitTermination()
    # The default limit is far above these bundles, so every message came whole.
    listed = F.get_json_object("value", "$.message.entities.entities")
    return spark.read.parquet(f"{folder}/outbox").select(
        "key", "topic", F.json_array_length(listed).cast("long").alias("n_entities")
    )


@query("SELECT write_id FROM fx_write")
def streamed_dedupe(spark, sf):
    folder = shared_folder(spark)
    writes = fx.writes(spark, sf).select("write_id", F.col("exec_ts").cast("timestamp"))
    turn = F.pmod("write_id", F.lit(3))

    def keep(batch, batch_id):
        fresh = lineage.first_captures(batch, f"{folder}/seen", batch_id, "1 day", "yyyy-MM")
        lineage.stored(fresh.select("write_id").distinct(), f"{folder}/unique", batch_id)

    # Four arrivals, by turns and not by time: each has repeats of the one before, and
    # first captures later than the delay.
    for arrival in range(4):
        part = writes.filter((turn == arrival) | (turn == arrival - 1))
        part.write.mode("append").parquet(f"{folder}/captures")
        captures = stream_capture(spark, f"{folder}/captures", "write_id bigint, exec_ts timestamp")
        (
            captures.writeStream.foreachBatch(keep)
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return spark.read.parquet(f"{folder}/unique").select("write_id")


@query("""
SELECT e.event_id, e.thread_id, e.status, p.sql_text
FROM fx_exec e ASOF LEFT JOIN fx_parse p ON e.thread_id = p.thread_id AND e.ts >= p.ts""")
def streamed_statement_context(spark, sf):
    folder = shared_folder(spark)
    parse = fx.parses(spark, sf).withColumn("is_parse", F.lit(True))
    execs = fx.executions(spark, sf).withColumn("is_parse", F.lit(False))
    events = parse.unionByName(execs, allowMissingColumns=True).withColumn(
        "ts", F.col("ts").cast("timestamp")
    )
    # Three arrivals, each later than the one before.
    day = F.dayofmonth("ts")
    for arrived in (day <= 10, (day > 10) & (day <= 20), day > 20):
        events.filter(arrived).write.mode("append").parquet(f"{folder}/events")
        stream = stream_capture(spark, f"{folder}/events", statements.EVENT_SCHEMA)
        statements.statement_stream(
            stream,
            f"{folder}/out",
            f"{folder}/state",
            f"{folder}/staging",
            f"{folder}/checkpoint",
        ).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select(
        "event_id", "thread_id", "status", "sql_text"
    )


# --- event logs -----------------------------------------------------------------------


def _log_lines(spark, sf):
    """A start and an end event per order, as Spark writes them."""
    w = fx.writes(spark, sf)
    source = F.format_string("spark_catalog.raw.s_%d", F.col("write_id") % 7)
    target = F.concat(F.lit("`spark_catalog`.`mart`.`"), "out_table", F.lit("`"))
    plan = F.concat(
        F.lit("== Parsed Logical Plan ==\nnone\n\n"),
        F.lit(event_log.OPTIMIZED),
        F.col("command_class"),
        F.lit(" "),
        target,
        F.lit(", ErrorIfExists, [k, total, name]\n   +- Project [id#1L AS k#4L, "),
        F.lit("greatest(a#2, b#3, 0) AS total#5, name#6]\n      +- Join Inner, (id#1L = id#7L)\n"),
        F.lit("         :- Relation "),
        source,
        F.lit("[id#1L,a#2,b#3,name#6] parquet\n         +- Relation spark_catalog.raw.dim[id#7L]"),
        F.lit(" parquet"),
        F.lit(event_log.PHYSICAL + "\nnone"),
    )
    start = F.to_json(
        F.struct(
            F.lit(event_log.START).alias("Event"),
            F.col("write_id").alias("executionId"),
            F.col("write_id").alias("rootExecutionId"),
            F.col("sql_text").alias("description"),
            plan.alias("physicalPlanDescription"),
            F.lit(1700000000000).alias("time"),
        )
    )
    failed = F.col("status") == "failure"
    end = F.to_json(
        F.struct(
            F.lit(event_log.END).alias("Event"),
            F.col("write_id").alias("executionId"),
            F.lit(1700000001000).alias("time"),
            F.when(failed, "boom").otherwise("").alias("errorMessage"),
        )
    )
    return w.select(F.explode(F.array(start, end)).alias("value"))


@query("""
SELECT CAST(write_id AS STRING) AS execution, status, sql_text AS description
FROM fx_write WHERE command_class <> 'InsertIntoHadoopFsRelationCommand'""")
def event_log_executions(spark, sf):
    folder = f"{shared_folder(spark)}/app-20240101-0001"
    _log_lines(spark, sf).write.text(folder)
    found = event_log.scan_event_log(spark, folder)
    return found.select(
        F.col("execution_id").cast("string").alias("execution"), "status", "description"
    )


@query("""
SELECT concat('app-20240101-0001/', CAST(write_id AS STRING)) AS write_id, CAST(pos AS BIGINT) AS out_pos,
       concat('mart.', out_table, '.', col, '@5k') AS output_column,
       CASE pos WHEN 0 THEN concat(t, '.id@5k') WHEN 1 THEN concat(t, '.a@5k,', t, '.b@5k')
                ELSE concat(t, '.name@5k') END AS input_columns,
       CASE pos WHEN 1 THEN 'EXPRESSION' ELSE 'SIMPLE' END AS dependency_type,
       CASE pos WHEN 1 THEN 'greatest(a#2, b#3, 0)' END AS expression,
       concat('QUERY:raw.dim@5k:', t, '@5k->:', m, ':mart.', out_table, '@5k:', col) AS qualified_name
FROM (SELECT write_id, out_table, concat('raw.s_', CAST(write_id % 7 AS STRING)) AS t,
             CASE WHEN lower(sql_text) LIKE '%overwrite%' THEN 'INSERT_OVERWRITE' ELSE 'INSERT' END AS m
      FROM harvestable), (VALUES (0, 'k'), (1, 'total'), (2, 'name')) AS c(pos, col)""")
def event_log_lineage(spark, sf):
    folder = f"{shared_folder(spark)}/app-20240101-0001"
    _log_lines(spark, sf).write.text(folder)
    log = event_log.scan_event_log(spark, folder)
    event_log.records_from_log(log).write.parquet(f"{folder}-records")
    capture = unnest(spark.read.parquet(f"{folder}-records"))
    return _lineage(harvest(capture, accepted=event_log.LOG_RELATIONS).column_lineage)


# Plans of six shapes, with {command}, {table}, {source} and {second} put in. Literals are
# printed bare: one here holds a comma, a lone parenthesis and a line break, one what looks
# like columns.
_SOURCE = "Relation {source}[id#1L,a#2] parquet"
_SECOND = "InsertIntoHiveTable `spark_catalog`.`mart`.`{second}`, x, [a]"
SHAPES = {
    "planned": "{command} `spark_catalog`.`mart`.`{table}`, x, [k, total]\n+- WriteFiles\n"
    "   +- Sort [k#4L ASC NULLS FIRST], false\n"
    "      +- Project [id#1L AS k#4L, greatest(a#2, 0) AS total#5]\n         +- " + _SOURCE,
    "multi": "Union false, false\n:- {command} `spark_catalog`.`mart`.`{table}`, x, [k]\n"
    ":  +- Project [id#1L AS k#4L]\n:     +- " + _SOURCE + "\n+- " + _SECOND + "\n"
    "   +- Project [a#12]\n      +- Relation spark_catalog.raw.dim[id#11L,a#12] parquet",
    "literals": "{command} `spark_catalog`.`mart`.`{table}`, x, [lit, b, mark]\n"
    "   +- Project [x, (y\nz AS lit#12, (a#2 + 1) AS b#13, see total#2 and #1 AS mark#14]\n      +- " + _SOURCE,
    "unclear": "{command} `spark_catalog`.`mart`.`{table}`, x, [other]\n"
    "   +- Project [x(y AS lit#12, a#2]\n      +- " + _SOURCE,
    "copy": "{command} `spark_catalog`.`mart`.`{table}`, x, [id, a]\n+- " + _SOURCE,
    "created": "CreateHiveTableAsSelectCommand [Database: mart, TableName: {table}, InsertIntoHiveTable]\n"
    "   +- Project [id#1L AS k#4L]\n      +- " + _SOURCE,
}
# Executions inside those of the last shape: the same write again, and another one.
INNER = {
    1: "InsertIntoHiveTable `spark_catalog`.`mart`.`{table}`, x, [k]\n+- Project [id#1L AS k#4L]\n   +- " + _SOURCE,
    2: _SECOND + "\n+- Project [a#2]\n   +- " + _SOURCE,
}


def _shaped_lines(spark, sf):
    """The events of one execution per order, or three, in plans of all shapes."""
    values = {
        "command": F.col("command_class"),
        "table": F.col("out_table"),
        "source": F.format_string("spark_catalog.raw.s_%d", F.col("write_id") % 7),
        "second": F.concat(F.lit("second_"), "out_table"),
    }

    def run(number: int, plan):
        return F.struct(F.lit(number).alias("number"), plan.alias("plan"))

    shape = (F.col("write_id") % 6).cast("int")
    outer = run(0, F.get(F.array(*[F.lit(text) for text in SHAPES.values()]), shape))
    inner = [run(number, F.lit(text)) for number, text in INNER.items()]
    # Plans are filled in after the generator, once for all shapes: filled in one by one, the
    # generated method is too long for the JVM to compile.
    runs = fx.writes(spark, sf).select(
        *["write_id", "sql_text", "status", "command_class", "out_table"],
        F.inline(F.when(shape == 5, F.array(outer, *inner)).otherwise(F.array(outer))),
    )
    plan = F.col("plan")
    for name, value in values.items():
        plan = F.replace(plan, F.lit("{" + name + "}"), value)
    root = F.col("write_id") * 10
    execution = root + F.col("number")
    start = F.struct(
        F.lit(event_log.START).alias("Event"),
        execution.alias("executionId"),
        root.alias("rootExecutionId"),
        F.col("sql_text").alias("description"),
        F.concat(F.lit(event_log.OPTIMIZED), plan, F.lit(event_log.PHYSICAL + "\nnone")).alias("physicalPlanDescription"),
        F.lit(1700000000000).alias("time"),
    )
    end = F.struct(
        F.lit(event_log.END).alias("Event"),
        execution.alias("executionId"),
        F.lit(1700000001000).alias("time"),
        F.when(F.col("status") == "failure", "boom").otherwise("").alias("errorMessage"),
    )
    return runs.select(F.explode(F.array(F.to_json(start), F.to_json(end))).alias("value"))


def _shaped_log(spark, sf):
    """The executions of the shaped plans, scanned from a log and written down."""
    folder = f"{shared_folder(spark)}/app-20240101-0002"
    _shaped_lines(spark, sf).write.text(folder)
    log = event_log.scan_event_log(spark, folder, commands=event_log.WRITE_COMMANDS)
    log.write.parquet(f"{folder}-executions")
    return spark.read.parquet(f"{folder}-executions")


def _shaped_capture(spark, sf):
    folder = shared_folder(spark)
    event_log.records_from_log(_shaped_log(spark, sf)).write.parquet(folder)
    return unnest(spark.read.parquet(folder))


# Every write command of the shaped plans.
SHAPED_SQL = """
SELECT w.write_id AS number, w.sql_text, w.status, s.command_class, s.shape, s.target, s.source,
       concat('app-20240101-0002/', CAST(w.write_id * 10 + s.execution AS STRING), s.tail) AS write_id,
       s.repeated
FROM fx_write w, LATERAL (
  SELECT w.write_id % 6 AS shape, CASE WHEN w.write_id % 6 = 5 THEN 'CreateHiveTableAsSelectCommand' ELSE w.command_class END AS command_class,
         w.out_table AS target, concat('raw.s_', CAST(w.write_id % 7 AS STRING)) AS source, 0 AS execution, '' AS tail, false AS repeated
  UNION ALL SELECT 6, 'InsertIntoHiveTable', concat('second_', w.out_table), 'raw.dim', 0, '/1', false WHERE w.write_id % 6 = 1
  UNION ALL SELECT 7, 'InsertIntoHiveTable', w.out_table, concat('raw.s_', CAST(w.write_id % 7 AS STRING)), 1, '', true WHERE w.write_id % 6 = 5
  UNION ALL SELECT 8, 'InsertIntoHiveTable', concat('second_', w.out_table), concat('raw.s_', CAST(w.write_id % 7 AS STRING)), 2, '', false WHERE w.write_id % 6 = 5
) s"""


@query(f"""
SELECT s.write_id, concat('mart.', target, '.', col, '@5k') AS output_column,
       CASE WHEN input = '' THEN '' ELSE concat(source, '.', input, '@5k') END AS input_columns, type AS dependency_type,
       replace(expr, '|', chr(10)) AS expression,
       concat('QUERY:', source, '@5k->:', CASE WHEN lower(sql_text) LIKE '%overwrite%' THEN 'INSERT_OVERWRITE' ELSE 'INSERT' END,
              ':mart.', target, '@5k:', col) AS qualified_name
FROM ({SHAPED_SQL}) s JOIN (VALUES
  (0, 'k', 'id', 'SIMPLE', NULL), (0, 'total', 'a', 'EXPRESSION', 'greatest(a#2, 0)'),
  (1, 'k', 'id', 'SIMPLE', NULL), (6, 'a', 'a', 'SIMPLE', NULL),
  (2, 'lit', '', 'EXPRESSION', 'x, (y|z'), (2, 'b', 'a', 'EXPRESSION', '(a#2 + 1)'),
  (2, 'mark', '', 'EXPRESSION', 'see total#2 and #1'),
  (4, 'id', 'id', 'SIMPLE', NULL), (4, 'a', 'a', 'SIMPLE', NULL),
  (5, 'k', 'id', 'SIMPLE', NULL), (8, 'a', 'a', 'SIMPLE', NULL)
) AS c(shape, col, input, type, expr) ON c.shape = s.shape
WHERE status = 'success' AND command_class <> 'InsertIntoHadoopFsRelationCommand'""")
def event_log_shapes(spark, sf):
    capture = _shaped_capture(spark, sf)
    found = harvest(capture, accepted=event_log.LOG_RELATIONS).column_lineage
    return _lineage(found).drop("out_pos")


@query(f"""
SELECT write_id, status, command_class,
       CASE WHEN repeated THEN 'repeat' WHEN command_class = 'InsertIntoHadoopFsRelationCommand' THEN 'unsupported'
            WHEN shape = 3 THEN 'unclear_select_list' ELSE 'record' END AS outcome
FROM ({SHAPED_SQL})""")
def event_log_outcomes(spark, sf):
    return event_log.write_outcomes(_shaped_log(spark, sf))


@query(f"""
SELECT write_id, target AS out_table FROM ({SHAPED_SQL})
WHERE status = 'success' AND command_class = 'InsertIntoHadoopFsRelationCommand'""")
def event_log_unsupported(spark, sf):
    return harvest(_shaped_capture(spark, sf)).unsupported.select("write_id", "out_table")


@query("""
SELECT msg_key AS key, msg_seq, row_number() OVER (PARTITION BY msg_key ORDER BY msg_seq) AS place
FROM fx_payload WHERE msg_key IS NOT NULL""")
def ordered_outbox(spark, sf):
    """The place at which each message of a key was sent, through an outbox of few ranges."""
    folder = shared_folder(spark)
    msgs = fx.payloads(spark, sf).select(
        "msg_key", F.concat_ws(" ", "msg_seq", "payload").alias("value"), "msg_seq"
    )
    calls = iter(range(1 << 30))

    def send(rows):
        placed = rows.withColumn("at", F.monotonically_increasing_id())
        placed.write.parquet(f"{folder}/topic/call={next(calls)}")

    publish_stored(msgs, f"{folder}/outbox", send, ranges=16)
    order = Window.partitionBy("key").orderBy("call", "at")
    received = spark.read.parquet(f"{folder}/topic").filter("key IS NOT NULL")
    return received.select(
        "key",
        F.split("value", " ")[0].cast("long").alias("msg_seq"),
        F.row_number().over(order).cast("long").alias("place"),
    )


@query("""
SELECT e.event_id, e.thread_id, e.status, p.sql_text
FROM fx_exec e ASOF LEFT JOIN fx_parse p ON e.thread_id = p.thread_id AND e.ts >= p.ts""")
def streamed_statement_state(spark, sf):
    """Five arrivals over texts that are put together every other batch."""
    folder = shared_folder(spark)
    parse = fx.parses(spark, sf).withColumn("is_parse", F.lit(True))
    execs = fx.executions(spark, sf).withColumn("is_parse", F.lit(False))
    events = parse.unionByName(execs, allowMissingColumns=True).withColumn("ts", F.col("ts").cast("timestamp"))
    turn = F.least(F.floor((F.dayofmonth("ts") - 1) / 6), F.lit(4))
    for arrival in range(5):
        events.filter(turn == arrival).write.mode("append").parquet(f"{folder}/events")
        stream = stream_capture(spark, f"{folder}/events", statements.EVENT_SCHEMA)
        statements.statement_stream(
            stream,
            f"{folder}/out",
            f"{folder}/state",
            f"{folder}/staging",
            f"{folder}/checkpoint",
            compact=2,
        ).awaitTermination()
    return spark.read.parquet(f"{folder}/out").select("event_id", "thread_id", "status", "sql_text")
