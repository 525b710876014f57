"""Catalog entities, built as structs and written as JSON."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoor import constants as c
from spoor.functions import names
from spoor.functions.times import epoch_millis
from spoor.operators.spread import position_block, spread_join, unbroadcast
from spoor.operators.table_lineage import process_records

# One struct for both entity kinds, so they fit one array; JSON leaves nulls out.
# The misspelt name is the catalog's.
ATTRIBUTES = {
    "qualifiedName": "string",
    "name": "string",
    "userName": "string",
    "startTime": "bigint",
    "endTime": "bigint",
    "operationType": "string",
    "queryId": "string",
    "queryText": "string",
    "recentQueries": "array<string>",
    "queryPlan": "string",
    "clusterName": "string",
    "depenendencyType": "string",
    "expression": "string",
}
PROCESS_POS = -1
# What bundles take of a named write.
NAMED = (
    "write_id",
    "input_tables",
    "output_table",
    "exec_ts",
    "operation_type",
    "sql_text",
    "output_db",
    "out_table",
    "sorted_inputs",
    "write_mode",
)


def object_ref(name: Column, type_name: str, relationship: str, guid: Column | None = None) -> Column:
    return F.struct(
        (F.lit(None).cast("string") if guid is None else guid).alias("guid"),
        F.lit(type_name).alias("typeName"),
        F.struct(name.alias("qualifiedName")).alias("uniqueAttributes"),
        F.lit(relationship).alias("relationshipType"),
    )


def object_refs(qualified: Column, type_name: str, relationship: str) -> Column:
    """A typed reference for every name of an array."""
    return F.transform(qualified, lambda name: object_ref(name, type_name, relationship))


def _guid(position: Column) -> Column:
    """Message-local id: -1 for the process, then -2, -3, ... by position."""
    return (-(position + F.lit(2))).cast("string")


def _entity(type_name: str, position: Column, values: dict, inputs, outputs, query) -> Column:
    attributes = F.struct(
        *[
            values.get(name, F.lit(None)).cast(kind).alias(name)
            for name, kind in ATTRIBUTES.items()
        ]
    )
    return F.struct(
        _guid(position).alias("guid"),
        F.lit(type_name).alias("typeName"),
        attributes.alias("attributes"),
        F.struct(
            inputs.alias("inputs"), outputs.alias("outputs"), query.alias("query")
        ).alias("relationshipAttributes"),
    )


def _process_entity(tl: DataFrame) -> Column:
    values = {
        "qualifiedName": F.col("qualified_name"),
        "name": F.col("name"),
        "userName": F.col("user_name"),
        "startTime": epoch_millis(tl, "start_time"),
        "endTime": epoch_millis(tl, "end_time"),
        "operationType": F.col("operation_type"),
        "queryId": F.col("query_id"),
        "queryText": F.col("query_text"),
        "recentQueries": F.col("recent_queries"),
        "queryPlan": F.col("query_plan"),
        "clusterName": F.col("cluster_name"),
    }
    no_query = object_ref(F.lit(""), c.PROCESS_TYPE, c.COLUMN_LINEAGE_RELATIONSHIP)
    return _entity(
        c.PROCESS_TYPE,
        F.lit(PROCESS_POS).cast("long"),
        values,
        object_refs(F.col("input_tables"), c.TABLE_TYPE, c.INPUTS_RELATIONSHIP),
        object_refs(F.array("output_table"), c.TABLE_TYPE, c.OUTPUTS_RELATIONSHIP),
        F.when(F.lit(False), no_query),
    )


def _column_entity(
    position: Column,
    qualified_name: Column,
    name: Column,
    millis: Column,
    dependency_type: Column,
    expression: Column,
    input_columns: Column,
    output_column: Column,
    process_name: Column,
) -> Column:
    values = {
        "qualifiedName": qualified_name,
        "name": name,
        "startTime": millis,
        "endTime": millis,
        "depenendencyType": dependency_type,
        "expression": expression,
    }
    return _entity(
        c.COLUMN_LINEAGE_TYPE,
        position,
        values,
        object_refs(input_columns, c.COLUMN_TYPE, c.INPUTS_RELATIONSHIP),
        object_refs(F.array(output_column), c.COLUMN_TYPE, c.OUTPUTS_RELATIONSHIP),
        object_ref(
            process_name,
            c.PROCESS_TYPE,
            c.COLUMN_LINEAGE_RELATIONSHIP,
            _guid(F.lit(PROCESS_POS)),
        ),
    )


def process_entities(tl: DataFrame) -> DataFrame:
    """``hive_process`` entities from table lineage."""
    return tl.select(
        "write_id",
        F.col("output_table").alias("msg_key"),
        F.lit(PROCESS_POS).cast("long").alias("pos"),
        _process_entity(tl).alias("entity"),
    )


def process_references(cl: DataFrame, tl: DataFrame, layout: DataFrame | None = None) -> DataFrame:
    """Columns with the name of their write's process, for records that lack it."""
    process = tl.select("write_id", F.col("qualified_name").alias("process_name"))
    return spread_join(cl, process, ["write_id"], position_block(F.col("out_pos")), layout)


def column_entities(cl: DataFrame) -> DataFrame:
    """``hive_column_lineage`` entities from columns with a ``process_name``."""
    entity = _column_entity(
        F.col("out_pos"),
        F.col("qualified_name"),
        F.col("name"),
        epoch_millis(cl, "exec_ts"),
        F.col("dependency_type"),
        F.col("expression"),
        F.col("input_columns"),
        F.col("output_column"),
        F.col("process_name"),
    )
    return cl.select("write_id", F.col("out_pos").alias("pos"), entity.alias("entity"))


def bundle_entities(pe: DataFrame, ce: DataFrame) -> DataFrame:
    """Per write its process, then its columns in order: the content of one message.

    A bundle is one value by definition, so a write's entities end in one row; map
    tasks combine their share before the shuffle. ``bundle_columns`` gives the same
    from unfinished records and shuffles less.
    """
    entry = F.struct("pos", "entity")
    return (
        pe.unionByName(ce, allowMissingColumns=True)
        .groupBy("write_id")
        .agg(F.max("msg_key").alias("msg_key"), F.collect_list(entry).alias("entries"))
        .select(
            "write_id",
            "msg_key",
            F.transform(F.sort_array("entries"), lambda entry: entry["entity"]).alias("entities"),
        )
    )


def bundle_columns(
    named: DataFrame,
    columns: DataFrame,
    ns: str = c.DEFAULT_NAMESPACE,
) -> DataFrame:
    """The bundles of ``named_writes`` and their ``lineage_columns``.

    Only what differs between the columns of a write is shuffled; the long names, which
    repeat the write's inputs, are built in the bundle itself.
    """
    return bundle_lists(column_lists(named, columns), ns)


def column_lists(named: DataFrame, columns: DataFrame) -> DataFrame:
    """What ``bundle_lists`` needs of ``named_writes``, with their ``lineage_columns`` as an
    array ``columns``, null where there are none."""
    record = F.struct("out_pos", "out_name", "input_columns", "dependency_type", "expression")
    listed = columns.groupBy("write_id").agg(F.collect_list(record).alias("columns"))
    return named.select(*NAMED).join(unbroadcast(listed), "write_id", "left")


def bundle_lists(named: DataFrame, ns: str = c.DEFAULT_NAMESPACE) -> DataFrame:
    """The bundles of ``named_writes`` that have their columns as an array ``columns``."""
    processes = process_records(
        named, ns, "output_db", "out_table", "sorted_inputs", "write_mode", "columns"
    )
    millis = epoch_millis(processes, "start_time")
    database, table = F.col("output_db"), F.col("out_table")

    def column_entity(record: Column) -> Column:
        label = names.column_process_label(database, table, record["out_name"], ns)
        return _column_entity(
            record["out_pos"],
            names.process_name(F.col("sorted_inputs"), F.col("write_mode"), label),
            label,
            millis,
            record["dependency_type"],
            record["expression"],
            record["input_columns"],
            names.output_column_name(database, table, record["out_name"], ns),
            F.col("qualified_name"),
        )

    process = F.array(_process_entity(processes))
    ordered = F.transform(F.sort_array("columns"), column_entity)
    return processes.select(
        "write_id",
        F.col("output_table").alias("msg_key"),
        F.when(F.col("columns").isNull(), process)
        .otherwise(F.concat(process, ordered))
        .alias("entities"),
        F.col("start_time").alias("exec_ts"),
    )


def hook_notifications(bundles: DataFrame, user: str) -> DataFrame:
    """The create request of every bundle, with its write's time where bundles have it."""
    message = F.struct(
        F.lit(c.NOTIFICATION_TYPE).alias("type"),
        F.lit(user).alias("user"),
        F.struct("entities").alias("entities"),
    )
    return bundles.select(
        F.col("write_id").alias("msg_seq"),
        "msg_key",
        message.alias("message"),
        *[name for name in bundles.columns if name == "exec_ts"],
    )
