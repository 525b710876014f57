"""Registered queries: entities, envelope and outbox, with their oracle SQL."""

from pyspark.sql import functions as F

from spoor import constants as c
from spoor.functions import codec, text, versions
from spoor.operators import column_lineage as cols
from spoor.operators import entities, messages, table_lineage, writes
from spoor.plans.harvest import harvest, messages_of
from spoor.session import shared_folder
from spoor.sinks.publish import dead_letter, file_sink, outbox, publish
from workload import fixtures as fx

QUERIES = {}
ORACLE = {}

# Small enough for the test documents to take every path.
MAX_BYTES = 4096
RUN_ID = "run"


def query(sql: str | None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def _tables(spark, sf):
    w = writes.harvestable(fx.writes(spark, sf))
    return table_lineage.table_lineage(w, fx.inputs(spark, sf))


def _joined(refs: str, field: str, separator: str = ","):
    return F.array_join(F.transform(F.col(refs), lambda ref: ref[field]), separator)


def _names(refs: str):
    name = F.transform(F.col(refs), lambda ref: ref["uniqueAttributes"]["qualifiedName"])
    return F.array_join(name, ",")


# --- entities -------------------------------------------------------------------------


@query("""
SELECT write_id, to_json(list_transform(string_split(input_tables, ','), lambda t: {
         'typeName': 'hive_table', 'uniqueAttributes': {'qualifiedName': t},
         'relationshipType': 'dataset_process_inputs'})) AS refs
FROM lineage_table""")
def object_references(spark, sf):
    refs = entities.object_refs(F.col("input_tables"), c.TABLE_TYPE, c.INPUTS_RELATIONSHIP)
    return _tables(spark, sf).select("write_id", F.to_json(refs).alias("refs"))


@query("""
SELECT write_id, output_table AS msg_key, '-1' AS guid, 'hive_process' AS type_name, qualified_name,
       output_table AS name, 'Spark' AS user_name, epoch_ms(exec_ts) AS start_time,
       epoch_ms(exec_ts) AS end_time, operation_type, lower(sql_text) AS query_id,
       lower(sql_text) AS query_text, lower(sql_text) AS recent_queries, 'Not Supported' AS query_plan,
       '5k' AS cluster_name, input_tables AS inputs, output_table AS outputs
FROM lineage_table""")
def process_entities(spark, sf):
    pe = entities.process_entities(_tables(spark, sf))
    attributes = "entity.attributes."
    related = "entity.relationshipAttributes."
    return pe.select(
        "write_id",
        "msg_key",
        F.col("entity.guid").alias("guid"),
        F.col("entity.typeName").alias("type_name"),
        F.col(attributes + "qualifiedName").alias("qualified_name"),
        F.col(attributes + "name").alias("name"),
        F.col(attributes + "userName").alias("user_name"),
        F.col(attributes + "startTime").alias("start_time"),
        F.col(attributes + "endTime").alias("end_time"),
        F.col(attributes + "operationType").alias("operation_type"),
        F.col(attributes + "queryId").alias("query_id"),
        F.col(attributes + "queryText").alias("query_text"),
        F.array_join(attributes + "recentQueries", ",").alias("recent_queries"),
        F.col(attributes + "queryPlan").alias("query_plan"),
        F.col(attributes + "clusterName").alias("cluster_name"),
        _names(related + "inputs").alias("inputs"),
        _names(related + "outputs").alias("outputs"),
    )


@query("""
SELECT write_id, out_pos, process_name FROM lineage_column""")
def column_process_refs(spark, sf):
    cap = fx.capture(spark, sf)
    w = writes.harvestable(cap.writes)
    cl = harvest(cap).column_lineage.select("write_id", "out_pos")
    tl = table_lineage.table_lineage(w, cap.inputs)
    return entities.process_references(cl, tl)


@query("""
SELECT write_id, out_pos AS pos, CAST(-(out_pos + 2) AS STRING) AS guid,
       'hive_column_lineage' AS type_name, qualified_name, name, dependency_type, expression,
       epoch_ms(exec_ts) AS start_time, input_columns AS inputs, output_column AS outputs,
       process_name AS query_name, 'hive_process_column_lineage' AS query_relationship,
       CASE WHEN input_columns = '' THEN NULL ELSE 'dataset_process_inputs' END AS input_relationship
FROM lineage_column""")
def column_entities(spark, sf):
    ce = entities.column_entities(harvest(fx.capture(spark, sf)).column_lineage)
    attributes = "entity.attributes."
    related = "entity.relationshipAttributes."
    relationship = F.col(related + "query.relationshipType")
    return ce.select(
        "write_id",
        "pos",
        F.col("entity.guid").alias("guid"),
        F.col("entity.typeName").alias("type_name"),
        F.col(attributes + "qualifiedName").alias("qualified_name"),
        F.col(attributes + "name").alias("name"),
        F.col(attributes + "depenendencyType").alias("dependency_type"),
        F.col(attributes + "expression").alias("expression"),
        F.col(attributes + "startTime").alias("start_time"),
        _names(related + "inputs").alias("inputs"),
        _names(related + "outputs").alias("outputs"),
        F.col(related + "query.uniqueAttributes.qualifiedName").alias("query_name"),
        relationship.alias("query_relationship"),
        F.get(F.col(related + "inputs.relationshipType"), F.lit(0)).alias("input_relationship"),
    )


BUNDLE_SQL = """
SELECT t.write_id, t.output_table AS msg_key, 1 + count(l.write_id) AS n_entities,
       coalesce(string_agg(l.name, ',' ORDER BY l.out_pos), '') AS column_names
FROM lineage_table t LEFT JOIN lineage_column l ON t.write_id = l.write_id
GROUP BY t.write_id, t.output_table"""


def _contents(bundles):
    later = F.slice("entities", F.lit(2), F.size("entities"))
    names = F.transform(later, lambda entity: entity["attributes"]["name"])
    return bundles.select(
        "write_id",
        "msg_key",
        F.size("entities").cast("long").alias("n_entities"),
        F.array_join(names, ",").alias("column_names"),
    )


@query(BUNDLE_SQL)
def entity_bundles(spark, sf):
    return _contents(harvest(fx.capture(spark, sf)).bundles)


@query(BUNDLE_SQL)
def bundled_entities(spark, sf):
    found = harvest(fx.capture(spark, sf))
    pe = entities.process_entities(found.table_lineage)
    return _contents(entities.bundle_entities(pe, entities.column_entities(found.column_lineage)))


@query("""
SELECT t.write_id AS msg_seq, t.output_table AS msg_key, 'ENTITY_CREATE_V2' AS type, 'spark' AS user_name,
       t.qualified_name AS first_name, 1 + count(l.write_id) AS n_entities
FROM lineage_table t LEFT JOIN lineage_column l ON t.write_id = l.write_id
GROUP BY t.write_id, t.output_table, t.qualified_name""")
def hook_notifications(spark, sf):
    bundles = harvest(fx.capture(spark, sf)).bundles
    sent = entities.hook_notifications(bundles, "spark").withColumn("json", F.to_json("message"))
    return sent.select(
        "msg_seq",
        "msg_key",
        F.get_json_object("json", "$.type").alias("type"),
        F.get_json_object("json", "$.user").alias("user_name"),
        F.get_json_object("json", "$.entities.entities[0].attributes.qualifiedName").alias(
            "first_name"
        ),
        F.json_array_length(F.get_json_object("json", "$.entities.entities"))
        .cast("long")
        .alias("n_entities"),
    )


# --- envelope -------------------------------------------------------------------------


def _payloads(spark, sf, name="msg_json"):
    return fx.payloads(spark, sf).withColumnRenamed("payload", name)


@query("""
SELECT msg_seq, msg_key, '1.0.0' AS version, '[1]' AS version_parts, 'NONE' AS kind, '1' AS split_idx,
       '1' AS split_count, '10.0.0.1' AS source_ip, 'spark' AS created_by, '1700000000000' AS created_ms,
       CAST(NULL AS STRING) AS msg_id, payload AS message
FROM fx_payload""")
def envelopes(spark, sf):
    wrapped = messages.envelope(_payloads(spark, sf, "message"), "10.0.0.1", "spark", 1700000000000)
    schema = (
        "version struct<version: string, versionParts: string>, msgCompressionKind string, "
        "msgSplitIdx string, msgSplitCount string, msgSourceIP string, msgCreatedBy string, "
        "msgCreationTime string, msgId string, message string"
    )
    fields = {
        "version": "version.version",
        "version_parts": "version.versionParts",
        "kind": "msgCompressionKind",
        "split_idx": "msgSplitIdx",
        "split_count": "msgSplitCount",
        "source_ip": "msgSourceIP",
        "created_by": "msgCreatedBy",
        "created_ms": "msgCreationTime",
        "msg_id": "msgId",
        "message": "message",
    }
    back = wrapped.withColumn("back", F.from_json("msg_json", schema))
    read = [F.col("back." + field).alias(name) for name, field in fields.items()]
    return back.select("msg_seq", "msg_key", *read)


@query(f"""
SELECT msg_seq, CAST(strlen(payload) AS INTEGER) AS n_bytes,
       CASE WHEN 4 * (length(payload) + length(regexp_replace(payload, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')))
                 <= {MAX_BYTES} THEN 'fits_by_chars'
            WHEN strlen(payload) <= {MAX_BYTES} THEN 'fits_by_bytes' ELSE 'oversize' END AS size_class
FROM fx_payload""")
def size_classes(spark, sf):
    sized = messages.with_size_class(_payloads(spark, sf), MAX_BYTES)
    return sized.select("msg_seq", "n_bytes", "size_class")


@query(f"SELECT msg_seq, concat('{RUN_ID}_', CAST(msg_seq AS STRING)) AS msg_id FROM fx_payload")
def message_ids(spark, sf):
    named = messages.with_message_id(_payloads(spark, sf), RUN_ID)
    return named.select("msg_seq", "msg_id")


@query(f"""
SELECT doc_id AS msg_seq, concat('{RUN_ID}_', CAST(doc_id AS STRING)) AS msg_id, 'GZIP' AS kind,
       repeat(concat('entry ', CAST(doc_id AS STRING), ' ', coalesce(source, ''), ';'), 600) AS text
FROM documents""")
def compressed_messages(spark, sf):
    # Repeats of a short text: always oversize, and always small enough compressed.
    entry = F.concat(F.lit("entry "), F.col("doc_id"), F.lit(" "), F.coalesce("source", F.lit("")), F.lit(";"))
    docs = fx.table(spark, sf, "documents").select(
        F.col("doc_id").alias("msg_seq"), F.repeat(entry, 600).alias("msg_json")
    )
    sent = messages.compress_large(messages.with_message_id(docs, RUN_ID), MAX_BYTES)
    body = F.unbase64(F.get_json_object("value", "$.message"))
    return sent.select(
        "msg_seq",
        "msg_id",
        F.get_json_object("value", "$.msgCompressionKind").alias("kind"),
        F.decode(codec.gunzip_bytes(body), "UTF-8").alias("text"),
    )


SPLIT_SQL = f"""
SELECT msg_seq, concat('{RUN_ID}_', CAST(msg_seq AS STRING)) AS msg_id,
       CAST(i AS INTEGER) AS split_idx,
       CAST(ceil(length(body) / {MAX_BYTES}.0) AS INTEGER) AS split_count,
       substr(body, CAST(i * {MAX_BYTES} + 1 AS INTEGER), {MAX_BYTES}) AS body
FROM (SELECT msg_seq, body,
             unnest(range(0, CAST(ceil(length(body) / {MAX_BYTES}.0) AS BIGINT))) AS i
      FROM (SELECT msg_seq, to_base64(encode(payload)) AS body FROM fx_payload
            WHERE strlen(payload) > {MAX_BYTES}))"""


@query(SPLIT_SQL + """
UNION ALL
SELECT msg_seq, NULL, 1, 1, payload FROM fx_payload WHERE strlen(payload) <= 4096""")
def split_messages(spark, sf):
    named = messages.with_message_id(_payloads(spark, sf), RUN_ID)
    sent = messages.split_large(named, MAX_BYTES, compress=False)
    body = F.when(F.col("msg_id").isNull(), F.col("value")).otherwise(
        F.get_json_object("value", "$.message")
    )
    return sent.select("msg_seq", "msg_id", "split_idx", "split_count", body.alias("body"))


@query("""
SELECT msg_seq, CAST(i AS INTEGER) AS piece, substr(body, CAST(i * 1000 + 1 AS INTEGER), 1000) AS body
FROM (SELECT msg_seq, body, unnest(range(0, greatest(1, CAST(ceil(length(body) / 1000.0) AS BIGINT)))) AS i
      FROM (SELECT msg_seq, to_base64(encode(payload)) AS body FROM fx_payload))""")
def text_chunks(spark, sf):
    encoded = _payloads(spark, sf).select(
        "msg_seq", text.base64_text(F.encode("msg_json", "UTF-8")).alias("encoded")
    )
    return encoded.select(
        "msg_seq", F.posexplode_outer(text.chunks(F.col("encoded"), 1000)).alias("piece", "body")
    )


@query(f"""
SELECT concat('{RUN_ID}_', CAST(msg_seq AS STRING)) AS msg_id, payload AS msg_json
FROM fx_payload WHERE strlen(payload) > {MAX_BYTES}""")
def reassembled_messages(spark, sf):
    named = messages.with_message_id(_payloads(spark, sf), RUN_ID)
    sent = messages.split_large(named, MAX_BYTES).select("value")
    # Every part twice, as after a replay.
    return messages.reassemble(messages.read_parts(sent.unionByName(sent)))


@query(f"""
SELECT msg_id, 'missing_parts' AS reason FROM ({SPLIT_SQL}) WHERE split_idx = 0 AND split_count > 1""")
def incomplete_messages(spark, sf):
    named = messages.with_message_id(_payloads(spark, sf), RUN_ID)
    sent = messages.split_large(named, MAX_BYTES, compress=False)
    lost = (F.col("split_idx") == 0) & (F.col("split_count") > 1)
    return messages.rejected_messages(messages.read_parts(sent.filter(~lost).select("value")))


# --- versions and lists ---------------------------------------------------------------

VERSION_SQL = """
SELECT msg_seq, version,
       CASE WHEN regexp_matches(version, '^[0-9]+([.][0-9]+)*[.]*$')
            THEN regexp_replace(regexp_replace(version, '[.]+$', ''), '([.]0+)+$', '') END AS body
FROM fx_version"""


@query(f"""
SELECT msg_seq, version, CASE WHEN regexp_matches(body, '^0+$') THEN '' ELSE body END AS version_parts
FROM ({VERSION_SQL})""")
def version_parts(spark, sf):
    parsed = messages.with_version_parts(fx.message_versions(spark, sf))
    return parsed.withColumn("version_parts", F.array_join("version_parts", "."))


@query(f"""
SELECT msg_seq, version FROM ({VERSION_SQL})
WHERE CAST(string_split(CASE WHEN regexp_matches(body, '^0+$') THEN '0' ELSE body END, '.') AS INTEGER[])
      <= [1, 2]""")
def compatible_versions(spark, sf):
    return messages.compatible(fx.message_versions(spark, sf), "1.2.0").select("msg_seq", "version")


@query(f"""
SELECT o.msg_seq,
       CASE WHEN o.parts < n.parts THEN -1 WHEN o.parts = n.parts THEN 0 ELSE 1 END AS sign
FROM (SELECT msg_seq, CAST(string_split(CASE WHEN regexp_matches(body, '^0+$') THEN '0' ELSE body END, '.')
                           AS INTEGER[]) AS parts FROM ({VERSION_SQL}) WHERE body IS NOT NULL) o
JOIN (SELECT o_orderkey AS msg_seq, [CAST(1 + o_custkey % 2 AS INTEGER), CAST(1 + o_custkey % 5 AS INTEGER)]
             AS parts FROM orders) n
  ON o.msg_seq = n.msg_seq""")
def version_order(spark, sf):
    orders = fx.table(spark, sf, "orders").selectExpr(
        "o_orderkey AS msg_seq",
        "concat(CAST(1 + o_custkey % 2 AS STRING), '.', CAST(1 + o_custkey % 5 AS STRING), '.0') AS other",
    )
    both = fx.message_versions(spark, sf).join(orders, "msg_seq")
    sign = versions.compare_parts(
        versions.version_parts(F.col("version")), versions.version_parts(F.col("other"))
    )
    return both.select("msg_seq", sign.alias("sign")).filter("sign IS NOT NULL")


@query("""
SELECT conv_id, turn,
       array_to_string(list_filter(list_transform(string_split(csv, ','),
         lambda x: regexp_replace(regexp_replace(x, '^[\\x00-\\x20]+', ''), '[\\x00-\\x20]+$', '')),
         lambda x: x <> ''), '|') AS entries
FROM fx_strings""")
def clean_lists(spark, sf):
    cleaned = messages.clean_list(fx.separated_lists(spark, sf), "csv")
    return cleaned.select("conv_id", "turn", F.array_join("entries", "|").alias("entries"))


# --- outbox ---------------------------------------------------------------------------


def received(spark, sent):
    """Published messages as a reader of the outbox sees them, put together again."""
    folder = shared_folder(spark)
    if not publish(sent, file_sink(folder)):
        raise RuntimeError("the messages were not sent; publish has logged why")
    parts = messages.read_parts(spark.read.parquet(folder))
    whole = parts.filter("msg_id IS NULL").select("key", "topic", F.col("value").alias("msg_json"))
    split = messages.reassemble(parts, ["key", "topic"]).drop("msg_id")
    return whole.unionByName(split)


@query(f"""
SELECT msg_key AS key, '{c.DEFAULT_TOPIC}' AS topic, payload AS message, '1700000000000' AS created_ms
FROM fx_payload""")
def outbox_messages(spark, sf):
    asked = _payloads(spark, sf, "message")
    sent = messages_of(asked, RUN_ID, "10.0.0.1", "spark", 1700000000000, MAX_BYTES)
    return received(spark, sent).select(
        "key",
        "topic",
        F.get_json_object("msg_json", "$.message").alias("message"),
        F.get_json_object("msg_json", "$.msgCreationTime").alias("created_ms"),
    )


@query(f"""
SELECT t.output_table AS key, '{c.DEFAULT_TOPIC}' AS topic, t.qualified_name AS first_name,
       1 + count(l.write_id) AS n_entities
FROM lineage_table t LEFT JOIN lineage_column l ON t.write_id = l.write_id
GROUP BY t.write_id, t.output_table, t.qualified_name""")
def published_lineage(spark, sf):
    # From capture to outbox and back; the limit makes many messages compressed or split.
    bundles = harvest(fx.capture(spark, sf), staging=shared_folder(spark)).bundles
    asked = entities.hook_notifications(bundles, "spark")
    sent = messages_of(asked, RUN_ID, "10.0.0.1", "spark", 1700000000000, 2000)
    listed = "$.message.entities.entities"
    return received(spark, sent).select(
        "key",
        "topic",
        F.get_json_object("msg_json", listed + "[0].attributes.qualifiedName").alias("first_name"),
        F.json_array_length(F.get_json_object("msg_json", listed)).cast("long").alias("n_entities"),
    )


@query(f"""
SELECT msg_key AS key, payload AS value, '{c.DEFAULT_TOPIC}' AS topic, 'broker away' AS error FROM fx_payload""")
def dead_letters(spark, sf):
    return dead_letter(outbox(_payloads(spark, sf, "value")), "broker away")
