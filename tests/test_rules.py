"""Naming rules and behaviour decisions on hand-made writes."""

import json
from datetime import timedelta

import pytest
from captures import AT, column, entry, leaf, records, write
from pyspark.sql import functions as F
from spoor.operators import entities, statements, writes
from spoor.plans.harvest import harvest
from spoor.sources.capture import nest, parse_records, unnest, unparsed_records


def derive(spark, *given, **options):
    return harvest(unnest(records(spark, *given)), **options)


def columns_of(result):
    rows = result.column_lineage.orderBy("write_id", "out_pos").collect()
    return {(row.write_id, row.output_column): row for row in rows}


def process_of(result):
    return {row.write_id: row for row in result.table_lineage.collect()}


@pytest.fixture(scope="module")
def named(spark):
    two = [leaf(0, "B", db=None), leaf(1, "a"), leaf(2, "B")]
    return process_of(
        derive(
            spark,
            write(1, inputs=two, out_db=None, sql_text=None),
            write(2, inputs=two, sql_text="insert OverWrite table x"),
            write(3, sql_text="create table overwrite_log as select 1"),
            write(4, command_class="CreateHiveTableAsSelectCommand"),
            write(5, command_class="CreateDataSourceTableAsSelectCommand"),
            write(6, status="failure"),
            write(7, command_class="InsertIntoHadoopFsRelationCommand"),
            write(8, inputs=[leaf(0, "F", kind="LogicalRelation")]),
            write(9, inputs=[]),
        )
    )


def test_missing_databases_have_two_defaults(named):
    assert named[1].output_table == "work.Out@5k"
    assert named[1].input_tables == ["default.B@5k", "raw.a@5k", "raw.B@5k"]


def test_inputs_sorted_by_bare_name_ties_in_leaf_order(named):
    assert named[1].qualified_name == (
        "QUERY:default.B@5k:raw.B@5k:raw.a@5k->:INSERT:work.Out@5k"
    )


def test_missing_text_is_a_plain_insert(named):
    assert named[1].query_text is None and named[1].recent_queries is None


def test_overwrite_is_found_anywhere_in_the_text(named):
    assert "->:INSERT_OVERWRITE:" in named[2].qualified_name
    assert "->:INSERT_OVERWRITE:" in named[3].qualified_name
    assert named[2].query_text == "insert overwrite table x"
    assert named[2].recent_queries == ["insert overwrite table x"]


def test_operation_types(named):
    assert [named[k].operation_type for k in (3, 4, 5)] == [
        "INSERT_INTO_HIVE_TABLE",
        "CREATETABLE_AS_SELECT",
        "CREATETABLE_AS_SELECT",
    ]


def test_only_supported_successful_writes_with_inputs(named):
    assert sorted(named) == [1, 2, 3, 4, 5]


def test_rejected_and_unsupported(spark):
    result = derive(
        spark,
        write(1, inputs=[]),
        write(2, inputs=[leaf(0, "F", kind="LogicalRelation")]),
        write(3, command_class="Other"),
        write(4, command_class="Other", status="failure"),
        write(5, command_class=None),
    )
    rejected = {(r.write_id, r.reason) for r in result.rejected.collect()}
    assert rejected == {(1, "no_inputs"), (2, "no_inputs")}
    assert sorted(r.write_id for r in result.unsupported.collect()) == [3, 5]


@pytest.fixture(scope="module")
def derived(spark):
    second = leaf(1, "B", [column(11, "X"), column(12, "Day", True)], db=None)
    first = leaf(0, "A", [column(1, "Id"), column(2, "Amount")])
    hidden = leaf(2, "H", [column(21, "H")], kind="LogicalRelation")
    return derive(
        spark,
        write(
            1,
            inputs=[first, second, hidden],
            projections=[
                entry(0, "Id", 1),
                entry(1, "Renamed", 101, "Amount#2", [2]),
                entry(2, "Both", 102, "(X#11 + Amount#2)", [11, 2]),
                entry(3, "Up", 103, "upper(X#11)", [11]),
                entry(4, "Ghost", 999),
                entry(5, "Lit", 105, "1", [None]),
                entry(6, "Day", 12),
                entry(7, "Plus", 107, "(Amount#2 + 1)", [2, None]),
                entry(8, "Open", 108, "Amount#2 (", [2]),
                entry(9, "Twice", 109, "Amount#2,Amount#2", [2, 2]),
                entry(10, "H", 21),
                entry(11, "HX", 111, "H#21", [21]),
                entry(12, "Mixed", 112, "H#21,X#11", [21, 11]),
            ],
        ),
        write(2, query_root="HiveTableRelation", inputs=[second], projections=[]),
        write(3, query_root="Aggregate", projections=[entry(0, "Id", 1)]),
    )


@pytest.fixture(scope="module")
def columns(derived):
    return columns_of(derived)


@pytest.mark.parametrize(
    "name, inputs, kind, expression",
    [
        ("id", ["raw.a.id@5k"], "SIMPLE", None),
        ("renamed", ["raw.a.amount@5k"], "SIMPLE", None),
        ("both", ["default.b.x@5k", "raw.a.amount@5k"], "EXPRESSION", "(X#11 + Amount#2)"),
        ("up", ["default.b.x@5k"], "EXPRESSION", "upper(X#11)"),
        ("lit", [], "EXPRESSION", "1"),
        ("day", ["default.b.day@5k"], "SIMPLE", None),
        ("plus", ["raw.a.amount@5k"], "EXPRESSION", "(Amount#2 + 1)"),
        ("open", ["raw.a.amount@5k"], "SIMPLE", None),
        ("twice", ["raw.a.amount@5k"] * 2, "EXPRESSION", "Amount#2,Amount#2"),
        ("hx", [], "EXPRESSION", "H#21"),
        ("mixed", ["default.b.x@5k"], "SIMPLE", None),
    ],
)
def test_projected_column(columns, name, inputs, kind, expression):
    row = columns[1, f"mart.Out.{name}@5k"]
    assert (row.input_columns, row.dependency_type, row.expression) == (inputs, kind, expression)


def test_columns_nobody_owns_vanish(columns):
    assert (1, "mart.Out.ghost@5k") not in columns
    # Owned only by a relation that is not accepted.
    assert (1, "mart.Out.h@5k") not in columns


def test_column_process_names_all_inputs(columns):
    row = columns[1, "mart.Out.id@5k"]
    assert row.qualified_name == "QUERY:raw.A@5k:default.B@5k->:INSERT:mart.Out@5k:id"
    assert row.process_name == "QUERY:raw.A@5k:default.B@5k->:INSERT:mart.Out@5k"


def test_whole_copy(columns):
    copied = {name: row for (write_id, name), row in columns.items() if write_id == 2}
    assert {name: row.input_columns for name, row in copied.items()} == {
        "mart.Out.x@5k": ["default.b.x@5k"],
        "mart.Out.day@5k": ["default.b.day@5k"],
    }


def test_other_roots_give_no_columns(columns):
    assert not [key for key in columns if key[0] == 3]


def test_edges_keep_order_and_empty_inputs(derived):
    edges = derived.column_edges.filter("write_id = 1").collect()
    both = sorted(
        (e.input_pos, e.input_column) for e in edges if e.output_column == "mart.Out.both@5k"
    )
    assert both == [(0, "default.b.x@5k"), (1, "raw.a.amount@5k")]
    assert [e.input_column for e in edges if e.output_column == "mart.Out.lit@5k"] == [None]


def test_bundle_json(derived):
    sent = entities.hook_notifications(derived.bundles, "me").filter("msg_seq = 1")
    row = sent.select("msg_key", F.to_json("message").alias("json")).first()
    message = json.loads(row.json)
    assert (row.msg_key, message["type"], message["user"]) == (
        "mart.Out@5k",
        "ENTITY_CREATE_V2",
        "me",
    )
    process, first, *rest = message["entities"]["entities"]
    assert process["typeName"] == "hive_process" and process["guid"] == "-1"
    assert process["attributes"]["startTime"] == process["attributes"]["endTime"]
    assert process["attributes"]["queryPlan"] == "Not Supported"
    assert process["attributes"]["userName"] == "Spark"
    assert "query" not in process["relationshipAttributes"]
    assert first["attributes"]["depenendencyType"] == "SIMPLE"
    assert "expression" not in first["attributes"]
    assert first["relationshipAttributes"]["query"] == {
        "guid": "-1",
        "typeName": "hive_process",
        "uniqueAttributes": {"qualifiedName": process["attributes"]["qualifiedName"]},
        "relationshipType": "hive_process_column_lineage",
    }
    assert first["relationshipAttributes"]["inputs"] == [
        {
            "typeName": "hive_column",
            "uniqueAttributes": {"qualifiedName": "raw.a.id@5k"},
            "relationshipType": "dataset_process_inputs",
        }
    ]
    names = [e["attributes"]["name"].split(":")[1] for e in [first, *rest]]
    assert names[:3] == ["id", "renamed", "both"] and len(names) == 11


def test_writes_without_columns_still_have_a_bundle(derived):
    sizes = {r.write_id: len(r.entities) for r in derived.bundles.collect()}
    assert sizes == {1: 12, 2: 3, 3: 1}


def test_a_long_select_list_is_one_bundle(spark):
    long = write(1, projections=[entry(k, f"c{k:05}", 1) for k in range(1_200)])
    found = derive(spark, long)
    (one,) = found.bundles.collect()
    pe = entities.process_entities(found.table_lineage)
    (two,) = entities.bundle_entities(pe, entities.column_entities(found.column_lineage)).collect()
    assert len(one.entities) == 1_201
    assert [e.attributes.name for e in one.entities] == [e.attributes.name for e in two.entities]


def test_relation_listed_twice_below_a_union(spark):
    same = [leaf(k, "A", [column(1, "Id"), column(2, "Amount")]) for k in (0, 1)]
    result = derive(
        spark,
        write(1, inputs=same, projections=[entry(0, "Id", 1), entry(1, "S", 5, "f(Id#1)", [1])]),
    )
    found = columns_of(result)
    assert len(found) == 2
    assert found[1, "mart.Out.s@5k"].input_columns == ["raw.a.id@5k"]
    assert result.table_edges.count() == 2
    assert process_of(result)[1].input_tables == ["raw.A@5k", "raw.A@5k"]


def test_same_column_name_copied_once(spark):
    doubled = leaf(0, "A", [column(1, "Id"), column(2, "Id"), column(3, "ID")])
    found = derive(spark, write(1, query_root="HiveTableRelation", inputs=[doubled]))
    rows = found.column_lineage.collect()
    assert sorted(r.out_pos for r in rows) == [1, 3]


def test_commands_count_once_by_first_capture(spark):
    later = AT + timedelta(hours=1)
    result = derive(
        spark,
        write(1, exec_ts=later, inputs=None, sql_text="INSERT OVERWRITE x"),
        write(1, sql_text="INSERT INTO x"),
        write(1, status="failure", exec_ts=AT - timedelta(hours=1), inputs=None),
    )
    row = result.table_lineage.collect()
    assert len(row) == 1 and "->:INSERT:" in row[0].qualified_name


def test_normalized_names_and_stable_text(spark):
    given = write(1, projections=[entry(0, "T", 9, "f(Amount#2L)", [2])])
    result = derive(spark, given, normalize_case=True, strip_ids=True, ns="NS")
    row = result.column_lineage.first()
    assert row.output_column == "mart.out.t@ns" and row.expression == "f(Amount)"
    assert result.table_edges.first().input_table == "raw.a@ns"


def test_namespace_case_of_columns(spark):
    result = derive(spark, write(1, projections=[entry(0, "Id", 1)]), ns="NS")
    row = result.column_lineage.first()
    assert row.input_columns == ["raw.a.id@ns"] and row.output_column == "mart.Out.id@NS"


def test_accepted_relations_are_configurable(spark):
    file_based = leaf(0, "F", [column(1, "Id")], kind="LogicalRelation")
    given = [
        write(1, inputs=[file_based], projections=[entry(0, "Id", 1)]),
        write(2, inputs=[file_based], query_root="LogicalRelation"),
    ]
    accepted = ("HiveTableRelation", "LogicalRelation")
    found = columns_of(derive(spark, *given, accepted=accepted))
    assert sorted(found) == [(1, "mart.Out.id@5k"), (2, "mart.Out.id@5k")]


def test_nested_and_flat_forms_agree(spark):
    given = records(spark, write(1, projections=[entry(0, "Id", 1), entry(1, "T", 9, "f(1)")]))
    again = nest(unnest(given))
    assert again.select(given.columns).first() == given.first()


def test_records_as_json_messages(spark):
    given = records(spark, write(1, projections=[entry(0, "Id", 1)]))
    sent = given.select(F.to_json(F.struct("*")).cast("binary").alias("value"))
    noise = spark.createDataFrame([(b"not json",), (b"{}",), (None,)], sent.schema)
    received = sent.unionByName(noise)
    assert parse_records(received).collect() == given.collect()
    assert unparsed_records(received).count() == 3


def test_acting_user(spark):
    rows = [(1, "run", "login"), (2, "", "login"), (3, None, ""), (4, None, None)]
    given = spark.createDataFrame(rows, "write_id int, run_user string, login_user string")
    found = writes.with_user(given, "proc").orderBy("write_id").collect()
    assert [r.user for r in found] == ["run", "login", "proc", "proc"]


def test_plan_nodes(spark):
    rows = [
        (1, 1, None, "UnionExec", None),
        (1, 2, 1, "DataWritingCommandExec", 70),
        (1, 3, 1, "FilterExec", None),
        (1, 4, 3, "DataWritingCommandExec", 71),
        (2, 1, None, "WriteToDataSourceV2Exec", None),
        (3, 1, None, "ProjectExec", None),
    ]
    schema = "query_id int, node_id int, parent_id int, node_class string, write_id int"
    nodes = spark.createDataFrame(rows, schema)
    counts = {r.query_id: r.n_writes for r in writes.write_counts(nodes).collect()}
    assert counts == {1: 3, 2: 0, 3: 0}
    found = sorted(r.write_id for r in writes.write_commands(nodes).collect())
    assert found == [70, 70, 71]


def test_numeric_nulls(spark):
    given = spark.createDataFrame(
        [(None, None, None, None)], "a int, b double, c string, d decimal(5,2)"
    )
    row = statements.fill_numeric_nulls(given).first()
    assert (row.a, row.b, row.c, row.d) == (0, 0.0, None, 0)
