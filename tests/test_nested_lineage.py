"""Records resolved in their rows against the joins of the flat tables."""

from captures import column, entry, leaf, records, write
from pyspark.sql import functions as F
from spoor.plans.harvest import harvest, harvest_records
from spoor.sources import capture
from spoor.sources.capture import nest, unnest
from workload import fixtures as fx

TABLES = ("table_edges", "table_lineage", "column_lineage", "column_edges", "rejected", "unsupported")


def flat(df):
    """Rows as text, columns in order of their names."""
    return sorted(str([(k, row[k]) for k in sorted(row)]) for row in (r.asDict(True) for r in df.collect()))


def same(given, **options):
    one, other = harvest_records(given, **options), harvest(unnest(given), **options)
    for name in TABLES:
        assert flat(getattr(one, name)) == flat(getattr(other, name)), name
    as_text = F.to_json(F.struct("entities")).alias("text")
    bundles = [h.bundles.select("write_id", "msg_key", as_text).orderBy("write_id") for h in (one, other)]
    assert flat(bundles[0]) == flat(bundles[1])


def test_same_as_joins(spark, small_dir, tmp_path):
    nest(fx.capture(spark, small_dir)).write.parquet(str(tmp_path / "records"))
    given = spark.read.parquet(str(tmp_path / "records"))
    same(given, dedupe=False, strip_ids=True, normalize_case=True, ns="Prod")


def test_same_on_hand_made_records(spark):
    two = [leaf(0, "A", [column(1, "Id"), column(2, "x y")]), leaf(1, "A", [column(1, "Id"), column(3, "Id")])]
    other = leaf(2, "Logical", [column(9, "z")], kind="LogicalRelation")
    entries = [
        entry(0, "Id", 1),
        entry(1, "none", 77),
        entry(2, "calc", 50, "f(x y#2, Id#1, z#9, 1)", [2, 1, 9, None, 1]),
        entry(3, "one", 51, "x y#2", [2]),
        entry(4, "empty", 52, "rand(7)", []),
        entry(5, "z", 9),
    ]
    given = records(
        spark,
        write(1, inputs=[*two, other], projections=entries),
        write(2, inputs=[other], projections=entries),
        write(3, inputs=[], projections=entries),
        write(4, inputs=[two[1]], query_root="HiveTableRelation", projections=None),
        write(5, inputs=[leaf(0, "B", [column(4, "k"), column(3, "k"), column(5, "j")])], query_root="HiveTableRelation"),
        write(6, inputs=two, query_root="Aggregate"),
        write(7, status="failure"),
        write(8, command_class="Other"),
        write(9, sql_text=None, out_db=None, projections=entries),
    )
    same(given)
    same(given, accepted=("HiveTableRelation", "LogicalRelation"))
    empty = harvest_records(given.filter(F.lit(False)))
    assert all(getattr(empty, name).count() == 0 for name in (*TABLES, "bundles"))


def test_nothing_is_shuffled_behind_a_record(spark, small_dir, tmp_path):
    capture.write_records(nest(fx.capture(spark, small_dir)), str(tmp_path / "records"))
    found = harvest_records(capture.read_records(spark, str(tmp_path / "records")), dedupe=False)
    for name in (*TABLES, "bundles"):
        text = getattr(found, name)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "Join" not in text, name
        assert text.count("FileScan") == 1, name
        if name != "unsupported":
            pushed = text.split("PushedFilters: [")[1]
            assert "EqualTo(status,success)" in pushed and "In(command_class, [" in pushed, name


def test_a_repeated_record_counts_once(spark):
    given = records(spark, write(1, projections=[entry(0, "Id", 1)]), write(1, projections=[entry(0, "Id", 1)]))
    found = harvest_records(given)
    assert found.column_lineage.count() == found.table_edges.count() == found.bundles.count() == 1


def test_a_wide_record(spark):
    n = 3000
    wide = leaf(0, "Wide", [column(k, f"c{k}") for k in range(n)])
    entries = [entry(k, f"o{k}", 10**6 + k, f"f(c{k}#{k}, c7#7)", [k, 7]) for k in range(n)]
    found = harvest_records(records(spark, write(0, inputs=[wide], projections=entries))).column_lineage
    assert found.count() == n
    assert found.filter("out_pos = 5").first().input_columns == ["raw.wide.c5@5k", "raw.wide.c7@5k"]
