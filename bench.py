"""Time the headline queries; prints one JSON line.

Lineage is derived from a stored capture: nested records of the writes in the test tables,
made before the clock runs. Other queries read the test tables.

BENCH_SF_DIR: folder of the test tables (default /root/testdata/sf0.1)
BENCH_CPUS: local cores (default 8)
BENCH_QUERIES: comma-separated names, or "all"
"""

import json
import os
import sys
import time

from pyspark.sql import functions as F

from spoor.functions import names
from spoor.operators.entities import hook_notifications
from spoor.plans.harvest import harvest_records, messages_of
from spoor.session import builder, shared_folder
from spoor.sources.capture import nest, read_records, write_records
from workload import fixtures, registry
from workload.message_queries import RUN_ID, received

HEADLINE = (
    "statement_context",
    "process_names",
    "table_lineage_records",
    "column_lineage",
    "column_edges",
    "entity_bundles",
    "envelopes",
    "split_messages",
    "reassembled_messages",
    "published_lineage",
)


def process_names(found):
    name = names.process_name(F.col("sorted_inputs"), F.col("write_mode"), F.col("output_table"))
    return found.named.select("write_id", "output_table", name.alias("process_name"))


def published(found):
    asked = hook_notifications(found.bundles, "spark")
    return received(asked.sparkSession, messages_of(asked, RUN_ID, "10.0.0.1", "spark", 1700000000000, 2000))


STORED = {
    "process_names": process_names,
    "table_lineage_records": lambda found: found.table_lineage,
    "column_lineage": lambda found: found.column_lineage,
    "column_edges": lambda found: found.column_edges,
    "entity_bundles": lambda found: found.bundles,
    "published_lineage": published,
}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE))
    names = sorted(registry.QUERIES) if wanted == "all" else wanted.split(",")
    spark = (
        builder("bench")
        .master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    stored: dict[str, str] = {}

    def captured(folder: str) -> str:
        if folder not in stored:
            stored[folder] = shared_folder(spark)
            write_records(nest(fixtures.capture(spark, folder)), stored[folder])
        return stored[folder]

    def query(name: str, folder: str):
        if name in STORED:
            return STORED[name](harvest_records(read_records(spark, captured(folder)), dedupe=False))
        return registry.QUERIES[name](spark, folder)

    def run(name: str, folder: str) -> float:
        if name in STORED:
            captured(folder)
        began = time.perf_counter()
        query(name, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    # Load classes, compile plans and start Python workers before the clock runs.
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    for name in names:
        run(name, small if os.path.isdir(small) else sf_dir)
    seconds = {}
    for name in names:
        seconds[name] = run(name, sf_dir)
        print(name, seconds[name], file=sys.stderr)
    writes = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    spark.stop()
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "captured_writes": writes,
                "capture": "stored",
            }
        )
    )


if __name__ == "__main__":
    main()
