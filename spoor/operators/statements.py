"""Which statement text an execution belongs to, and null filling."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from spoor.functions.times import epoch_micros
from spoor.operators.spread import unbroadcast

HOUR = 3600


def statement_context(parse: DataFrame, execs: DataFrame, slice_seconds: int = HOUR) -> DataFrame:
    """Every execution with the text last parsed on its thread, null when there is none.

    ``parse`` has ``thread_id, ts, event_id, sql_text``; ``execs`` has ``thread_id, ts,
    event_id`` and more. A parse at the very time of an execution counts.

    The history of a thread is cut into time slices, so a busy thread is many tasks.
    Inside a slice a window finds the last text; an execution before the slice's first
    parse takes the text carried in from earlier slices, which is a window over one row
    per thread and slice.
    """

    def sliced(df: DataFrame) -> DataFrame:
        at = epoch_micros(df, "ts")
        return df.withColumn("_slice", F.floor(at / F.lit(slice_seconds * 1_000_000)))

    rest = [name for name in execs.columns if name not in ("thread_id", "ts", "event_id")]
    parse = sliced(parse.select("thread_id", "ts", "event_id", "sql_text"))
    execs = sliced(execs)
    is_parse = F.col("_kind") == 0
    rows = parse.withColumn("_kind", F.lit(0)).unionByName(
        execs.withColumn("_kind", F.lit(1)), allowMissingColumns=True
    )

    ordered = (
        W.partitionBy("thread_id", "_slice")
        .orderBy("ts", "_kind", "event_id")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    within = (
        rows.withColumn("_within", F.last("sql_text", ignorenulls=True).over(ordered))
        .filter(~is_parse)
        .drop("sql_text", "_kind")
    )

    latest = F.max_by("sql_text", F.struct("ts", "event_id"))
    slices = (
        execs.select("thread_id", "_slice")
        .distinct()
        .withColumn("_kind", F.lit(0))
        .unionByName(
            parse.groupBy("thread_id", "_slice").agg(latest.alias("_latest"), F.lit(1).alias("_kind")),
            allowMissingColumns=True,
        )
    )
    # The row of the executions comes first, so a slice's own parses are not earlier.
    earlier = (
        W.partitionBy("thread_id")
        .orderBy("_slice", "_kind")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    carried = (
        slices.withColumn("_carried", F.last("_latest", ignorenulls=True).over(earlier))
        .filter(F.col("_kind") == 0)
        .drop("_latest", "_kind")
    )
    return within.join(unbroadcast(carried), ["thread_id", "_slice"], "left").select(
        "event_id",
        "thread_id",
        "ts",
        *rest,
        F.coalesce("_within", "_carried").alias("sql_text"),
    )


def fill_numeric_nulls(df: DataFrame) -> DataFrame:
    """Nulls in numeric columns become 0; other columns stay."""
    numeric = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.na.fill(0.0, subset=numeric) if numeric else df
