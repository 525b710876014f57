"""Session settings, the shared folder, and intermediate tables in it."""

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def builder(app_name: str = "spoor"):
    """A session builder with the settings the jobs are designed for."""
    session = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        session = session.config(key, value)
    return session


def shared_folder(spark: SparkSession) -> str:
    """A new folder on the storage all executors share.

    The cluster names it in ``spark.checkpoint.dir``; where that is unset, it lies in
    the warehouse, which driver and executors share as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    name = spark.sql("SELECT uuid()").first()[0]
    return f"{root.rstrip('/')}/spoor-{name}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, folder: str) -> DataFrame:
    """``df`` as a table in ``folder``, made by an execution of its own.

    Its shuffle files go when it ends, and not when the driver happens to collect its memory,
    so that what follows does not find them on the disks.
    """
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)
