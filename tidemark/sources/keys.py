"""Sequence numbers already processed by bounded runs, with their time to live."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import timing
from tidemark.operators.dedupe import live_keys
from tidemark.schema import KEY_MEMORY_SECONDS, SEEN_KEY_SCHEMA
from tidemark.sources import days, folders

_STORED = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in SEEN_KEY_SCHEMA) + ", key_date date, run_id string"


def zone(root: str) -> days.Zone:
    return days.Zone(root, ("key_date",))


def read(spark: SparkSession, root: str, as_of=None, without_run: str | None = None) -> DataFrame:
    """Keys still remembered; older dates are not opened.

    `without_run` leaves out what one run wrote, so that it can be repeated.
    """
    if not folders.names(spark, root):
        return spark.createDataFrame([], SEEN_KEY_SCHEMA)
    stored = days.in_use(spark.read.schema(_STORED).parquet(root), zone(root))
    first = timing.as_of_column(as_of) - timing.seconds(KEY_MEMORY_SECONDS)
    stored = stored.where(F.col("key_date") >= F.to_date(first))
    if without_run is not None:
        stored = stored.where(F.col("run_id") != without_run)
    return live_keys(stored, as_of).select(*SEEN_KEY_SCHEMA.fieldNames())


def add(keys: DataFrame, root: str, run_id: str) -> None:
    """Store the keys of one run; a repeated run replaces its own."""
    (
        keys.withColumn("key_date", F.to_date(F.timestamp_seconds("processed_at")))
        .withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("key_date", "run_id")
        .parquet(root)
    )
