"""The landing zone: gzip JSON lines under year/month/day/hour of delivery."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrich import flatten
from tidemark.schema import EVENT_RETENTION_DAYS
from tidemark.sources import days, folders

HOUR_PARTS = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}

_TEXT_SCHEMA = "value string, year string, month string, day string, hour string, batch_id string"


def _parts(ts, names) -> dict:
    return {name: F.date_format(ts, HOUR_PARTS[name]) for name in names}


def land(
    lines: DataFrame,
    root: str,
    batch_id="0",
    delivered: str = "delivered_at",
    max_lines: int = 250_000,
    rebalance: bool = True,
) -> None:
    """Write `line` under `<root>/events/year=/month=/day=/hour=/batch_id=`.

    Rows are rebalanced by hour, so each hour gets few files and an hour that
    holds most rows is split into several; leave that out where partitions
    already have a good size and one hour each. Writing the same batch again
    replaces its own folders only, which makes a retried batch harmless.
    `max_lines` bounds a file: 250,000 lines of ~500 bytes are ~128 MB.
    """
    parts = _parts(F.col(delivered), HOUR_PARTS)
    out = lines.select(F.col("line").alias("value"), *[v.alias(k) for k, v in parts.items()])
    out = out.withColumn("batch_id", F.lit(str(batch_id)))
    if rebalance:
        out = out.hint("rebalance", *HOUR_PARTS)
    (
        out.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max_lines)
        .partitionBy(*HOUR_PARTS, "batch_id")
        .text(f"{root}/events")
    )


def land_parquet(lines: DataFrame, root: str, batch_id="0", delivered: str = "delivered_at") -> None:
    """The same layout with the fact columns as parquet."""
    parts = _parts(F.col(delivered), HOUR_PARTS)
    flat = flatten(lines.select("line", delivered), loaded_at=F.col(delivered)).drop("line")
    (
        flat.withColumns(parts)
        .withColumn("batch_id", F.lit(str(batch_id)))
        .drop(delivered)
        .hint("rebalance", *HOUR_PARTS)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*HOUR_PARTS, "batch_id")
        .parquet(f"{root}/events")
    )


def zone(root: str) -> days.Zone:
    return days.Zone(f"{root}/events")


def read_lines(spark: SparkSession, root: str, year=None, month=None, day=None, hour=None, batch_id=None) -> DataFrame:
    """Landed lines as `line`, `file` and the partition columns.

    Given parts become partition filters: other folders are not read.
    """
    lines = days.in_use(spark.read.schema(_TEXT_SCHEMA).text(f"{root}/events"), zone(root))
    for name, value in (("year", year), ("month", month), ("day", day), ("hour", hour)):
        if value is not None:
            width = 4 if name == "year" else 2
            lines = lines.where(F.col(name) == str(value).zfill(width))
    if batch_id is not None:
        lines = lines.where(F.col("batch_id") == str(batch_id))
    return lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"), *HOUR_PARTS)


def read_prefix(spark: SparkSession, prefix: str) -> DataFrame:
    """Lines of every file below one folder, as `line` and `file`."""
    lines = spark.read.option("recursiveFileLookup", "true").text(prefix)
    return lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))


def stream_lines(spark: SparkSession, root: str, max_files: int = 1_000, below: str = "", options=None) -> DataFrame:
    """Landed lines as a stream of newly arrived files.

    Every trigger lists the folder, so on a zone that keeps a year of hours
    name the part that still fills, as in `below='year=2024/month=05/*'`.
    """
    lines = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files)
        .option("recursiveFileLookup", "true")
        .options(**(options or {}))
        .load(f"{root}/events/{below}".rstrip("/"))
    )
    return lines.select(F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"))


def expire(spark: SparkSession, root: str, today: dt.date, days: int = EVENT_RETENTION_DAYS, zone: str = "events") -> list:
    """Remove whole days older than the retention at once; returns the removed folders. `plans.retention` does it in two steps.

    Rejects go the same way with `zone='errors'` and their own retention.
    """
    first_kept = today - dt.timedelta(days=days)
    removed = []
    for year in folders.parts(spark, f"{root}/{zone}", "year"):
        for month in folders.parts(spark, f"{root}/{zone}/year={year}", "month"):
            base = f"{root}/{zone}/year={year}/month={month}"
            for day in folders.parts(spark, base, "day"):
                if dt.date(int(year), int(month), int(day)) < first_kept:
                    folders.remove(spark, f"{base}/day={day}")
                    removed.append(f"{base}/day={day}")
    return removed


def create_view(spark: SparkSession, root: str, name: str, ignore_case: bool = True) -> None:
    """A view with the fact columns straight over the landed files, without a load."""
    flat = flatten(read_lines(spark, root), loaded_at=F.lit(None).cast("timestamp"), ignore_case=ignore_case)
    flat.drop("line", "file").createOrReplaceTempView(name)
