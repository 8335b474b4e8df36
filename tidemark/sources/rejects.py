"""Rejected records: kept with their original data until replayed or expired."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidemark.schema import REJECT_SCHEMA
from tidemark.sources import days
from tidemark.sources.landing import HOUR_PARTS

DAY_PARTS = ("year", "month", "day")
PARTITIONS = (*DAY_PARTS, "error_type", "batch_id")

_STORED = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in REJECT_SCHEMA)
_PARTS = "year string, month string, day string, error_type string, batch_id string"


def as_rejects(bad: DataFrame, rejected_at) -> DataFrame:
    """Reject rows from checked records.

    `body` is the decoded text, or the data as base64 when it could not be
    decoded. The id is drawn from the row's content and time, so a retried
    batch gives the same ids.
    """
    as_bytes = isinstance(bad.schema["data"].dataType, BinaryType)
    body = F.coalesce("raw", F.base64("data") if as_bytes else F.col("data"))
    at = rejected_at
    return bad.select(
        F.sha2(F.concat_ws("|", "sequence_number", body, at.cast("string")), 256).alias("reject_id"),
        "sequence_number",
        body.alias("body"),
        "error",
        at.alias("rejected_at"),
        "error_type",
    )


def store(rejects: DataFrame, root: str, batch_id="0") -> None:
    """Write rejects under `<root>/errors/year=/month=/day=/error_type=/batch_id=`."""
    parts = {name: F.date_format("rejected_at", HOUR_PARTS[name]) for name in DAY_PARTS}
    (
        rejects.withColumns(parts)
        .withColumn("batch_id", F.lit(str(batch_id)))
        .hint("rebalance", *DAY_PARTS, "error_type")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy(*PARTITIONS)
        .json(f"{root}/errors")
    )


def zone(root: str) -> days.Zone:
    return days.Zone(f"{root}/errors")


def read(spark: SparkSession, root: str) -> DataFrame:
    """Rejects of the days that aren't retired."""
    return days.in_use(spark.read.schema(f"{_STORED}, {_PARTS}").json(f"{root}/errors"), zone(root))


def drain(rejects: DataFrame, limit: int | None = None) -> DataFrame:
    """All rejects, or the `limit` oldest."""
    if limit is None:
        return rejects
    return rejects.orderBy("rejected_at", "reject_id").limit(limit)


def by_type(rejects: DataFrame) -> DataFrame:
    return rejects.groupBy("error_type").agg(F.count(F.lit(1)).alias("rejects"))
