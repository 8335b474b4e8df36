"""Replaying rejected records and dead-letter messages."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import json_text, timing
from tidemark.operators.matching import SPREAD, unmatched
from tidemark.schema import PREVIEW_CHARS, PREVIEW_ROWS, REJECT_RETENTION_DAYS
from tidemark.session import work_folder, written
from tidemark.sources import days, folders, records, rejects

_WRAPPED = "array<struct<kinesis: struct<data: string, sequenceNumber: string>>>"


# A replayed id in memory for each of its bytes in a file, and how many bytes of ids are sent to all tasks.
ID_GROWTH = 4
BROADCAST_BYTES = 64 * 1024 * 1024


def zone(replayed_root: str) -> days.Zone:
    return days.Zone(replayed_root, ("rejected_date",))


def unwrap(messages: DataFrame) -> DataFrame:
    """Event payloads held in dead-letter bodies: one row per payload.

    A wrapper (`requestContext` present) gives every record it carries, decoded;
    a wrapper without records and any other JSON give the body itself; a body
    that is not JSON gives no payload (`payload` NULL, so that it can be kept).
    """
    body = F.col("body")
    wrapped = messages.withColumn(
        "_records",
        F.when(
            json_text.starts_object(body) & F.array_contains(F.json_object_keys(body), "requestContext"),
            F.from_json(F.get_json_object(body, "$.requestPayload.Records"), _WRAPPED),
        ),
    )
    has_records = F.size(F.coalesce("_records", F.array().cast(_WRAPPED))) > 0
    one_each = wrapped.withColumn("_has", has_records).withColumn(
        "_record", F.explode_outer(F.when(F.col("_has"), F.col("_records")))
    )
    itself = F.when(json_text.is_json_value(body), body)
    kinesis = F.col("_record.kinesis")
    return one_each.select(
        *messages.columns,
        kinesis["sequenceNumber"].alias("original_sequence"),
        F.when(F.col("_has"), json_text.decode_data(kinesis["data"])).otherwise(itself).alias("payload"),
    )


def sendable(rejects: DataFrame) -> DataFrame:
    """Rejects whose body is JSON. The others would only fill every drain."""
    return rejects.where(json_text.is_json_value(F.col("body")))


def to_messages(unwrapped: DataFrame, id_column: str = "reject_id", also=()) -> DataFrame:
    """Keyed messages to publish again: by user, else by the reject's own id. `also` are columns to keep."""
    user = F.get_json_object("payload", "$.user_id")
    return unwrapped.where(F.col("payload").isNotNull()).select(
        id_column,
        F.coalesce(user, F.concat(F.lit("replay-"), F.col(id_column).cast("string"))).alias("key"),
        json_text.json_line(F.col("payload")).alias("value"),
        *also,
    )


def preview(unwrapped: DataFrame, id_column: str = "reject_id") -> DataFrame:
    """The first few payloads, cut short, as a replay would send them."""
    return (
        unwrapped.where(F.col("payload").isNotNull())
        .orderBy(id_column, "payload")
        .limit(PREVIEW_ROWS)
        .select(id_column, F.left("payload", F.lit(PREVIEW_CHARS)).alias("sample"))
    )


def dry_run(unwrapped: DataFrame, id_column: str = "reject_id") -> dict:
    """Counts and samples; sends nothing."""
    sent = unwrapped.where(F.col("payload").isNotNull())
    return {"sent": 0, "failed": 0, "dry_run": sent.count(), "samples": preview(unwrapped, id_column)}


def replay(
    drained: DataFrame, replayed_root: str, replayed_at, path=None, fmt: str = "json", options=None
) -> dict:
    """Send drained rejects to a target and note which ids went out.

    The messages are written out first, so that what is sent and what is noted
    are the same rows. A send that dies halfway is noted nowhere and goes out
    again; the transform and the load drop what arrives twice. Ids are noted
    under the day of their reject, or of the replay where that is unknown.
    """
    spark = drained.sparkSession
    folder = work_folder(spark, "replay")
    try:
        at = timing.as_of_column(replayed_at)
        rejected = F.coalesce("rejected_at", at) if "rejected_at" in drained.columns else at
        dated = unwrap(drained.withColumn("rejected_date", F.to_date(rejected)))
        messages = written(to_messages(dated, also=["rejected_date"]), folder)
        result = records.send(messages, path, fmt, options)
        noted = messages.select("reject_id", "rejected_date").distinct().withColumn("replayed_at", at)
        noted.write.mode("append").partitionBy("rejected_date").parquet(replayed_root)
    finally:
        folders.remove(spark, folder)
    return result


def replayed(spark: SparkSession, root: str, since=None) -> tuple[DataFrame, int]:
    """Ids replayed so far, only of rejects since a day if given, and the size of their files.

    Retired days are left out. Files written before ids had dates lie in the root itself and are always read.
    """
    bounds = [d for d in (since, days.first_in_use(spark, zone(root))) if d is not None]
    chosen = [f for d, f in sorted(zone(root).held(spark).items()) if all(d >= first for first in bounds)]
    chosen += [f"{root}/{n}" for n in folders.names(spark, root) if n[0] not in "_." and "=" not in n]
    if not chosen:
        return spark.createDataFrame([], "reject_id string"), 0
    return spark.read.schema("reject_id string").parquet(*chosen), sum(folders.size(spark, f) for f in chosen)


def remaining(rejects: DataFrame, replayed: DataFrame, file_bytes: int | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Rejects not yet replayed, by id. Ids whose files have a known small size go to all tasks."""
    ids = replayed.select("reject_id").distinct()
    if file_bytes is not None and file_bytes * ID_GROWTH <= limit:
        return unmatched(rejects, F.broadcast(ids), "reject_id")
    return unmatched(rejects, ids, "reject_id", SPREAD)


def open_rejects(spark: SparkSession, root: str) -> DataFrame:
    """Stored rejects that are in use and not yet replayed; ids of earlier days than theirs are not read."""
    ids, size = replayed(spark, f"{root}/replayed", min(rejects.zone(root).held(spark), default=None))
    return remaining(rejects.read(spark, root), ids, size)


def expire(rejects: DataFrame, as_of=None, days: int = REJECT_RETENTION_DAYS) -> DataFrame:
    """Rejects still within their retention."""
    return rejects.where(F.col("rejected_at") >= timing.as_of_column(as_of) - timing.days(days))
