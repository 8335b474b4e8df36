"""Batch deduplication: by the keys already seen, and within one set."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import timing
from tidemark.operators.matching import unmatched
from tidemark.schema import KEY_MEMORY_SECONDS


def first_per_key(df: DataFrame, keys, order) -> DataFrame:
    """One row per key: the first in the given order.

    A rank-1 filter makes Spark keep one row per key in every input task
    before the shuffle (WindowGroupLimit), so a key with a huge number of
    copies sends few rows to its final task.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).where("_rank = 1").drop("_rank")


def newest_per_event(events: DataFrame) -> DataFrame:
    """The newest row of every event id."""
    return first_per_key(
        events, "event_id", [F.desc_nulls_last("event_ts"), F.desc_nulls_last("kinesis_seq")]
    )


def record_key(records: DataFrame):
    """What tells one record from another: its sequence number, else what it holds and where it stood.

    A record without a number is told by a digest of its text, partition key, shard and arrival time. The same record
    delivered again has the same ones; equal events sent twice differ in the last. The mark in front is part of no
    number. Null and empty parts differ in the digest.
    """
    place = [F.col(c).cast("string") for c in ("partition_key", "shard_id", "arrival_ts") if c in records.columns]
    parts = [F.coalesce(F.concat(F.lit("="), c), F.lit("-")) for c in (F.col("raw"), *place)]
    sized = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.coalesce("sequence_number", F.concat(F.lit("\u0000"), F.sha2(F.concat(*sized), 256)))


def first_delivery(good: DataFrame) -> DataFrame:
    """The first delivery of every checked record, told by `record_key`."""
    keyed = good.withColumn("_key", record_key(good))
    return first_per_key(keyed, "_key", [F.asc_nulls_last("arrival_ts"), F.asc("raw")]).drop("_key")


def seen_keys(records: DataFrame, processed_at, memory_seconds: int = KEY_MEMORY_SECONDS) -> DataFrame:
    """Key rows to remember for processed records, one per key; it stands in the column of the number.

    Records need their text where they lack a number.
    """
    at = F.unix_timestamp(processed_at)
    keyed = records.withColumn("sequence_number", record_key(records)) if "raw" in records.columns else records
    return keyed.groupBy("sequence_number").agg(F.min(at).alias("processed_at")).withColumn(
        "ttl", F.col("processed_at") + F.lit(memory_seconds)
    )


def live_keys(keys: DataFrame, as_of=None) -> DataFrame:
    """Keys whose memory has not run out."""
    return keys.where(F.col("ttl") > F.unix_timestamp(timing.as_of_column(as_of)))


def drop_seen(good: DataFrame, keys: DataFrame, as_of=None) -> DataFrame:
    """First deliveries whose key is not among the live keys.

    A second copy in the same set is a repeat of the first, so copies are
    reduced before the lookup and no key is frequent in the join.
    """
    first = first_delivery(good)
    keyed = first.withColumn("_key", record_key(first))
    known = live_keys(keys, as_of).select(F.col("sequence_number").alias("_key"))
    return unmatched(keyed, known, "_key").drop("_key")


def remember(keys: DataFrame, new: DataFrame, as_of=None) -> DataFrame:
    """Live keys with new ones added; the first writer of a key wins."""
    both = live_keys(keys, as_of).unionByName(new)
    return both.groupBy("sequence_number").agg(
        F.min("processed_at").alias("processed_at"), F.min_by("ttl", "processed_at").alias("ttl")
    )


def batch_counters(checked: DataFrame) -> DataFrame:
    """One row: records received, processed, skipped as repeats, and in error."""
    is_good = F.col("error_type").isNull()
    counts = checked.agg(
        F.count(F.lit(1)).alias("received"),
        F.countDistinct(F.when(is_good, record_key(checked))).alias("processed"),
        F.count_if(~is_good).alias("errors"),
    )
    return counts.withColumn("skipped", F.col("received") - F.col("processed") - F.col("errors"))
