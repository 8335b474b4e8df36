"""Pipeline health: metric series, backlog, and shard load."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import measures, timing
from tidemark.operators import alarms
from tidemark.schema import BAND_RED_PCT, BAND_YELLOW_PCT, SHARD_RECORDS_PER_SECOND

INCOMING = "IncomingRecords"
THROTTLES = "WriteProvisionedThroughputExceeded"


def incoming_per_minute(records: DataFrame) -> DataFrame:
    return records.groupBy(F.date_trunc("minute", "arrival_ts").alias("minute")).agg(
        F.count(F.lit(1)).alias("incoming_records")
    )


def batch_counts(batch_log: DataFrame) -> DataFrame:
    """Batches and failed batches per minute."""
    return batch_log.groupBy(F.date_trunc("minute", "started_at").alias("minute")).agg(
        F.count(F.lit(1)).alias("batches"), F.sum("failed").alias("failed_batches")
    )


def batch_durations(batch_log: DataFrame) -> DataFrame:
    """Median and 99th percentile of batch time per minute. The log has one row per batch."""
    points = F.percentile("duration_ms", F.array(F.lit(0.5), F.lit(0.99)))
    return (
        batch_log.groupBy(F.date_trunc("minute", "started_at").alias("minute"))
        .agg(points.alias("_p"))
        .select(
            "minute",
            measures.settled(F.get("_p", F.lit(0)), 1).alias("p50_ms"),
            measures.settled(F.get("_p", F.lit(1)), 1).alias("p99_ms"),
        )
    )


def delivery_freshness(delivered: DataFrame, arrival="arrival_ts", delivery="delivered_at") -> DataFrame:
    """Longest wait from arrival to delivery per delivery minute, in whole seconds."""
    wait = timing.seconds_between(F.col(arrival), F.col(delivery))
    return delivered.groupBy(F.date_trunc("minute", delivery).alias("minute")).agg(
        F.max(wait).alias("max_wait_seconds")
    )


def reject_backlog(rejected: DataFrame, replayed: DataFrame, period_seconds: int = 300) -> DataFrame:
    """Most rejects waiting at any minute of each period, periods without change included.

    The windows without a key run over one row per minute with a change, and
    one per period: their size follows the time span, not the rejects.
    """
    arrivals = rejected.select(F.date_trunc("minute", "rejected_at").alias("minute"), F.lit(1).alias("change"))
    leavings = replayed.select(F.date_trunc("minute", "replayed_at").alias("minute"), F.lit(-1).alias("change"))
    changes = arrivals.unionByName(leavings).groupBy("minute").agg(F.sum("change").alias("change"))

    so_far = Window.orderBy("minute").rowsBetween(Window.unboundedPreceding, 0)
    running = changes.withColumn("waiting", F.sum("change").over(so_far))
    active = running.groupBy(timing.floor_period(F.col("minute"), period_seconds).alias("period")).agg(
        F.max("waiting").alias("peak"), F.max_by("waiting", "minute").alias("closing")
    )
    in_order = Window.orderBy("period")
    step = timing.seconds(period_seconds)
    last = F.coalesce(F.lead("period").over(in_order) - step, F.col("period"))
    opening = F.coalesce(F.lag("closing").over(in_order), F.lit(0))
    # Quiet periods up to the next change hold what the changed one ended with.
    spread = active.select(
        "closing", F.greatest(opening, "peak").alias("highest"), F.sequence("period", last, step).alias("each")
    )
    return spread.select("closing", "highest", F.posexplode("each").alias("n", "period")).select(
        "period", F.when(F.col("n") == 0, F.col("highest")).otherwise(F.col("closing")).alias("backlog")
    )


# --- shards -----------------------------------------------------------------


def shard_of(key, shards: int = 10):
    """Shard number of a partition key: a stable hash, the same in any engine."""
    return F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(shards))


def shard_points(records: DataFrame, period_seconds: int = 60, cap: int = SHARD_RECORDS_PER_SECOND) -> DataFrame:
    """Datapoints per shard and period: records in, and records over the cap."""
    counted = records.groupBy(
        "shard_id", timing.floor_period(F.col("arrival_ts"), period_seconds).alias("period")
    ).agg(F.count(F.lit(1)).alias("n"))
    values = F.array(
        F.struct(F.lit(INCOMING).alias("metric"), F.col("n").cast("double").alias("value")),
        F.struct(
            F.lit(THROTTLES).alias("metric"),
            F.greatest(F.col("n") - F.lit(cap * period_seconds), F.lit(0)).cast("double").alias("value"),
        ),
    )
    return counted.select("shard_id", "period", F.inline(values))


def open_shards(shards: DataFrame) -> DataFrame:
    """Shards without an ending sequence number."""
    return shards.where(F.col("ending_sequence_number").isNull())


def latest_points(points: DataFrame, as_of=None, period_seconds: int = 60, periods: int = 2) -> DataFrame:
    """Newest value per shard of each metric within the last periods, 0 if none."""
    now = timing.as_of_column(as_of)
    recent = points.where(
        (F.col("period") >= now - timing.seconds(period_seconds * periods)) & (F.col("period") <= now)
    )
    wide = recent.groupBy("shard_id").agg(
        *[
            F.max_by(F.when(F.col("metric") == m, F.col("value")),
                     F.when(F.col("metric") == m, F.col("period"))).alias(m)
            for m in (INCOMING, THROTTLES)
        ]
    )
    return wide.fillna(0.0)


def shard_utilisation(
    shards: DataFrame, latest: DataFrame, period_seconds: int = 60, cap: int = SHARD_RECORDS_PER_SECOND
) -> DataFrame:
    """Rate, share of the cap, colour band and throttles of every open shard."""
    joined = open_shards(shards).select("shard_id").join(latest, "shard_id", "left").fillna(0.0)
    rate = F.col(INCOMING) / F.lit(float(period_seconds))
    pct = F.least(rate / F.lit(float(cap)), F.lit(1.0)) * F.lit(100.0)
    return (
        joined.withColumns({"records_per_second": rate, "utilisation_pct": pct})
        .withColumn(
            "band",
            F.when(F.col("utilisation_pct") < BAND_YELLOW_PCT, "green")
            .when(F.col("utilisation_pct") < BAND_RED_PCT, "yellow")
            .otherwise("red"),
        )
        .select("shard_id", "records_per_second", "utilisation_pct", "band", F.col(THROTTLES).alias("throttles"))
        .orderBy("shard_id")
    )


# --- the alarm table's input -------------------------------------------------


def pipeline_metrics(records: DataFrame, rejected: DataFrame, replayed: DataFrame, delivered: DataFrame) -> DataFrame:
    """All alarmed metrics as one frame of (metric, period, value)."""
    points = shard_points(records).where(F.col("metric") == INCOMING)
    per_shard = points.select(
        F.concat(F.lit("records_per_second_per_shard/"), F.col("shard_id").cast("string")).alias("metric"),
        "period",
        (F.col("value") / 60.0).alias("value"),
    )
    errors = alarms.series(rejected, "errors", "rejected_at", F.count(F.lit(1)))
    backlog = reject_backlog(rejected, replayed).select(
        F.lit("reject_backlog").alias("metric"), "period", F.col("backlog").cast("double").alias("value")
    )
    freshness = delivery_freshness(delivered).select(
        F.lit("delivery_freshness_seconds").alias("metric"),
        F.col("minute").alias("period"),
        F.col("max_wait_seconds").cast("double").alias("value"),
    )
    return per_shard.unionByName(errors).unionByName(backlog).unionByName(freshness)
