"""Windowed reports on a stream, exact and to the last window.

Distinct users are exact: one stateful step keeps (window, user), the next counts the users of a window once the first
has closed it. Sliding windows are made from one row per minute and user, not from events. The lateness bound is an
argument: an event later than that is missing here, while the batch reports count it.

A window is written when the stream's time has passed its end by the lateness. A stream that has ended never gets
there by itself: `closing` adds a source of end marks to the events, and `close` writes one, so that the next bounded
run writes the windows still open.
"""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MARKS = "event_ts timestamp"


def closing(events: DataFrame, marks: str) -> DataFrame:
    """Events together with the end marks of a folder, to be given to one of the reports below."""
    spark = events.sparkSession
    spark.createDataFrame([], _MARKS).write.mode("append").parquet(marks)  # a source reads an existing folder
    ends = spark.readStream.schema(_MARKS).parquet(marks).withColumn("_end", F.lit(True))
    return events.withColumn("_end", F.lit(False)).unionByName(ends, allowMissingColumns=True)


def close(spark: SparkSession, marks: str, at: dt.datetime) -> None:
    """Say that no event before `at` will come any more."""
    spark.createDataFrame([(at,)], _MARKS).coalesce(1).write.mode("append").parquet(marks)


def _timed(events: DataFrame, lateness: str) -> DataFrame:
    """Events with their watermark; end marks move it and go."""
    timed = events.withWatermark("event_ts", lateness)
    if "_end" not in events.columns:
        return timed
    # The condition names the time, or it would be applied before marks have moved the watermark.
    return timed.where(F.when(~F.col("_end"), F.col("event_ts")).isNotNull()).drop("_end")


def _per_minute_and_user(events: DataFrame, lateness: str, error_type: str) -> DataFrame:
    return _timed(events, lateness).groupBy(F.window("event_ts", "1 minute").alias("w"), "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == error_type).alias("errors")
    )


def events_per_minute(events: DataFrame, lateness: str = "10 minutes", error_type: str = "error") -> DataFrame:
    users = _per_minute_and_user(events, lateness, error_type)
    return (
        users.groupBy(F.window(F.window_time("w"), "1 minute").alias("w"))
        .agg(
            F.sum("n").alias("event_count"),
            F.count("user_id").alias("unique_users"),
            F.sum("errors").alias("error_count"),
        )
        .select(F.col("w.start").alias("minute"), "event_count", "unique_users", "error_count")
    )


def revenue_by_hour(events: DataFrame, lateness: str = "10 minutes", event_type: str = "purchase") -> DataFrame:
    """End marks and other events move the time on as well, so an hour without a purchase after it is written too."""
    bought = F.col("event_type") == event_type
    return (
        _timed(events, lateness)
        .where(F.when(bought, F.col("event_ts")).isNotNull())
        .groupBy(F.window("event_ts", "1 hour").alias("w"))
        .agg(F.count(F.lit(1)).alias("purchase_count"), F.sum("value").alias("total_revenue"))
        .select(F.col("w.start").alias("hour"), "purchase_count", F.col("total_revenue").cast("double").alias("total_revenue"))
    )


def active_users_sliding(
    events: DataFrame, lateness: str = "10 minutes", width: str = "5 minutes", slide: str = "1 minute"
) -> DataFrame:
    users = _per_minute_and_user(events, lateness, "")
    windows = users.groupBy(F.window(F.window_time("w"), width, slide).alias("w"), "user_id").agg(F.sum("n").alias("n"))
    return (
        windows.groupBy(F.window(F.window_time("w"), slide).alias("last"))
        .agg(F.count("user_id").alias("active_users"), F.sum("n").alias("events"))
        .select(
            (F.col("last.end") - F.expr(f"interval {width}")).alias("window_start"), "active_users", "events"
        )
    )
