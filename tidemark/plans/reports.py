"""Operational reports over the fact table.

Each takes the events, the moment it is asked for (`as_of`, now by default) and
its look-back, and returns a frame. Groups are reduced in every task before
they are shuffled, distinct users by (group, user) first, so one busy minute,
page or user does not land whole in one task.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import measures, timing

FUNNEL_STEPS = ("page_view", "add_to_cart", "purchase")


def _recent(events, as_of, look_back, column="event_ts", closed=False) -> DataFrame:
    now = timing.as_of_column(as_of)
    return timing.since(events, column, now - look_back, now if closed else None)


def events_per_minute(events: DataFrame, as_of=None, hours: int = 1, error_type: str = "error") -> DataFrame:
    """Events, distinct users and errors per minute, newest first."""
    return (
        _recent(events, as_of, timing.hours(hours))
        .groupBy(F.date_trunc("minute", "event_ts").alias("minute"))
        .agg(
            F.count(F.lit(1)).alias("event_count"),
            F.countDistinct("user_id").alias("unique_users"),
            measures.count_where(F.col("event_type") == error_type).alias("error_count"),
        )
        .orderBy(F.desc("minute"))
    )


def top_event_types(events: DataFrame, as_of=None, hours: int = 24, top: int = 20) -> DataFrame:
    """Most frequent event types with distinct users and averages."""
    return (
        _recent(events, as_of, timing.hours(hours))
        .groupBy("event_type")
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            F.countDistinct("user_id").alias("unique_users"),
            measures.mean(F.col("duration_ms"), 1).alias("avg_duration_ms"),
            measures.mean(F.col("value"), 2).alias("avg_value"),
        )
        .orderBy(F.desc("total_events"), "event_type")
        .limit(top)
    )


def funnel(events: DataFrame, as_of=None, steps=FUNNEL_STEPS, since=None) -> DataFrame:
    """Users per step and conversion between steps, from the start of the day.

    Steps are not ordered in time: a user counts for every step type seen. Any number of steps may be
    given; their columns carry number and type unless there are three.
    """
    now = timing.as_of_column(as_of)
    start = F.date_trunc("day", now) if since is None else timing.as_of_column(since)
    if len(steps) == 3:
        names = ["step1_page_views", "step2_add_to_cart", "step3_purchase"]
        rates = ["view_to_cart_pct", "cart_to_purchase_pct"]
    else:
        names = [f"step{i}_{step}" for i, step in enumerate(steps, 1)]
        rates = [f"step{i}_to_step{i + 1}_pct" for i in range(1, len(steps))]
    reached = (
        timing.since(events, "event_ts", start)
        .groupBy("user_id")
        .agg(*[F.max(measures.flag(F.col("event_type") == s)).alias(n) for s, n in zip(steps, names)])
    )
    sums = reached.agg(*[F.sum(f"`{n}`").alias(n) for n in names])
    counts = [F.col(f"`{n}`") for n in names]
    return sums.select(
        *counts,
        *[measures.percent(to, of).alias(r) for of, to, r in zip(counts, counts[1:], rates)],
        measures.percent(counts[-1], counts[0]).alias("overall_conversion_pct"),
    )


def revenue_by_hour(events: DataFrame, as_of=None, days: int = 7, event_type: str = "purchase") -> DataFrame:
    """Purchases, revenue and average order value per hour, newest first."""
    return (
        _recent(events, as_of, timing.days(days))
        .where(F.col("event_type") == event_type)
        .groupBy(F.date_trunc("hour", "event_ts").alias("hour"))
        .agg(
            F.count(F.lit(1)).alias("purchase_count"),
            measures.total(F.col("value")).alias("total_revenue"),
            measures.mean(F.col("value"), 2).alias("avg_order_value"),
        )
        .orderBy(F.desc("hour"))
    )


def duplicate_events(events: DataFrame, as_of=None, hours: int | None = 1, top: int | None = 50) -> DataFrame:
    """Event ids loaded more than once; `hours=None` looks at the whole table."""
    if hours is not None:
        events = _recent(events, as_of, timing.hours(hours), column="loaded_at")
    repeated = (
        events.groupBy("event_id")
        .agg(
            F.count(F.lit(1)).alias("occurrences"),
            F.min("event_ts").alias("first_seen"),
            F.max("event_ts").alias("last_seen"),
            F.min("loaded_at").alias("first_loaded"),
            F.max("loaded_at").alias("last_loaded"),
        )
        .where("occurrences > 1")
    )
    if top is None:
        return repeated
    return repeated.orderBy(F.desc("occurrences"), "event_id").limit(top)


def duplicate_check(events: DataFrame, top: int = 10) -> DataFrame:
    """Repeated ids of the whole table, a few of them."""
    return (
        events.groupBy("event_id")
        .agg(F.count(F.lit(1)).alias("occurrences"))
        .where("occurrences > 1")
        .orderBy(F.desc("occurrences"), "event_id")
        .limit(top)
    )


def load_latency(events: DataFrame, as_of=None, hours: int = 24) -> DataFrame:
    """Seconds from event to load per event hour: average and exact percentiles.

    Rows are first counted per (hour, second of latency), so an hour with most
    of the events costs one row per distinct latency, and the percentile weighs
    those counts.
    """
    counted = (
        _recent(events, as_of, timing.hours(hours))
        .select(
            F.date_trunc("hour", "event_ts").alias("event_hour"),
            timing.seconds_between(F.col("event_ts"), F.col("loaded_at")).alias("latency"),
        )
        .groupBy("event_hour", "latency")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = F.sum(F.when(F.col("latency").isNotNull(), F.col("n")))
    seconds = F.sum(F.col("latency") * F.col("n"))
    points = F.percentile("latency", F.array(F.lit(0.5), F.lit(0.95), F.lit(0.99)), F.col("n"))
    return (
        counted.groupBy("event_hour")
        .agg(
            F.sum("n").alias("events_loaded"),
            measures.ratio(seconds, known, 1).alias("avg_latency_secs"),
            points.alias("_points"),
        )
        .select(
            "event_hour",
            "events_loaded",
            "avg_latency_secs",
            *[measures.settled(F.get("_points", F.lit(i)), 1).alias(f"{name}_latency_secs")
              for i, name in enumerate(("p50", "p95", "p99"))],
        )
        .orderBy(F.desc("event_hour"))
    )


#: Size of a latency sketch; a percentile read from merged ones is off by about 0.004 of all rows (99 of 100 times).
SKETCH_SIZE = 800


def latency_sketches(events: DataFrame, size: int = SKETCH_SIZE) -> DataFrame:
    """Per event minute: rows, rows with a latency, their seconds and a mergeable sketch of them.

    Kept as a table, it answers `load_latency_rollup` for any look-back without reading events again. The sketches are
    made before the shuffle, so a minute with most of the rows sends one sketch per input task.
    """
    latency = timing.seconds_between(F.col("event_ts"), F.col("loaded_at")).cast("long")
    rows = events.select(F.date_trunc("minute", "event_ts").alias("minute"), latency.alias("latency"))
    return rows.groupBy("minute").agg(
        F.count(F.lit(1)).alias("events"),
        F.count("latency").alias("known"),
        F.sum("latency").alias("seconds"),
        F.kll_sketch_agg_bigint("latency", F.lit(size)).alias("sketch"),
    )


def load_latency_rollup(sketches: DataFrame, as_of=None, hours: int = 24, size: int = SKETCH_SIZE) -> DataFrame:
    """`load_latency` from sketches per minute: counts and averages exact, percentiles within the sketch's rank error.

    A look-back that begins within a minute takes that minute whole.
    """
    now = timing.as_of_column(as_of)
    recent = sketches.where((F.col("minute") >= F.date_trunc("minute", now - timing.hours(hours))))
    merged = recent.groupBy(F.date_trunc("hour", "minute").alias("event_hour")).agg(
        F.sum("events").alias("events_loaded"),
        F.sum("known").alias("_known"),
        measures.ratio(F.sum("seconds"), F.sum("known"), 1).alias("avg_latency_secs"),
        F.kll_merge_agg_bigint("sketch", F.lit(size)).alias("_sketch"),
    )

    def point(rank):
        return F.when(F.col("_known") > 0, F.kll_sketch_get_quantile_bigint("_sketch", F.lit(rank))).cast("double")

    points = [point(rank).alias(f"{name}_latency_secs") for name, rank in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))]
    return merged.select("event_hour", "events_loaded", "avg_latency_secs", *points).orderBy(F.desc("event_hour"))


def active_users(events: DataFrame, as_of=None, hours: int = 1, top: int = 60) -> DataFrame:
    """Distinct users per minute up to `as_of`, the newest minutes."""
    return (
        _recent(events, as_of, timing.hours(hours), closed=True)
        .groupBy(F.date_trunc("minute", "event_ts").alias("window_start"))
        .agg(F.countDistinct("user_id").alias("active_users"), F.count(F.lit(1)).alias("events"))
        .orderBy(F.desc("window_start"))
        .limit(top)
    )


def active_users_sliding(events: DataFrame, as_of=None, hours: int = 1, width_minutes: int = 5) -> DataFrame:
    """Distinct users in windows of several minutes, one starting every minute.

    Rows are reduced to one per (minute, user) before each is copied into the
    windows it belongs to, so the copies grow with users, not with events.
    """
    per_user = (
        _recent(events, as_of, timing.hours(hours), closed=True)
        .groupBy(F.date_trunc("minute", "event_ts").alias("minute"), "user_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return (
        per_user.groupBy(F.window("minute", f"{width_minutes} minutes", "1 minute").alias("w"))
        .agg(F.countDistinct("user_id").alias("active_users"), F.sum("n").alias("events"))
        .select(F.col("w.start").alias("window_start"), "active_users", "events")
        .orderBy(F.desc("window_start"))
    )


def error_rate_by_page(
    events: DataFrame, as_of=None, hours: int = 1, more_than: int = 10, top: int = 20, error_type: str = "error"
) -> DataFrame:
    """Pages with the highest share of errors, busy pages only."""
    return (
        _recent(events, as_of, timing.hours(hours))
        .groupBy(F.coalesce("page", F.lit("unknown")).alias("page"))
        .agg(
            F.count(F.lit(1)).alias("total_events"),
            measures.count_where(F.col("event_type") == error_type).alias("errors"),
        )
        .where(F.col("total_events") > more_than)
        .withColumn("error_rate_pct", measures.percent(F.col("errors"), F.col("total_events")))
        .orderBy(F.desc("error_rate_pct"), "page")
        .limit(top)
    )
