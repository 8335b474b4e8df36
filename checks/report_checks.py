"""Reports over the fact table."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import AS_OF, FACT, RECENT, cents, half_up, mean_amount, percent
from checks import fixtures as fx
from tidemark.plans import reports
from tidemark.session import work_folder, written

HOURS = fx.LOOK_BACK_HOURS


@query(
    f"""WITH {FACT}
SELECT date_trunc('minute', event_ts) AS minute, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
       CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS error_count
FROM fact WHERE {RECENT} GROUP BY 1"""
)
def events_per_minute(spark, sf_dir):
    return reports.events_per_minute(fx.fact(spark, sf_dir), fx.AS_OF, HOURS)


@query(
    f"""WITH {FACT}
SELECT event_type, count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       {half_up('sum(duration_ms)', 'count(duration_ms)', 1)} AS avg_duration_ms,
       {mean_amount()} AS avg_value
FROM fact WHERE {RECENT} GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20"""
)
def top_event_types(spark, sf_dir):
    return reports.top_event_types(fx.fact(spark, sf_dir), fx.AS_OF, HOURS)


_FUNNEL = """per_user AS (
  SELECT user_id, max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS a,
         max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS b,
         max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS c
  FROM fact WHERE {where} GROUP BY user_id)
SELECT CAST(sum(a) AS BIGINT) AS step1_page_views, CAST(sum(b) AS BIGINT) AS step2_add_to_cart,
       CAST(sum(c) AS BIGINT) AS step3_purchase,
       {ab} AS view_to_cart_pct, {bc} AS cart_to_purchase_pct, {ac} AS overall_conversion_pct
FROM per_user"""


def _funnel_sql(where):
    return _FUNNEL.format(
        where=where,
        ab=percent("sum(b)", "sum(a)"),
        bc=percent("sum(c)", "sum(b)"),
        ac=percent("sum(c)", "sum(a)"),
    )


@query(f"WITH {FACT}, {_funnel_sql(RECENT)}")
def funnel(spark, sf_dir):
    return reports.funnel(
        fx.fact(spark, sf_dir), fx.AS_OF, fx.FUNNEL_STEPS, since="2024-01-01 00:00:00"
    )


@query(f"WITH {FACT}, {_funnel_sql('event_ts >= TIMESTAMP ' + chr(39) + '2024-01-30 00:00:00' + chr(39))}")
def funnel_today(spark, sf_dir):
    return reports.funnel(fx.fact(spark, sf_dir), "2024-01-30 23:59:59", fx.FUNNEL_STEPS)


@query(
    f"""WITH {FACT}
SELECT date_trunc('hour', event_ts) AS hour, count(*) AS purchase_count,
       CAST({cents()} AS DOUBLE) / 100 AS total_revenue, {mean_amount()} AS avg_order_value
FROM fact WHERE event_type = 'purchase' AND {RECENT} GROUP BY 1"""
)
def revenue_by_hour(spark, sf_dir):
    return reports.revenue_by_hour(fx.fact(spark, sf_dir), fx.AS_OF, fx.LOOK_BACK_DAYS)


def _with_repeats(spark, sf_dir):
    """Every event, and error events once more, loaded a minute later."""
    rows = fx.fact(spark, sf_dir)
    again = rows.where(F.col("event_type") == fx.REDELIVERED_TYPE).withColumn(
        "loaded_at", F.col("loaded_at") + F.expr("interval 1 minute")
    )
    return rows.unionByName(again)


_REPEATS = (
    FACT
    + """, repeats AS (
  SELECT event_id, event_ts, loaded_at FROM fact UNION ALL
  SELECT event_id, event_ts, loaded_at + INTERVAL 1 MINUTE FROM fact WHERE event_type = 'error')"""
)


@query(
    f"""WITH {_REPEATS}
SELECT event_id, count(*) AS occurrences, min(event_ts) AS first_seen, max(event_ts) AS last_seen,
       min(loaded_at) AS first_loaded, max(loaded_at) AS last_loaded
FROM repeats WHERE loaded_at >= {AS_OF} - INTERVAL 30 DAY
GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 50"""
)
def duplicate_events(spark, sf_dir):
    return reports.duplicate_events(_with_repeats(spark, sf_dir), fx.AS_OF, HOURS)


@query(
    f"""WITH {_REPEATS}
SELECT event_id, count(*) AS occurrences, min(event_ts) AS first_seen, max(event_ts) AS last_seen,
       min(loaded_at) AS first_loaded, max(loaded_at) AS last_loaded
FROM repeats GROUP BY 1 HAVING count(*) > 1"""
)
def duplicate_events_all(spark, sf_dir):
    return reports.duplicate_events(_with_repeats(spark, sf_dir), hours=None, top=None)


@query(
    f"""WITH {_REPEATS}
SELECT event_id, count(*) AS occurrences FROM repeats GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 10"""
)
def duplicate_check(spark, sf_dir):
    return reports.duplicate_check(_with_repeats(spark, sf_dir))


@query(
    f"""WITH {FACT}, lat AS (
  SELECT date_trunc('hour', event_ts) AS event_hour, date_diff('second', event_ts, loaded_at) AS s
  FROM fact WHERE {RECENT})
SELECT event_hour, count(*) AS events_loaded, {half_up('sum(s)', 'count(s)', 1)} AS avg_latency_secs,
       CAST(round(CAST(quantile_cont(CAST(s AS DOUBLE), 0.5) AS DECIMAL(24,6)), 1) AS DOUBLE) AS p50_latency_secs,
       CAST(round(CAST(quantile_cont(CAST(s AS DOUBLE), 0.95) AS DECIMAL(24,6)), 1) AS DOUBLE) AS p95_latency_secs,
       CAST(round(CAST(quantile_cont(CAST(s AS DOUBLE), 0.99) AS DECIMAL(24,6)), 1) AS DOUBLE) AS p99_latency_secs
FROM lat GROUP BY 1"""
)
def load_latency(spark, sf_dir):
    return reports.load_latency(fx.fact(spark, sf_dir), fx.AS_OF, HOURS)


@query(
    f"""WITH {FACT}, lat AS (
  SELECT date_trunc('hour', event_ts) AS event_hour, date_diff('second', event_ts, loaded_at) AS s
  FROM fact WHERE {RECENT})
SELECT event_hour, count(*) AS events_loaded, {half_up('sum(s)', 'count(s)', 1)} AS avg_latency_secs,
       true AS p50_near, true AS p95_near, true AS p99_near
FROM lat GROUP BY 1"""
)
def load_latency_rollup(spark, sf_dir):
    """Hours merged from sketches per minute; the percentiles' places among the rows are within 0.01 of what they name."""
    events = fx.fact(spark, sf_dir)
    stored = written(reports.latency_sketches(events), work_folder(spark, "latency-sketches"))
    rolled = reports.load_latency_rollup(stored, fx.AS_OF, HOURS)
    each = events.select(
        F.date_trunc("hour", "event_ts").alias("event_hour"),
        (F.unix_seconds("loaded_at") - F.unix_seconds("event_ts")).alias("s"),
    )
    named = (("p50", 0.5), ("p95", 0.95), ("p99", 0.99))
    below = [F.avg((F.col("s") < F.col(f"{n}_latency_secs")).cast("int")).alias(f"{n}_below") for n, _ in named]
    upto = [F.avg((F.col("s") <= F.col(f"{n}_latency_secs")).cast("int")).alias(f"{n}_upto") for n, _ in named]
    kept = ["event_hour", "events_loaded", "avg_latency_secs"]
    places = rolled.join(each, "event_hour").groupBy(*kept).agg(*below, *upto)
    near = [((F.col(f"{n}_below") <= r + 0.01) & (F.col(f"{n}_upto") >= r - 0.01)).alias(f"{n}_near") for n, r in named]
    return places.select(*kept, *near)


@query(
    f"""WITH {FACT}
SELECT date_trunc('minute', event_ts) AS window_start, count(DISTINCT user_id) AS active_users, count(*) AS events
FROM fact WHERE event_ts BETWEEN {AS_OF} - INTERVAL 30 DAY AND {AS_OF} GROUP BY 1 ORDER BY 1 DESC LIMIT 60"""
)
def active_users_minute(spark, sf_dir):
    return reports.active_users(fx.fact(spark, sf_dir), fx.AS_OF, HOURS)


@query(
    f"""WITH {FACT}
SELECT date_trunc('minute', event_ts) - to_minutes(i) AS window_start,
       count(DISTINCT user_id) AS active_users, count(*) AS events
FROM fact, range(5) AS r(i) WHERE event_ts BETWEEN {AS_OF} - INTERVAL 30 DAY AND {AS_OF} GROUP BY 1"""
)
def active_users_sliding(spark, sf_dir):
    return reports.active_users_sliding(fx.fact(spark, sf_dir), fx.AS_OF, HOURS)


@query(
    f"""WITH {FACT}, pages_seen AS (
  SELECT coalesce(page, 'unknown') AS page, count(*) AS total_events,
         CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors
  FROM fact WHERE {RECENT} GROUP BY 1 HAVING count(*) > 10)
SELECT page, total_events, errors, {percent('errors', 'total_events')} AS error_rate_pct
FROM pages_seen ORDER BY error_rate_pct DESC, page LIMIT 20"""
)
def error_rate_by_page(spark, sf_dir):
    return reports.error_rate_by_page(fx.fact(spark, sf_dir), fx.AS_OF, HOURS)
