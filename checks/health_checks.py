"""Metrics, alarms, shards and table statistics."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import FACT, RECORDS, half_up, percent
from checks import fixtures as fx
from tidemark.operators import alarms, validate
from tidemark.plans import health, maintain


@query(
    f"""WITH {RECORDS}
SELECT date_trunc('minute', arrival_ts) AS minute, count(*) AS incoming_records FROM all_records GROUP BY 1"""
)
def incoming_per_minute(spark, sf_dir):
    return health.incoming_per_minute(fx.records(spark, sf_dir, redelivered=True, resent=True))


def _batch_log(spark, sf_dir):
    """A log with one batch per event, all batches of an hour starting together."""
    events = fx.fact(spark, sf_dir)
    return events.select(
        F.col("event_id").cast("long").alias("batch_id"),
        F.date_trunc("hour", "event_ts").alias("started_at"),
        F.col("duration_ms").cast("long").alias("duration_ms"),
        (F.col("event_type") == "error").cast("int").alias("failed"),
    )


@query(
    f"""WITH {FACT}
SELECT date_trunc('hour', event_ts) AS minute, count(*) AS batches,
       count(*) FILTER (event_type = 'error') AS failed_batches FROM fact GROUP BY 1"""
)
def batch_counts(spark, sf_dir):
    return health.batch_counts(_batch_log(spark, sf_dir))


@query(
    f"""WITH {FACT}
SELECT date_trunc('hour', event_ts) AS minute,
       CAST(round(CAST(quantile_cont(CAST(duration_ms AS DOUBLE), 0.5) AS DECIMAL(24,6)), 1) AS DOUBLE) AS p50_ms,
       CAST(round(CAST(quantile_cont(CAST(duration_ms AS DOUBLE), 0.99) AS DECIMAL(24,6)), 1) AS DOUBLE) AS p99_ms
FROM fact GROUP BY 1"""
)
def batch_durations(spark, sf_dir):
    return health.batch_durations(_batch_log(spark, sf_dir))


@query(
    f"""WITH {FACT}
SELECT date_trunc('minute', loaded_at) AS minute, max(date_diff('second', event_ts, loaded_at)) AS max_wait_seconds
FROM fact GROUP BY 1"""
)
def delivery_freshness(spark, sf_dir):
    return health.delivery_freshness(fx.fact(spark, sf_dir), "event_ts", "loaded_at")


def _rejected(spark, sf_dir):
    checked = validate.check(fx.records(spark, sf_dir))
    return validate.bad(checked).withColumnRenamed("arrival_ts", "rejected_at")


def _replayed(spark, sf_dir):
    """Rejects that are JSON go out again after three hours."""
    fixable = _rejected(spark, sf_dir).where(F.col("error_type").isin("missing_fields", "not_object"))
    return fixable.select((F.col("rejected_at") + F.expr("interval 3 hours")).alias("replayed_at"))


_BACKLOG = f"""{RECORDS}, changes AS (
  SELECT arrival_ts AS moment, 1 AS change FROM first_records WHERE error_type IS NOT NULL
  UNION ALL SELECT arrival_ts + INTERVAL 3 HOUR, -1 FROM first_records
  WHERE error_type IN ('missing_fields', 'not_object')),
minutes AS (SELECT date_trunc('minute', moment) AS minute, sum(change) AS change FROM changes GROUP BY 1),
running AS (SELECT minute, sum(change) OVER (ORDER BY minute) AS waiting FROM minutes),
periods AS (
  SELECT unnest(generate_series(time_bucket(INTERVAL 5 MINUTE, min(minute)), time_bucket(INTERVAL 5 MINUTE, max(minute)),
                                INTERVAL 5 MINUTE)) AS period FROM running),
backlog AS (
  SELECT period, CAST(greatest(
    coalesce((SELECT max_by(waiting, minute) FROM running WHERE minute < period), 0),
    coalesce((SELECT max(waiting) FROM running WHERE minute >= period AND minute < period + INTERVAL 5 MINUTE), -1000000)
  ) AS BIGINT) AS backlog FROM periods)"""


@query(f"WITH {_BACKLOG} SELECT period, backlog FROM backlog")
def reject_backlog(spark, sf_dir):
    return health.reject_backlog(_rejected(spark, sf_dir), _replayed(spark, sf_dir))


_ERRORS_PER_MINUTE = f"""{FACT}, counted AS (
  SELECT date_trunc('minute', event_ts) AS period, count(*) AS value FROM fact WHERE event_type = 'error' GROUP BY 1),
every_minute AS (SELECT unnest(generate_series(min(period), max(period), INTERVAL 1 MINUTE)) AS period FROM counted),
filled AS (
  SELECT period, CAST(coalesce(value, 0) AS DOUBLE) AS value FROM every_minute LEFT JOIN counted USING (period))"""


@query(
    f"""WITH {_ERRORS_PER_MINUTE}
SELECT 'errors' AS metric, period, value,
       value > 0 AND coalesce(lag(value) OVER (ORDER BY period), -1) > 0 AS breached FROM filled"""
)
def alarm_consecutive(spark, sf_dir):
    """Minutes with errors, two in a row; quiet minutes are filled with zero."""
    errors = fx.fact(spark, sf_dir).where("event_type = 'error'")
    rows = alarms.series(errors, "errors", "event_ts", F.count(F.lit(1)))
    return alarms.alarm(rows, 0, 2)


@query(
    f"""WITH {_BACKLOG}, shard_minutes AS (
  SELECT 'records_per_second_per_shard/' || shard AS metric, date_trunc('minute', arrival_ts) AS period,
         count(*) / 60.0 AS value FROM first_records GROUP BY 1, 2),
error_minutes AS (
  SELECT 'errors' AS metric, date_trunc('minute', arrival_ts) AS period, count(*) * 1.0 AS value
  FROM first_records WHERE error_type IS NOT NULL GROUP BY 1, 2),
waits AS (
  SELECT 'delivery_freshness_seconds' AS metric, date_trunc('minute', loaded_at) AS period,
         max(date_diff('second', event_ts, loaded_at)) * 1.0 AS value FROM fact GROUP BY 1, 2),
one_minute AS (SELECT * FROM shard_minutes UNION ALL SELECT * FROM error_minutes UNION ALL SELECT * FROM waits),
every_minute AS (
  SELECT metric, unnest(generate_series(min(period), max(period), INTERVAL 1 MINUTE)) AS period
  FROM one_minute GROUP BY metric),
filled AS (
  SELECT metric, period, coalesce(value, 0) AS value FROM every_minute LEFT JOIN one_minute USING (metric, period)
  UNION ALL SELECT 'reject_backlog', period, CAST(backlog AS DOUBLE) FROM backlog),
limits(rule, threshold, consecutive) AS (
  VALUES ('records_per_second_per_shard', 0.02, 1), ('errors', 0.0, 2), ('reject_backlog', 5.0, 1),
         ('delivery_freshness_seconds', 89.0, 1)),
judged AS (
  SELECT metric, threshold, consecutive, period, value,
         CASE consecutive WHEN 1 THEN value > threshold
              ELSE value > threshold AND coalesce(lag(value) OVER (PARTITION BY metric ORDER BY period), -1) > threshold
         END AS breached
  FROM filled JOIN limits ON rule = split_part(metric, '/', 1))
SELECT metric, CAST(threshold AS DOUBLE) AS threshold, consecutive, count(*) AS periods,
       count(*) FILTER (breached) AS breached_periods, CAST(max(value) AS DOUBLE) AS worst_value,
       min(period) FILTER (breached) AS first_breach, max(period) FILTER (breached) AS last_breach
FROM judged GROUP BY 1, 2, 3"""
)
def alarm_table(spark, sf_dir):
    """The pipeline's alarms with limits low enough for the test data to reach."""
    delivered = fx.fact(spark, sf_dir).selectExpr("event_ts AS arrival_ts", "loaded_at AS delivered_at")
    rows = health.pipeline_metrics(
        fx.records(spark, sf_dir), _rejected(spark, sf_dir), _replayed(spark, sf_dir), delivered
    )
    rules = (
        ("records_per_second_per_shard", 0.02, 60, 1),
        ("errors", 0.0, 60, 2),
        ("reject_backlog", 5.0, 300, 1),
        ("delivery_freshness_seconds", 89.0, 60, 1),
    )
    return alarms.alarm_table(rows, rules)


# --- shards -----------------------------------------------------------------

PERIOD = 86_400


_POINTS = f"""{RECORDS}, points AS (
  SELECT CAST(shard AS VARCHAR) AS shard_id, date_trunc('day', arrival_ts) AS period, count(*) AS n
  FROM all_records GROUP BY 1, 2),
recent AS (
  SELECT shard_id, max_by(n, period) AS n FROM points
  WHERE period >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 2 DAY AND period <= TIMESTAMP '2024-01-30 12:00:00'
  GROUP BY 1)"""


def _points(spark, sf_dir):
    records = fx.records(spark, sf_dir, redelivered=True, resent=True)
    return health.shard_points(records, PERIOD, 0)


def _shards(spark, sf_dir):
    """The shards seen, two of them closed at their last sequence number."""
    seen = fx.records(spark, sf_dir).groupBy("shard_id").agg(F.max("sequence_number").alias("last"))
    closed = F.col("shard_id").isin("3", "8")
    return seen.select("shard_id", F.when(closed, F.col("last")).alias("ending_sequence_number"))


@query(f"WITH {RECORDS} SELECT DISTINCT CAST(shard AS VARCHAR) AS shard_id FROM first_records WHERE shard NOT IN (3, 8)")
def open_shards(spark, sf_dir):
    return health.open_shards(_shards(spark, sf_dir)).select("shard_id")


@query(
    f"""WITH {_POINTS}
SELECT shard_id, CAST(n AS DOUBLE) AS "IncomingRecords", CAST(n AS DOUBLE) AS "WriteProvisionedThroughputExceeded"
FROM recent"""
)
def shard_latest_metrics(spark, sf_dir):
    return health.latest_points(_points(spark, sf_dir), "2024-01-30 12:00:00", PERIOD)


@query(
    f"""WITH {_POINTS}, used AS (
  SELECT s.shard_id, coalesce(n, 0) / 86400.0 AS records_per_second, coalesce(n, 0) AS throttles
  FROM (SELECT DISTINCT CAST(shard AS VARCHAR) AS shard_id FROM first_records WHERE shard NOT IN (3, 8)) s
  LEFT JOIN recent USING (shard_id))
SELECT shard_id, CAST(records_per_second AS DOUBLE) AS records_per_second,
       CAST(least(records_per_second / 0.0006, 1.0) * 100.0 AS DOUBLE) AS utilisation_pct,
       CASE WHEN least(records_per_second / 0.0006, 1.0) * 100 < 60 THEN 'green'
            WHEN least(records_per_second / 0.0006, 1.0) * 100 < 85 THEN 'yellow' ELSE 'red' END AS band,
       CAST(throttles AS DOUBLE) AS throttles
FROM used"""
)
def shard_utilisation(spark, sf_dir):
    latest = health.latest_points(_points(spark, sf_dir), "2024-01-30 12:00:00", PERIOD)
    return health.shard_utilisation(_shards(spark, sf_dir), latest, PERIOD, cap=0.0006)


# --- tables -----------------------------------------------------------------


@query(
    f"""WITH {FACT}, spread AS (
  SELECT i AS slice, count(user_id) AS rows FROM range(16) r(i)
  LEFT JOIN fact ON CAST(('0x' || substring(md5(user_id), 1, 8)) AS BIGINT) % 16 = i GROUP BY 1)
SELECT 'events' AS table_name, count(*) AS slice_count, min(rows) AS min_rows_per_slice, max(rows) AS max_rows_per_slice,
       {half_up('sum(rows)', 'count(*)', 0)} AS avg_rows_per_slice,
       {half_up('max(rows) * count(*)', 'sum(rows)', 2)} AS skew_ratio
FROM spread"""
)
def skew_report(spark, sf_dir):
    return maintain.skew_report(fx.fact(spark, sf_dir))


@query(f"WITH {FACT} SELECT user_id, count(*) AS rows FROM fact GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 20")
def hot_keys(spark, sf_dir):
    return maintain.hot_keys(fx.fact(spark, sf_dir))


@query(
    f"""WITH watched AS (
  SELECT l_returnflag AS part, l_shipdate AS ts,
         max(l_shipdate) OVER (PARTITION BY l_returnflag ORDER BY l_orderkey * 10 + l_linenumber, l_shipdate
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before
  FROM (SELECT l_returnflag, l_orderkey, l_linenumber, max(l_shipdate) AS l_shipdate FROM lineitem GROUP BY ALL))
SELECT part, count(*) AS rows, count(*) FILTER (ts < before) AS unsorted_rows,
       {percent('count(*) FILTER (ts < before)', 'count(*)')} AS unsorted_pct
FROM watched GROUP BY 1"""
)
def unsorted_share(spark, sf_dir):
    """Ship dates in order-key order, in chunks small enough to have several."""
    items = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    lines = items.groupBy("l_returnflag", "l_orderkey", "l_linenumber").agg(F.max("l_shipdate").alias("ts"))
    rows = lines.withColumn("pos", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return maintain.unsorted_share(rows, "l_returnflag", "pos", "ts", chunk_rows=5_000)


@query(
    """WITH parts AS (
  SELECT 'lineitem' AS table_name, l_linenumber AS slice, count(*) AS rows FROM lineitem GROUP BY 2
  UNION ALL SELECT 'orders', o_custkey % 7, count(*) FROM orders GROUP BY 2
  UNION ALL SELECT 'customer', c_nationkey, count(*) FROM customer GROUP BY 2)
SELECT 'analytics' AS schema_name, table_name, CAST(sum(rows) AS BIGINT) AS num_rows,
       CAST(round(CAST(sum(rows * 3) AS DECIMAL(20,4)) / 1024, 1) AS DOUBLE) AS size_in_mb,
       CAST(max(slice % 5) AS DOUBLE) AS pct_unsorted, 0.0::DOUBLE AS stats_off
FROM parts WHERE table_name <> 'customer' GROUP BY table_name"""
)
def table_stats(spark, sf_dir):
    """Row counts per slice of three tables, one of them in another schema."""
    def slices(table_id, name, key):
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        return rows.groupBy(key.cast("long").alias("slice")).agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(table_id).alias("table_id"),
            "rows",
            (F.col("rows") * 3).cast("double").alias("size_kb"),
            (F.col("slice") % 5).cast("double").alias("unsorted_pct"),
            F.lit(0.0).alias("stats_off"),
        )

    parts = (
        slices(1, "lineitem", F.col("l_linenumber"))
        .unionByName(slices(2, "orders", F.col("o_custkey") % 7))
        .unionByName(slices(3, "customer", F.col("c_nationkey")))
    )
    tables = spark.createDataFrame(
        [(1, "analytics", "lineitem"), (2, "analytics", "orders"), (3, "sales", "customer")],
        "table_id int, schema_name string, table_name string",
    )
    return maintain.table_stats(tables, parts, "analytics")
