"""Structured Streaming jobs, run over the whole table until it is worked off."""

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import FACT, FACT_COLUMNS, RECORDS, cents
from checks import fixtures as fx
from checks.record_checks import TOLD_APART, without_numbers
from tidemark.operators import enrich
from tidemark.plans import backfill
from tidemark.schema import FACT_COLUMNS as FACT_NAMES
from tidemark.session import work_folder
from tidemark.sources import folders, landing, records, rejects
from tidemark.sources.fact import FactTable
from tidemark.streaming import live_windows, loader, transform_job

LOADED = [c for c in FACT_NAMES if c != "loaded_at"]


def _finish(query):
    query.awaitTermination()


def _transform(spark, sf_dir, change=None, **options):
    root = work_folder(spark, "stream")
    records = fx.records(spark, sf_dir, redelivered=True, resent=True, stream=True)
    records = change(records) if change else records
    _finish(transform_job.start(records, root, f"{root}/checkpoint", trigger=None, **options))
    return root


@query(
    f"""WITH {RECORDS}
SELECT DISTINCT CASE WHEN k <> 43 THEN event_id END AS event_id, event_type,
       CASE WHEN k <> 53 THEN event_ts END AS event_ts, user_id, session_id, page, duration_ms, value,
       producer_ver, aws_region, sequence_number AS kinesis_seq, processed_by
FROM all_records WHERE error_type IS NULL"""
)
def stream_transform(spark, sf_dir):
    """All records through the streaming job; what it landed, flattened."""
    root = _transform(spark, sf_dir)
    return enrich.flatten(landing.read_lines(spark, root)).select(*LOADED)


@query(
    f"""WITH {RECORDS}
SELECT error_type, count(*) AS rejects FROM all_records WHERE error_type IS NOT NULL GROUP BY 1"""
)
def stream_rejects(spark, sf_dir):
    """Rejects of the streaming job: a bad record counts each time it arrives."""
    return rejects.by_type(rejects.read(spark, _transform(spark, sf_dir)))


@query(
    f"""WITH {RECORDS}
SELECT count(DISTINCT CASE WHEN k <> 43 THEN event_id END) AS event_ids,
       count(DISTINCT CASE WHEN k = 43 THEN sequence_number ELSE event_id END) AS lines
FROM all_records WHERE error_type IS NULL"""
)
def stream_dedupe_events(spark, sf_dir):
    """With the second pass by event id, records sent again under a new number go too; those without an id stay."""
    flat = enrich.flatten(landing.read_lines(spark, _transform(spark, sf_dir, by_event_id=True)))
    return flat.agg(F.countDistinct("event_id").alias("event_ids"), F.count(F.lit(1)).alias("lines"))


@query(
    f"""WITH {TOLD_APART}
SELECT event_type, count(DISTINCT record) AS lines FROM told WHERE error_type IS NULL GROUP BY 1"""
)
def stream_dedupe_nulls(spark, sf_dir):
    """Good records without a number survive the stream, each once."""
    lines = landing.read_lines(spark, _transform(spark, sf_dir, without_numbers))
    return enrich.flatten(lines).groupBy("event_type").agg(F.count(F.lit(1)).alias("lines"))


@query(
    f"""WITH {TOLD_APART}
SELECT count(DISTINCT record) FILTER (error_type IS NULL) AS first_run, CAST(0 AS BIGINT) AS second_run FROM told"""
)
def backfill_nulls(spark, sf_dir):
    """A second bounded run over the same records lands none of them, numbered or not."""
    root = work_folder(spark, "backfill")
    made = without_numbers(fx.records(spark, sf_dir, redelivered=True, resent=True))
    for run, at in (("run-1", "2024-02-01 00:00:00"), ("run-2", "2024-02-01 06:00:00")):
        backfill.run(made, root, f"{root}/keys", run, at)
    counts = [F.count_if(F.col("batch_id") == run).alias(name) for run, name in (("run-1", "first_run"), ("run-2", "second_run"))]
    return spark.read.schema("value string, batch_id string").text(f"{root}/events").agg(*counts)


@query(
    f"""WITH {RECORDS}
SELECT DISTINCT {FACT_COLUMNS.replace('kinesis_seq', 'sequence_number AS kinesis_seq')}
FROM all_records WHERE error_type IS NULL AND k NOT IN (43, 53)"""
)
def stream_load(spark, sf_dir):
    """Records to landing zone to fact table, both steps streaming."""
    root = _transform(spark, sf_dir)
    table = FactTable(spark, f"{root}/fact")
    _finish(loader.start(table, root, f"{root}/load-checkpoint", trigger=None))
    return table.read().select(*LOADED)


def _windowed(spark, frame, name, mode="append"):
    """Run a windowed stream into a folder and read it back."""
    root = work_folder(spark, name)
    writer = frame.writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint")
    _finish(writer.format("parquet").trigger(availableNow=True).start(f"{root}/out"))
    return spark.read.schema(frame.schema).parquet(f"{root}/out")


# A window is written once event time, less the lateness bound, has passed its end.
_CLOSED = "(SELECT max(event_ts) FROM fact) - INTERVAL 10 MINUTE"


@query(
    f"""WITH {FACT}
SELECT date_trunc('minute', event_ts) AS minute, count(*) AS event_count,
       count(*) FILTER (event_type = 'error') AS error_count
FROM fact GROUP BY 1 HAVING date_trunc('minute', event_ts) + INTERVAL 1 MINUTE <= {_CLOSED}"""
)
def stream_minutes(spark, sf_dir):
    """Closed one-minute windows; distinct users are approximate and not compared."""
    live = live_windows.events_per_minute(fx.fact(spark, sf_dir, stream=True))
    return _windowed(spark, live, "minutes").select("minute", "event_count", "error_count")


@query(
    f"""WITH {FACT}
SELECT date_trunc('hour', event_ts) AS hour, count(*) AS purchase_count, CAST({cents()} AS DOUBLE) / 100 AS total_revenue
FROM fact WHERE event_type = 'purchase' GROUP BY 1
HAVING date_trunc('hour', event_ts) + INTERVAL 1 HOUR <= (SELECT max(event_ts) FROM fact WHERE event_type = 'purchase') - INTERVAL 10 MINUTE"""
)
def stream_revenue(spark, sf_dir):
    live = live_windows.revenue_by_hour(fx.fact(spark, sf_dir, stream=True))
    return _windowed(spark, live, "revenue")


@query(
    f"""WITH {FACT}, placed AS (
  SELECT date_trunc('minute', event_ts) - to_minutes(i) AS window_start, user_id FROM fact, range(5) AS r(i))
SELECT window_start, count(*) AS events FROM placed GROUP BY 1
HAVING window_start + INTERVAL 5 MINUTE <= {_CLOSED}"""
)
def stream_sliding(spark, sf_dir):
    live = live_windows.active_users_sliding(fx.fact(spark, sf_dir, stream=True))
    return _windowed(spark, live, "sliding").select("window_start", "events")


def _to_the_end(spark, sf_dir, report, name):
    """A bounded run, the end mark, and the run that writes what was still open."""
    root = work_folder(spark, name)
    live = report(live_windows.closing(fx.fact(spark, sf_dir, stream=True), f"{root}/marks"))
    for _ in range(2):
        writer = live.writeStream.outputMode("append").option("checkpointLocation", f"{root}/checkpoint")
        _finish(writer.format("parquet").trigger(availableNow=True).start(f"{root}/out"))
        live_windows.close(spark, f"{root}/marks", dt.datetime(2025, 1, 1))
    return spark.read.schema(live.schema).parquet(f"{root}/out")


@query(
    f"""WITH {FACT}
SELECT date_trunc('minute', event_ts) AS minute, count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
       count(*) FILTER (event_type = 'error') AS error_count
FROM fact GROUP BY 1"""
)
def stream_minutes_closed(spark, sf_dir):
    """Every minute to the last, with exact users."""
    return _to_the_end(spark, sf_dir, live_windows.events_per_minute, "minutes")


@query(
    f"""WITH {FACT}
SELECT date_trunc('hour', event_ts) AS hour, count(*) AS purchase_count, CAST({cents()} AS DOUBLE) / 100 AS total_revenue
FROM fact WHERE event_type = 'purchase' GROUP BY 1"""
)
def stream_revenue_closed(spark, sf_dir):
    return _to_the_end(spark, sf_dir, live_windows.revenue_by_hour, "revenue")


@query(
    f"""WITH {FACT}, placed AS (
  SELECT date_trunc('minute', event_ts) - to_minutes(i) AS window_start, user_id FROM fact, range(5) AS r(i))
SELECT window_start, count(DISTINCT user_id) AS active_users, count(*) AS events FROM placed GROUP BY 1"""
)
def stream_sliding_closed(spark, sf_dir):
    return _to_the_end(spark, sf_dir, live_windows.active_users_sliding, "sliding")


@query(
    f"""WITH {RECORDS}
SELECT true AS several_batches, count(DISTINCT sequence_number) AS landed FROM all_records WHERE error_type IS NULL"""
)
def stream_backlog(spark, sf_dir):
    """A backlog of many files is worked off in batches of a bounded size, and nothing is lost between them."""
    root = work_folder(spark, "backlog")
    made = fx.records(spark, sf_dir, redelivered=True, resent=True)
    # Several files for every core, so that one batch keeps them all busy. Copies of a record differ in time, so they are
    # spread over files and batches; dealing rows out in turn would sort them first.
    files = max(6, 4 * spark.sparkContext.defaultParallelism)
    made.repartition(files, "sequence_number", "arrival_ts").write.parquet(f"{root}/inbox")
    size = folders.size(spark, f"{root}/inbox")
    source = records.stream_records(spark, f"{root}/inbox", options={"maxBytesPerTrigger": str(size // 3)})
    job = transform_job.start(source, f"{root}/out", f"{root}/checkpoint", trigger=None)
    _finish(job)
    # Each line is in the folder of its batch, so lines and batches are counted in one pass.
    batch = F.regexp_extract("file", "/batch_id=([^/]+)/", 1)
    counts = landing.read_lines(spark, f"{root}/out").agg(F.count(F.lit(1)).alias("landed"), F.count_distinct(batch).alias("batches"))
    return counts.select("landed", (F.col("batches") > 1).alias("several_batches"))
