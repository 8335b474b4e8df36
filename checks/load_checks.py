"""Landing zone, loading, rejects and replay."""

import datetime as dt

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import FACT, FACT_COLUMNS, PAYLOAD, RECORDS, percent
from checks import fixtures as fx
from tidemark.operators import dedupe, enrich, upsert, validate
from tidemark.plans import backfill, load, maintain, replay, reports
from tidemark.plans import retention as retention_job
from tidemark.schema import FACT_COLUMNS as FACT_NAMES
from tidemark.session import work_folder, written
from tidemark.sources import keys, landing, records, rejects
from tidemark.sources.fact import FactTable

LOADED = [c for c in FACT_NAMES if c != "loaded_at"]
LOAD_TIME = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


def _good(spark, sf_dir, **repeats):
    return validate.good(validate.check(fx.records(spark, sf_dir, **repeats)))


def _land(spark, sf_dir, hourly=False, good=None, **repeats):
    """Land every good record two seconds after its arrival, or in one flush a
    day at noon; returns the root. `good` are the records where they are checked already."""
    root = work_folder(spark, "landing")
    lines = enrich.enrich(_good(spark, sf_dir, **repeats) if good is None else good)
    at = F.col("arrival_ts") + F.expr("interval 2 seconds")
    if not hourly:
        at = F.date_trunc("day", "arrival_ts") + F.expr("interval 12 hours")
    landing.land(lines.withColumn("delivered_at", at), root)
    return root


_LANDED = f"""{RECORDS}, landed AS (
  SELECT *, arrival_ts + INTERVAL 2 SECOND AS delivered_at FROM all_records WHERE error_type IS NULL),
usable AS (SELECT * REPLACE (sequence_number AS kinesis_seq) FROM landed WHERE k NOT IN (43, 53))"""


@query(
    f"""WITH {RECORDS}
SELECT strftime(arrival_ts + INTERVAL 2 SECOND, '%Y') AS year, strftime(arrival_ts + INTERVAL 2 SECOND, '%m') AS month,
       strftime(arrival_ts + INTERVAL 2 SECOND, '%d') AS day, strftime(arrival_ts + INTERVAL 2 SECOND, '%H') AS hour,
       sequence_number AS kinesis_seq, user_id, page, value
FROM first_records WHERE error_type IS NULL"""
)
def landing_roundtrip(spark, sf_dir):
    lines = landing.read_lines(spark, _land(spark, sf_dir, hourly=True))
    return enrich.flatten(lines).select("year", "month", "day", "hour", "kinesis_seq", "user_id", "page", "value")


@query(
    f"""WITH {_LANDED}
SELECT strftime(delivered_at, '%H') AS hour, count(*) AS lines FROM landed
WHERE CAST(delivered_at AS DATE) = DATE '2024-01-15' AND sequence_number NOT LIKE 'r%' GROUP BY 1"""
)
def landing_hour_scan(spark, sf_dir):
    """All records are landed with repeats, one day's hours are read back."""
    lines = landing.read_lines(spark, _land(spark, sf_dir, hourly=True, redelivered=True), 2024, 1, 15)
    return lines.groupBy("hour").agg(F.count(F.lit(1)).alias("lines"))


@query(
    f"""WITH {_LANDED}
SELECT event_type, count(*) AS events, CAST(sum(value) AS DOUBLE) AS total FROM landed GROUP BY 1"""
)
def landing_view(spark, sf_dir):
    landing.create_view(spark, _land(spark, sf_dir, redelivered=True, resent=True), "landed_events")
    return spark.sql(
        "SELECT event_type, count(*) AS events, cast(sum(value) AS double) AS total FROM landed_events GROUP BY 1"
    )


@query(
    f"""WITH {RECORDS}
SELECT CAST(strftime(arrival_ts, '%Y%m%d%H') AS BIGINT) AS hour, count(*) AS events
FROM first_records WHERE error_type IS NULL GROUP BY 1"""
)
def landing_parquet(spark, sf_dir):
    root = work_folder(spark, "landing")
    lines = enrich.enrich(_good(spark, sf_dir))
    landing.land_parquet(lines.withColumn("delivered_at", F.col("arrival_ts")), root)
    back = spark.read.parquet(f"{root}/events")
    return back.groupBy(F.date_format("loaded_at", "yyyyMMddHH").cast("long").alias("hour")).agg(
        F.count("kinesis_seq").alias("events")
    )


def _backfilled(spark, sf_dir):
    """First deliveries in one run, then all records in a second one."""
    root = work_folder(spark, "backfill")
    keys_root = f"{root}/keys"
    backfill.run(fx.records(spark, sf_dir), root, keys_root, "run-1", "2024-02-01 00:00:00")
    again = fx.records(spark, sf_dir, redelivered=True, resent=True)
    backfill.run(again, root, keys_root, "run-2", "2024-02-01 06:00:00")
    return root


@query(
    f"""WITH {RECORDS}, sent AS (SELECT DISTINCT sequence_number FROM all_records WHERE error_type IS NULL)
SELECT CASE WHEN sequence_number LIKE 'r%' THEN 'run-2' ELSE 'run-1' END AS run_id, sequence_number AS kinesis_seq FROM sent"""
)
def backfill_twice(spark, sf_dir):
    """The second run lands only what the first has not seen."""
    root = _backfilled(spark, sf_dir)
    runs = [
        enrich.flatten(landing.read_lines(spark, root, batch_id=run)).select(F.lit(run).alias("run_id"), "kinesis_seq")
        for run in ("run-1", "run-2")
    ]
    return runs[0].unionByName(runs[1])


@query(
    f"""WITH {RECORDS}
SELECT DISTINCT sequence_number,
  CAST(epoch(TIMESTAMP '2024-02-01') AS BIGINT) + CASE WHEN sequence_number LIKE 'r%' THEN 21600 ELSE 0 END AS processed_at
FROM all_records WHERE error_type IS NULL"""
)
def backfill_keys(spark, sf_dir):
    root = _backfilled(spark, sf_dir)
    return keys.read(spark, f"{root}/keys", "2024-02-01 12:00:00").select("sequence_number", "processed_at")


def _raised(rows, amount):
    """Purchases again with a higher value."""
    return rows.where("event_type = 'purchase'").withColumn(
        "value", (F.col("value") + F.lit(amount)).cast("decimal(12,2)")
    )


@query(
    f"""WITH {FACT}, staged AS (SELECT event_id, event_ts, value + 1 AS value FROM fact WHERE event_type = 'purchase')
SELECT event_id, event_ts, CAST(value AS DOUBLE) AS value FROM fact WHERE event_id NOT IN (SELECT event_id FROM staged)
UNION ALL SELECT event_id, event_ts, CAST(value AS DOUBLE) FROM staged"""
)
def upsert_events(spark, sf_dir):
    live = fx.fact(spark, sf_dir)
    merged = upsert.upsert(live, _raised(live, 1))
    return merged.select("event_id", "event_ts", F.col("value").cast("double").alias("value"))


_TWICE_STAGED = """staged AS (
  SELECT event_id, event_ts, value + 1 AS value FROM fact WHERE event_type = 'purchase' UNION ALL
  SELECT event_id, event_ts + INTERVAL 1 MINUTE, value + 2 FROM fact WHERE event_type = 'purchase')"""


def _staged_twice(live):
    later = _raised(live, 2).withColumn("event_ts", F.col("event_ts") + F.expr("interval 1 minute"))
    return _raised(live, 1).unionByName(later)


@query(
    f"""WITH {FACT}, {_TWICE_STAGED}
SELECT event_id, event_ts, CAST(value AS DOUBLE) AS value FROM fact WHERE event_id NOT IN (SELECT event_id FROM staged)
UNION ALL SELECT event_id, event_ts, CAST(value AS DOUBLE) FROM staged"""
)
def upsert_keeps_repeats(spark, sf_dir):
    live = fx.fact(spark, sf_dir)
    merged = upsert.upsert(live, _staged_twice(live))
    return merged.select("event_id", "event_ts", F.col("value").cast("double").alias("value"))


@query(
    f"""WITH {FACT}, {_TWICE_STAGED}, newest AS (
  SELECT event_id, max(event_ts) AS event_ts, max_by(value, event_ts) AS value FROM staged GROUP BY 1)
SELECT event_id, event_ts, CAST(value AS DOUBLE) AS value FROM fact WHERE event_id NOT IN (SELECT event_id FROM staged)
UNION ALL SELECT event_id, event_ts, CAST(value AS DOUBLE) FROM newest"""
)
def upsert_latest(spark, sf_dir):
    live = fx.fact(spark, sf_dir)
    merged = upsert.upsert(live, _staged_twice(live), intra_batch="latest")
    return merged.select("event_id", "event_ts", F.col("value").cast("double").alias("value"))


def _loaded_table(spark, sf_dir):
    """First deliveries loaded, then all records loaded over them."""
    base = work_folder(spark, "table")
    table = FactTable(spark, f"{base}/fact")
    for name, repeats in (("first", {}), ("second", {"redelivered": True, "resent": True})):
        lines = landing.read_lines(spark, _land(spark, sf_dir, **repeats))
        load.load(table, lines, name, f"{base}/audit", f"{base}/rejects", loaded_at=LOAD_TIME)
    return table, base


@query(f"WITH {_LANDED} SELECT {FACT_COLUMNS}, TIMESTAMP '2024-02-01' AS loaded_at FROM usable")
def load_twice(spark, sf_dir):
    """Every id of the first load is replaced by the second; its own repeats stay."""
    table, _ = _loaded_table(spark, sf_dir)
    return table.read().select(*FACT_NAMES)


@query(
    f"""WITH {_LANDED} SELECT event_id, count(*) AS occurrences, min(event_ts) AS first_seen,
  max(event_ts) AS last_seen FROM usable GROUP BY 1 HAVING count(*) > 1"""
)
def duplicates_after_load(spark, sf_dir):
    table, _ = _loaded_table(spark, sf_dir)
    found = reports.duplicate_events(table.read(), "2024-02-01 00:30:00", 1, top=None)
    return found.select("event_id", "occurrences", "first_seen", "last_seen")


@query(
    f"""WITH {_LANDED}, per_load AS (
  SELECT 1 AS nth, count(*) AS scanned, count(*) FILTER (k NOT IN (43, 53)) AS loaded
  FROM first_records WHERE error_type IS NULL
  UNION ALL SELECT 2, count(*), count(*) FILTER (k NOT IN (43, 53)) FROM landed)
SELECT scanned AS lines_scanned, loaded AS lines_loaded, scanned - loaded AS lines_failed,
       {percent('loaded', 'scanned', 1)} AS success_pct FROM per_load"""
)
def load_audit(spark, sf_dir):
    """Per load; the audit itself has a row per file."""
    _, base = _loaded_table(spark, sf_dir)
    audit = spark.read.parquet(f"{base}/audit").groupBy("load_id").agg(
        F.lit("all files").alias("file"),
        F.max("completed_at").alias("completed_at"),
        *[F.sum(c).alias(c) for c in ("lines_scanned", "lines_loaded", "lines_failed")],
    )
    history = load.load_history(audit, "2024-02-01 12:00:00")
    return history.select("lines_scanned", "lines_loaded", "lines_failed", "success_pct")


@query(
    f"""WITH {_LANDED}
SELECT CASE WHEN k NOT IN (43, 53) THEN CAST(event_ts AS DATE) END AS event_date, count(*) AS lines_scanned,
       count(*) FILTER (k NOT IN (43, 53)) AS lines_to_load, count(*) FILTER (k IN (43, 53)) AS lines_failed
FROM landed GROUP BY 1"""
)
def load_dry_run(spark, sf_dir):
    return load.dry_run(landing.read_lines(spark, _land(spark, sf_dir, redelivered=True, resent=True)))


@query(
    f"""WITH {_LANDED}
SELECT error_type, count(*) AS rejects FROM (
  SELECT error_type FROM all_records WHERE error_type IS NOT NULL
  UNION ALL SELECT 'load_error' FROM landed WHERE k IN (43, 53)) GROUP BY 1"""
)
def rejects_by_type(spark, sf_dir):
    """Rejected records and lines that did not load, stored and read back."""
    root = work_folder(spark, "rejects")
    checked = written(validate.check(fx.records(spark, sf_dir, redelivered=True, resent=True)), work_folder(spark, "checked"))
    rejects.store(rejects.as_rejects(validate.bad(checked), F.col("arrival_ts")), root)
    lines = landing.read_lines(spark, _land(spark, sf_dir, good=validate.good(checked)))
    table = FactTable(spark, work_folder(spark, "table"))
    load.load(table, lines, "all", rejects_root=root, loaded_at=LOAD_TIME)
    return rejects.by_type(rejects.read(spark, root))


_BODIES = f"""{RECORDS}, rejected AS (
  SELECT sequence_number, arrival_ts, error_type, row_number() OVER (ORDER BY arrival_ts, sequence_number) AS place
  FROM first_records WHERE error_type IS NOT NULL)"""


@query(f"WITH {_BODIES} SELECT sequence_number, error_type FROM rejected")
def drain_rejects(spark, sf_dir):
    bad = validate.bad(validate.check(fx.records(spark, sf_dir)))
    return rejects.drain(rejects.as_rejects(bad, F.col("arrival_ts"))).select("sequence_number", "error_type")


@query(f"WITH {_BODIES} SELECT arrival_ts AS rejected_at FROM rejected WHERE place <= 20")
def drain_limited(spark, sf_dir):
    """The oldest 20; ties in time are cut by reject id, so only times are compared."""
    bad = validate.bad(validate.check(fx.records(spark, sf_dir)))
    return rejects.drain(rejects.as_rejects(bad, F.col("arrival_ts")), 20).select("rejected_at")


def _dead_letters(spark, sf_dir):
    """Dead-letter bodies by event type: wrappers with one record, with the same
    record twice and with none, a bare payload, and text that is not JSON."""
    made = fx.clean_records(spark, sf_dir).withColumn("raw", F.unbase64("data").cast("string"))
    kind = F.get_json_object("raw", "$.event_type")
    record = F.format_string('{"kinesis":{"sequenceNumber":"%s","data":"%s"}}', "sequence_number", "data")

    def wrapper(*inside):
        return F.concat(F.lit('{"requestContext":{"condition":"retries"},"requestPayload":{"Records":['), *inside, F.lit("]}}"))

    body = (
        F.when(kind == "view", wrapper(record))
        .when(kind == "click", wrapper(record, F.lit(","), record))
        .when(kind == "error", wrapper(F.lit("")))
        .when(kind == "purchase", F.col("raw"))
        .otherwise(F.lit("not-json"))
    )
    return made.select(F.col("sequence_number").alias("reject_id"), body.alias("body"))


_COPIES = f"""WITH {RECORDS}, copies AS (
  SELECT *, unnest(CASE WHEN event_type = 'click' THEN [1, 2] ELSE [1] END) AS copy FROM first_records)"""

_PAYLOADS = f"""CASE WHEN event_type IN ('view', 'click', 'purchase') THEN {PAYLOAD}
  WHEN event_type = 'error' THEN '{{"requestContext":{{"condition":"retries"}},"requestPayload":{{"Records":[]}}}}' END"""


@query(
    f"""{_COPIES}
SELECT sequence_number AS reject_id,
       CASE WHEN event_type IN ('view', 'click') THEN sequence_number END AS original_sequence, {_PAYLOADS} AS payload
FROM copies"""
)
def replay_unwrap(spark, sf_dir):
    return replay.unwrap(_dead_letters(spark, sf_dir)).select("reject_id", "original_sequence", "payload")


@query(
    f"""{_COPIES}
SELECT CASE WHEN event_type = 'error' THEN 'replay-' || sequence_number ELSE user_id END AS key, count(*) AS messages
FROM copies WHERE event_type <> 'signup' GROUP BY 1"""
)
def replay_messages(spark, sf_dir):
    messages = replay.to_messages(replay.unwrap(_dead_letters(spark, sf_dir)))
    return messages.groupBy("key").agg(F.count("value").alias("messages"))


@query(
    f"""{_COPIES}, unwrapped AS (
  SELECT sequence_number AS reject_id, {_PAYLOADS} AS payload FROM copies), sendable AS (
  SELECT *, count(*) OVER () AS would_send FROM unwrapped WHERE payload IS NOT NULL)
SELECT reject_id, left(payload, 200) AS sample, would_send FROM sendable ORDER BY reject_id, payload LIMIT 5"""
)
def replay_dry_run(spark, sf_dir):
    plan = replay.dry_run(replay.unwrap(_dead_letters(spark, sf_dir)))
    return plan["samples"].withColumn("would_send", F.lit(plan["dry_run"]).cast("long"))


@query(
    f"""WITH {RECORDS}
SELECT error_type, count(*) AS rejects FROM first_records
WHERE error_type IS NOT NULL AND error_type IN ('bad_json', 'bad_encoding') GROUP BY 1"""
)
def replay_remaining(spark, sf_dir):
    """A whole replay to a file target: what is not JSON stays."""
    root = work_folder(spark, "replay-check")
    bad = validate.bad(validate.check(fx.records(spark, sf_dir)))
    rejects.store(rejects.as_rejects(bad, F.col("arrival_ts")), root)
    stored = rejects.read(spark, root)
    replay.replay(rejects.drain(stored, None), f"{root}/replayed", fx.AS_OF, path=f"{root}/target")
    return rejects.by_type(replay.remaining(stored, spark.read.parquet(f"{root}/replayed")))


@query(
    f"""WITH {RECORDS}
SELECT error_type, count(*) AS rejects FROM first_records
WHERE error_type IS NOT NULL AND arrival_ts >= TIMESTAMP '2024-01-17' GROUP BY 1"""
)
def expire_rejects(spark, sf_dir):
    bad = validate.bad(validate.check(fx.records(spark, sf_dir)))
    return rejects.by_type(replay.expire(rejects.as_rejects(bad, F.col("arrival_ts")), fx.AS_OF))


@query(
    """SELECT 'user_' || user_id AS key, '{"user_id":"user_' || user_id || '","event_id":"' || event_id || '"}' AS value
FROM events"""
)
def publish_keyed(spark, sf_dir):
    folder = work_folder(spark, "published")
    events = fx.fact(spark, sf_dir).select("user_id", "event_id")
    records.publish(events, folder, order_by="event_id")
    return spark.read.schema("key string, value string").json(folder)


def _zones(spark, sf_dir):
    """A root with landed lines, rejects and replayed ids of a month, and the root of its seen keys."""
    root = work_folder(spark, "zones")
    checked = validate.check(fx.records(spark, sf_dir))
    good = validate.good(checked)
    landing.land(enrich.enrich(good).withColumn("delivered_at", F.date_trunc("day", "arrival_ts")), root)
    rejects.store(rejects.as_rejects(validate.bad(checked), F.col("arrival_ts")), root)
    replay.replay(rejects.drain(rejects.read(spark, root)), f"{root}/replayed", fx.AS_OF, path=f"{root}/target")
    keys.add(dedupe.seen_keys(good, F.col("arrival_ts")), f"{root}/keys", "run")
    return root, f"{root}/keys"


def _rows_by_day(spark, root, keys_root):
    """Rows of every day that has files, whether in use or not."""
    counted = None
    for name, zone in retention_job.zones(root, keys_root).items():
        for day, folder in zone.held(spark).items():
            files = spark.read.option("recursiveFileLookup", "true")
            stored = files.parquet(folder) if name in ("replayed", "keys") else files.text(folder)
            one = stored.agg(F.lit(name).alias("zone"), F.lit(day).alias("day"), F.count(F.lit(1)).alias("rows"))
            counted = one if counted is None else counted.unionByName(one)
    return counted


_ZONE_NOW = dt.datetime(2024, 1, 31, 12, tzinfo=dt.timezone.utc)
_ZONE_DAYS = f"""{RECORDS}, stored AS (
  SELECT 'landing' AS zone, CAST(arrival_ts AS DATE) AS day, DATE '2024-01-11' AS first
  FROM first_records WHERE error_type IS NULL
  UNION ALL SELECT 'keys', CAST(arrival_ts AS DATE), DATE '2024-01-30' FROM first_records WHERE error_type IS NULL
  UNION ALL SELECT 'rejects', CAST(arrival_ts AS DATE), DATE '2024-01-17' FROM first_records WHERE error_type IS NOT NULL
  UNION ALL SELECT 'replayed', CAST(arrival_ts AS DATE), DATE '2024-01-17'
  FROM first_records WHERE error_type IS NOT NULL AND error_type NOT IN ('bad_json', 'bad_encoding'))"""


@query(f"WITH {_ZONE_DAYS} SELECT zone, day, count(*) AS rows FROM stored WHERE day >= first GROUP BY 1, 2")
def expire_zones(spark, sf_dir):
    """What lies on disk of a month in four zones after retention: 20 days of events, 14 of rejects, a day of keys."""
    root, keys_root = _zones(spark, sf_dir)
    retention_job.expire(spark, root, _ZONE_NOW, keys_root, event_days=20, grace_seconds=0)
    return _rows_by_day(spark, root, keys_root)


@query(f"WITH {_ZONE_DAYS} SELECT zone, count(*) AS rows, count(*) FILTER (day >= first) AS in_use FROM stored GROUP BY 1")
def retire_zones(spark, sf_dir):
    """Within the grace all files are still there, and readers see the days in use only."""
    root, keys_root = _zones(spark, sf_dir)
    retention_job.expire(spark, root, _ZONE_NOW, keys_root, event_days=20)
    read = {
        "landing": landing.read_lines(spark, root),
        "rejects": rejects.read(spark, root),
        "replayed": replay.replayed(spark, f"{root}/replayed")[0],
        "keys": keys.read(spark, keys_root, "2024-01-01 00:00:00"),
    }
    seen = None
    for name, rows in read.items():
        one = rows.agg(F.lit(name).alias("zone"), F.count(F.lit(1)).alias("in_use"))
        seen = one if seen is None else seen.unionByName(one)
    every = _rows_by_day(spark, root, keys_root).groupBy("zone").agg(F.sum("rows").alias("rows"))
    return every.join(seen, "zone")


@query(f"""WITH {RECORDS}, bad AS (SELECT *, CAST(arrival_ts AS DATE) AS day FROM first_records WHERE error_type IS NOT NULL)
SELECT error_type, count(*) AS rejects FROM bad
WHERE day >= DATE '2024-01-20' AND (error_type IN ('bad_json', 'bad_encoding') OR day >= DATE '2024-01-25') GROUP BY 1""")
def replay_open_by_day(spark, sf_dir):
    """Rejects still open after those before a day were replayed, among the days in use."""
    root = work_folder(spark, "replay-days")
    bad = validate.bad(validate.check(fx.records(spark, sf_dir)))
    rejects.store(rejects.as_rejects(bad, F.col("arrival_ts")), root)
    early = rejects.read(spark, root).where("rejected_at < '2024-01-25'")
    replay.replay(early, f"{root}/replayed", fx.AS_OF, path=f"{root}/target")
    retention_job.expire(spark, root, dt.datetime(2024, 2, 3, tzinfo=dt.timezone.utc))
    return rejects.by_type(replay.open_rejects(spark, root))


@query(f"WITH {FACT} SELECT event_id, event_ts FROM fact WHERE event_ts >= TIMESTAMP '2024-01-11'")
def retention(spark, sf_dir):
    rows = maintain.retained(fx.fact(spark, sf_dir), "2024-01-31 12:00:00", days=20)
    return rows.select("event_id", "event_ts")


@query(f"WITH {FACT} SELECT event_id, event_ts FROM fact WHERE event_ts >= TIMESTAMP '2024-01-11'")
def retention_of_table(spark, sf_dir):
    table = FactTable(spark, work_folder(spark, "table"))
    table.commit(fx.fact(spark, sf_dir))
    maintain.apply_retention(table, dt.date(2024, 1, 31), days=20)
    return table.read().select("event_id", "event_ts")


@query(
    f"""WITH {FACT} SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS rows, CAST(0 AS BIGINT) AS unsorted_rows,
  true AS one_version FROM fact GROUP BY 1"""
)
def compact_sort(spark, sf_dir):
    """Several loads per date, compacted: one version each, files in time order."""
    table = FactTable(spark, work_folder(spark, "table"))
    rows = fx.fact(spark, sf_dir)
    for kind in fx.EVENT_TYPES:
        table.commit(rows.where(F.col("event_type") == kind))
    maintain.compact(table, min_rows=0)
    files = maintain.unsorted_files(table.read())
    date = F.to_date(F.regexp_extract("part", r"event_date=([0-9-]+)", 1))
    per_date = files.groupBy(date.alias("event_date")).agg(
        F.sum("rows").alias("rows"), F.sum("unsorted_rows").alias("unsorted_rows")
    )
    versions = table.live().groupBy(F.to_date("event_date").alias("event_date")).agg(
        (F.count(F.lit(1)) == 1).alias("one_version")
    )
    return per_date.join(versions, "event_date")


@query(
    f"""WITH {FACT} SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS rows, min(event_ts) AS min_ts,
  max(event_ts) AS max_ts, true AS sized FROM fact GROUP BY 1"""
)
def file_stats(spark, sf_dir):
    """Per date; how many files a date has is up to the cluster."""
    table = FactTable(spark, work_folder(spark, "table"))
    table.commit(fx.fact(spark, sf_dir))
    files = maintain.file_stats(table.read())
    date = F.to_date(F.regexp_extract("file", r"event_date=([0-9-]+)", 1))
    return files.groupBy(date.alias("event_date")).agg(
        F.sum("rows").alias("rows"),
        F.min("min_ts").alias("min_ts"),
        F.max("max_ts").alias("max_ts"),
        (F.min("size_bytes") > 0).alias("sized"),
    )


def _in_the_middle(monkeyed, action):
    """Run an action once, after the table's next write of data and before its commit."""
    original = monkeyed.write

    def write(version, rows):
        entries = original(version, rows)
        if monkeyed.write is write:
            monkeyed.write = original
            action()
        return entries

    monkeyed.write = write


_VALUES = """SELECT event_id, CAST(event_ts AS DATE) AS event_date, CAST(value AS DOUBLE) AS value"""


@query(
    f"""WITH {FACT} {_VALUES} FROM fact WHERE event_type <> 'purchase'
UNION ALL SELECT event_id, CAST(event_ts AS DATE), CAST(value + 1 AS DOUBLE) FROM fact WHERE event_type = 'purchase'"""
)
def compact_with_load(spark, sf_dir):
    """A load replaces rows of every date while a compaction of those dates is under way."""
    root = work_folder(spark, "table")
    table, other = FactTable(spark, root), FactTable(spark, root)
    rows = fx.fact(spark, sf_dir)
    for kind in fx.EVENT_TYPES:
        table.commit(rows.where(F.col("event_type") == kind))
    _in_the_middle(table, lambda: load.merge(other, _raised(rows, 1)))
    maintain.compact(table)
    maintain.compact(table)
    return table.read().select("event_id", "event_date", F.col("value").cast("double").alias("value"))


@query(
    f"""WITH {FACT} {_VALUES} FROM fact WHERE event_type <> 'purchase' AND event_ts >= TIMESTAMP '2024-01-11'
UNION ALL SELECT event_id, CAST(event_ts AS DATE), CAST(value + 2 AS DOUBLE) FROM fact WHERE event_type = 'purchase'"""
)
def loads_at_once(spark, sf_dir):
    """Two loads of the same ids and a retention at the same time: the last to commit replaces the other's rows.

    Retention takes the dates out of use that are there; what a load commits later stays.
    """
    root = work_folder(spark, "table")
    table, second, third = (FactTable(spark, root) for _ in range(3))
    rows = fx.fact(spark, sf_dir)
    table.commit(rows.where("event_type <> 'purchase'"))

    def others():
        load.merge(second, _raised(rows, 1))
        maintain.apply_retention(third, dt.date(2024, 1, 31), days=20)

    _in_the_middle(table, others)
    load.merge(table, _raised(rows, 2))
    return table.read().select("event_id", "event_date", F.col("value").cast("double").alias("value"))


@query(
    f"""WITH {FACT} SELECT CAST(event_ts AS DATE) AS event_date, count(*) AS rows, CAST(1 AS BIGINT) AS folders
FROM fact GROUP BY 1"""
)
def compact_small_dates(spark, sf_dir):
    """Three small loads to a date become one folder, whatever their rows."""
    table = FactTable(spark, work_folder(spark, "table"))
    rows = fx.fact(spark, sf_dir)
    for part in range(3):
        table.commit(rows.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == part))
    maintain.compact(table)
    return table.live().groupBy(F.to_date("event_date").alias("event_date")).agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("folders")
    )


@query(f"WITH {FACT} SELECT event_id, event_ts, kinesis_seq FROM fact WHERE event_id IN ('17', '4711', '100') AND event_type <> 'error'")
def find_events(spark, sf_dir):
    """Rows of a few ids through the table's id lookup."""
    table = FactTable(spark, work_folder(spark, "table"))
    rows = fx.fact(spark, sf_dir)
    for kind in fx.EVENT_TYPES:
        table.commit(rows.where((F.col("event_type") == kind) & (F.col("event_type") != "error")))
    return table.find(["17", "4711", "100", "none"]).select("event_id", "event_ts", "kinesis_seq")
