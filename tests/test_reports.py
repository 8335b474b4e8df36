"""Reports on small hand-made tables, and the shape of their plans."""

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import START, facts, plan, rows
from tidemark.plans import reports
from tidemark.sources.fact import FactTable

AS_OF = "2024-05-27 15:00:00"


def minutes(n):
    return START + dt.timedelta(minutes=n)


def test_events_per_minute_looks_back_one_hour(spark):
    df = facts(
        spark,
        [
            {"event_ts": minutes(-1), "user_id": "a"},
            {"event_ts": minutes(0), "user_id": "a"},
            {"event_ts": minutes(0.5), "user_id": "a", "event_type": "error"},
            {"event_ts": minutes(30), "user_id": "b"},
            {"event_ts": minutes(61), "user_id": "c"},
        ],
    )
    got = [tuple(r) for r in reports.events_per_minute(df, AS_OF).collect()]
    # Events in the future count here; the closed range of the active-user report drops them.
    assert got == [(minutes(61), 1, 1, 0), (minutes(30), 1, 1, 0), (minutes(0), 2, 1, 1)]
    assert rows(reports.active_users(df, AS_OF)) == [(minutes(0), 1, 2), (minutes(30), 1, 1)]


def test_top_types_ties_and_averages(spark):
    df = facts(
        spark,
        [
            {"event_type": "b", "duration_ms": 1, "value": Decimal("0.01")},
            {"event_type": "b", "duration_ms": 2, "value": Decimal("0.02")},
            {"event_type": "a", "duration_ms": None, "value": None},
            {"event_type": "a"},
            {"event_type": "c"},
        ],
    )
    got = [tuple(r) for r in reports.top_event_types(df, AS_OF, top=2).collect()]
    assert got == [("a", 2, 1, None, None), ("b", 2, 1, 1.5, 0.02)]


def test_funnel_counts_users_not_events(spark):
    kinds = [("a", "page_view"), ("a", "page_view"), ("a", "purchase"), ("b", "page_view"),
             ("b", "add_to_cart"), ("c", "purchase"), ("d", "search")]
    df = facts(spark, [{"user_id": u, "event_type": t} for u, t in kinds])
    assert tuple(reports.funnel(df, AS_OF).first()) == (2, 1, 2, 50.0, 200.0, 100.0)
    # Only today counts.
    assert tuple(reports.funnel(df, "2024-05-28 01:00:00").first()) == (None,) * 6
    # Users without any step give zeros, not NULL, and no division by zero.
    assert tuple(reports.funnel(df.where("user_id = 'd'"), AS_OF).first()) == (0, 0, 0, None, None, None)


def test_duplicates_by_load_time(spark):
    df = facts(
        spark,
        [
            {"event_id": "x", "loaded_at": minutes(10)},
            {"event_id": "x", "loaded_at": minutes(20), "event_ts": minutes(1)},
            {"event_id": "y", "loaded_at": minutes(-100)},
            {"event_id": "y", "loaded_at": minutes(10)},
        ],
    )
    assert rows(reports.duplicate_events(df, AS_OF)) == [("x", 2, minutes(0), minutes(1), minutes(10), minutes(20))]
    assert rows(reports.duplicate_check(df)) == [("x", 2), ("y", 2)]


def test_latency_percentiles_against_brute_force(spark):
    draw = random.Random(5)
    # Two thirds of the rows in one hour, with many equal latencies.
    made = []
    for i in range(400):
        hour = 0 if draw.random() < 0.66 else draw.randrange(1, 6)
        ts = START - dt.timedelta(hours=hour) + dt.timedelta(milliseconds=draw.randrange(3_599_000))
        made.append({"event_ts": ts, "loaded_at": ts + dt.timedelta(milliseconds=draw.randrange(90_000))})
    made.append({"event_ts": START, "loaded_at": None})

    def interpolated(values, p):
        values = sorted(values)
        place = p * (len(values) - 1)
        low = int(place)
        high = min(low + 1, len(values) - 1)
        return values[low] + (values[high] - values[low]) * (place - low)

    hours = {}
    for r in made:
        cut = r["event_ts"].replace(minute=0, second=0, microsecond=0)
        hours.setdefault(cut, []).append(r)
    for row in reports.load_latency(facts(spark, made), AS_OF).collect():
        group = hours.pop(row["event_hour"])
        waits = [
            int(r["loaded_at"].replace(microsecond=0).timestamp()) - int(r["event_ts"].replace(microsecond=0).timestamp())
            for r in group
            if r["loaded_at"]
        ]
        assert row["events_loaded"] == len(group)
        assert row["avg_latency_secs"] == pytest.approx(statistics.fmean(waits), abs=0.0501)
        for name, p in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            assert row[f"{name}_latency_secs"] == pytest.approx(interpolated(waits, p), abs=0.0501)
    assert not hours


def test_sliding_windows_against_brute_force(spark):
    draw = random.Random(7)
    made = [
        {"event_ts": minutes(draw.randrange(40)) + dt.timedelta(seconds=draw.randrange(60)),
         "user_id": "hot" if draw.random() < 0.4 else f"u{draw.randrange(9)}"}
        for _ in range(300)
    ]
    expected = {}
    for r in made:
        cut = r["event_ts"].replace(second=0)
        for back in range(5):
            users, n = expected.get(cut - dt.timedelta(minutes=back), (set(), 0))
            expected[cut - dt.timedelta(minutes=back)] = (users | {r["user_id"]}, n + 1)
    got = {r["window_start"]: (r["active_users"], r["events"])
           for r in reports.active_users_sliding(facts(spark, made), AS_OF).collect()}
    assert got == {k: (len(u), n) for k, (u, n) in expected.items()}


def test_error_rate_only_for_busy_pages(spark):
    made = [{"page": None, "event_type": "error" if i < 3 else "click"} for i in range(11)]
    made += [{"page": "/quiet", "event_type": "error"} for _ in range(10)]
    assert rows(reports.error_rate_by_page(facts(spark, made), AS_OF)) == [("unknown", 11, 3, 27.27)]


def test_distinct_users_are_reduced_per_user_first(spark):
    """A busy minute is spread by user before it is counted."""
    text = plan(reports.events_per_minute(facts(spark, [{}]), AS_OF))
    assert text.count("Exchange hashpartitioning") == 2
    assert "user_id" in text.split("Exchange hashpartitioning")[2].split("\n")[0]


def test_top_k_needs_no_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(reports.top_event_types(facts(spark, [{}]), AS_OF))


def test_time_filter_prunes_dates_and_reaches_the_files(spark, folder):
    table = FactTable(spark, folder)
    table.commit(facts(spark, [{"event_ts": START - dt.timedelta(days=i)} for i in range(6)]))
    text = plan(reports.revenue_by_hour(table.read(), AS_OF, days=2))
    scan = text[text.index("FileScan"):]
    assert "event_date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(event_ts" in scan and "EqualTo(event_type,purchase)" in scan
    assert "ReadSchema: struct<event_type:string,event_ts:timestamp,value:decimal(12,2)>" in scan


def test_latency_is_counted_before_the_shuffle(spark):
    text = plan(reports.load_latency(facts(spark, [{}]), AS_OF))
    assert "percentile(latency" in text
    first = text.split("Exchange hashpartitioning(")[-1].split("\n")[0]
    assert "latency" in first


def test_empty_table(spark):
    empty = facts(spark, [{}]).where("false")
    for make in (reports.events_per_minute, reports.top_event_types, reports.revenue_by_hour,
                 reports.duplicate_events, reports.load_latency, reports.active_users,
                 reports.active_users_sliding, reports.error_rate_by_page):
        assert make(empty, AS_OF).count() == 0


def test_default_as_of_is_now(spark):
    now = facts(spark, [{}]).withColumn("event_ts", F.current_timestamp())
    assert reports.events_per_minute(now).count() == 1


def test_funnel_takes_any_number_of_steps(spark):
    rows = [("u1", "view"), ("u1", "cart"), ("u1", "pay"), ("u1", "rate"), ("u2", "view"), ("u2", "cart"), ("u3", "view")]
    events = spark.createDataFrame(rows, "user_id string, event_type string").selectExpr(
        "*", "timestamp'2024-01-01 10:00:00' as event_ts", "date'2024-01-01' as event_date"
    )
    for steps, counts in ((["view", "cart", "pay", "rate"], [3, 2, 1, 1]), (["view", "cart"], [3, 2])):
        row = reports.funnel(events, "2024-01-01 12:00:00", steps).first()
        assert [row[f"step{i}_{s}"] for i, s in enumerate(steps, 1)] == counts
        assert float(row["step1_to_step2_pct"]) == pytest.approx(66.67, abs=0.01)


def test_latency_sketches_merge_within_their_rank_error(spark):
    n = 200_000
    at = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 7200)
    latency = F.pmod(F.xxhash64("id"), F.lit(50_000)) * F.pmod(F.xxhash64("id"), F.lit(3))
    events = spark.range(n).select(at.alias("event_ts"), F.timestamp_seconds(F.unix_seconds(at) + latency).alias("loaded_at"))
    events = events.unionByName(events.limit(50).withColumn("loaded_at", F.lit(None).cast("timestamp")))
    rolled = reports.load_latency_rollup(reports.latency_sketches(events), "2023-11-15 12:00:00", 24)
    exact = reports.load_latency(events, "2023-11-15 12:00:00", 24)
    assert rows(rolled, "event_hour", "events_loaded", "avg_latency_secs") == rows(exact, "event_hour", "events_loaded", "avg_latency_secs")
    for r in rolled.collect():
        own = events.where((F.date_trunc("hour", "event_ts") == F.lit(r["event_hour"])) & F.col("loaded_at").isNotNull())
        for name, rank in (("p50", 0.5), ("p95", 0.95), ("p99", 0.99)):
            s = F.unix_seconds("loaded_at") - F.unix_seconds("event_ts")
            low, high = own.agg(F.avg((s < r[f"{name}_latency_secs"]).cast("int")), F.avg((s <= r[f"{name}_latency_secs"]).cast("int"))).first()
            assert low <= rank + 0.006 and high >= rank - 0.006
