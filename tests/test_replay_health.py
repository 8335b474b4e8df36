"""Replay, alarms, backlog, shards and table statistics."""

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from helpers import START, encoded, facts, payload, records, rows
from tidemark.operators import alarms, validate
from tidemark.plans import health, maintain, replay
from tidemark.schema import BATCH_LOG_SCHEMA, PREVIEW_CHARS
from tidemark.sources import rejects


def wrapper(*bodies, **extra):
    inside = [{"kinesis": {"sequenceNumber": f"s{i}", "data": encoded(b)}} for i, b in enumerate(bodies)]
    return json.dumps({"requestContext": {"condition": "x"}, "requestPayload": {"Records": inside}, **extra})


def messages(spark, bodies):
    return spark.createDataFrame([(str(i), b) for i, b in enumerate(bodies)], "reject_id string, body string")


def test_unwrap(spark):
    one, two = json.dumps(payload("1")), json.dumps(payload("2"))
    empty = '{"requestContext":{},"requestPayload":{"Records":[]}}'
    bare = '{"requestContext":{}}'
    bodies = [wrapper(one), wrapper(one, two), empty, one, "not-json", "[1]", bare, wrapper("@@@")]
    got = rows(replay.unwrap(messages(spark, bodies)), "reject_id", "original_sequence", "payload")
    assert got == sorted(
        [("0", "s0", one), ("1", "s0", one), ("1", "s1", two), ("2", None, empty), ("3", None, one),
         ("4", None, None), ("5", None, "[1]"), ("6", None, bare), ("7", "s0", "@@@")],
        key=repr,
    )


def test_replay_messages_and_preview(spark):
    long = json.dumps(payload("9", extra="x" * 500))
    bodies = [json.dumps(payload(str(i))) for i in range(5)] + [long, "not-json", '{"a": 1}']
    unwrapped = replay.unwrap(messages(spark, bodies))
    keys = dict(rows(replay.to_messages(unwrapped), "reject_id", "key"))
    assert keys["0"] == "user_001" and keys["7"] == "replay-7" and "6" not in keys
    plan = replay.dry_run(unwrapped)
    samples = plan.pop("samples").collect()
    assert plan == {"sent": 0, "failed": 0, "dry_run": 7}
    assert len(samples) == 5 and all(len(r["sample"]) <= PREVIEW_CHARS for r in samples)


def stored_rejects(spark, folder, bodies):
    checked = validate.bad(validate.check(records(spark, bodies)))
    rejects.store(rejects.as_rejects(checked, F.col("arrival_ts")), folder)
    return rejects.read(spark, folder)


def test_replay_goes_by_id(spark, folder):
    stored = stored_rejects(
        spark, folder, [("1", {"user_id": "u1"}), ("2", "not-json"), ("3", {"user_id": "u2"}), ("4", {"event_id": 5})]
    )
    first_two = rejects.drain(stored, 2)
    assert rows(first_two, "sequence_number") == [("1",), ("2",)]
    sent = replay.replay(first_two, f"{folder}/replayed", "2024-06-01", path=f"{folder}/target")
    assert sent == {"sent": 1, "failed": 0}
    left = replay.remaining(stored, spark.read.parquet(f"{folder}/replayed"))
    assert rows(left, "sequence_number") == [("2",), ("3",), ("4",)]
    assert spark.read.json(f"{folder}/target").first()["key"] == "u1"


def test_replay_that_fails_notes_nothing(spark, folder):
    stored = stored_rejects(spark, folder, [("1", {"user_id": "u1"})])
    with pytest.raises(Exception) as failure:
        replay.replay(stored, f"{folder}/replayed", "2024-06-01", path="/proc/nowhere")
    assert failure.value.result == {"sent": 0, "failed": 1}
    import os

    assert not os.path.exists(f"{folder}/replayed")


def test_expiry(spark, folder):
    stored = stored_rejects(spark, folder, [("1", "x"), ("2", "y")])
    assert replay.expire(stored, START + dt.timedelta(days=14)).count() == 2
    assert replay.expire(stored, START + dt.timedelta(days=14, seconds=1)).count() == 1


def metric(spark, values, name="m"):
    made = [(name, START + dt.timedelta(minutes=m), float(v)) for m, v in values]
    return spark.createDataFrame(made, "metric string, period timestamp, value double")


def test_alarm_needs_consecutive_periods(spark):
    values = metric(spark, [(0, 11), (1, 12), (2, 5), (4, 20), (5, 20), (7, 20)])
    got = [(r["value"], r["breached"]) for r in alarms.alarm(values, 10, 2).orderBy("period").collect()]
    assert got == [(11, False), (12, True), (5, False), (0, False), (20, False), (20, True), (0, False), (20, False)]
    once = [r["breached"] for r in alarms.alarm(values, 10, 1).orderBy("period").collect()]
    assert once == [True, True, False, False, True, True, False, True]
    at_limit = alarms.alarm(metric(spark, [(0, 10), (1, 10)]), 10, 1)
    assert not any(r["breached"] for r in at_limit.collect())


def test_alarm_table_judges_each_dimension(spark):
    rows_of = metric(spark, [(0, 901), (1, 5)], "records_per_second_per_shard/1").unionByName(
        metric(spark, [(0, 900)], "records_per_second_per_shard/2")).unionByName(
        metric(spark, [(0, 11), (1, 11), (2, 11)], "errors"))
    got = {r["metric"]: (r["periods"], r["breached_periods"], r["first_breach"]) for r in alarms.alarm_table(rows_of).collect()}
    assert got == {
        "records_per_second_per_shard/1": (2, 1, START),
        "records_per_second_per_shard/2": (1, 0, None),
        "errors": (3, 2, START + dt.timedelta(minutes=1)),
    }


def test_backlog_against_brute_force(spark):
    draw = random.Random(13)
    came = [START + dt.timedelta(seconds=draw.randrange(20_000)) for _ in range(80)]
    went = [t + dt.timedelta(seconds=draw.randrange(60, 9_000)) for t in came if draw.random() < 0.6]
    got = health.reject_backlog(
        spark.createDataFrame([(t,) for t in came], "rejected_at timestamp"),
        spark.createDataFrame([(t,) for t in went], "replayed_at timestamp"),
    ).orderBy("period").collect()

    def waiting(minute):
        end = minute + dt.timedelta(minutes=1)
        return sum(t < end for t in came) - sum(t < end for t in went)

    for row in got:
        inside = [waiting(row["period"] + dt.timedelta(minutes=m)) for m in range(-1, 5)]
        assert row["backlog"] == max(inside)
    gaps = {b["period"] - a["period"] for a, b in zip(got, got[1:])}
    assert gaps == {dt.timedelta(minutes=5)}


def test_shards(spark):
    points = spark.createDataFrame(
        [("1", START, health.INCOMING, 30_000.0), ("1", START - dt.timedelta(seconds=60), health.INCOMING, 5.0),
         ("2", START - dt.timedelta(seconds=60), health.INCOMING, 48_000.0), ("2", START, health.THROTTLES, 3.0),
         ("3", START - dt.timedelta(seconds=180), health.INCOMING, 99.0), ("4", START, health.INCOMING, 90_000.0)],
        "shard_id string, period timestamp, metric string, value double",
    )
    shards = spark.createDataFrame(
        [("1", None), ("2", None), ("3", None), ("4", None), ("5", "9")],
        "shard_id string, ending_sequence_number string",
    )
    latest = health.latest_points(points, START, 60)
    got = [tuple(r) for r in health.shard_utilisation(shards, latest, 60).collect()]
    assert got == [
        ("1", 500.0, 50.0, "green", 0.0),
        ("2", 800.0, 80.0, "yellow", 3.0),
        ("3", 0.0, 0.0, "green", 0.0),
        ("4", 1500.0, 100.0, "red", 0.0),
    ]


def test_batch_metrics(spark):
    log = spark.createDataFrame(
        [(i, START, d, 1, 1, 0, 0, f) for i, (d, f) in enumerate([(100, 0), (200, 1), (400, 0)])], BATCH_LOG_SCHEMA
    )
    assert rows(health.batch_counts(log)) == [(START, 3, 1)]
    assert rows(health.batch_durations(log)) == [(START, 200.0, 396.0)]


def test_unsorted_share_against_brute_force(spark):
    draw = random.Random(17)
    made = [(f"f{draw.random() < 0.3}", i, START + dt.timedelta(seconds=draw.randrange(500))) for i in range(400)]
    for chunk in (7, 1000):
        got = maintain.unsorted_share(
            spark.createDataFrame(made, "part string, pos long, ts timestamp"), "part", "pos", "ts", chunk
        ).collect()
        for row in got:
            top, late, n = None, 0, 0
            for part, _, ts in made:
                if part == row["part"]:
                    late += top is not None and ts < top
                    top = ts if top is None else max(top, ts)
                    n += 1
            assert (row["rows"], row["unsorted_rows"]) == (n, late)


def test_skew_report(spark):
    df = facts(spark, [{"user_id": "hot"}] * 30 + [{"user_id": f"u{i}"} for i in range(10)])
    row = maintain.skew_report(df, slices=4).first()
    assert row["slice_count"] == 4 and row["avg_rows_per_slice"] == 10.0
    assert row["max_rows_per_slice"] >= 30 and row["skew_ratio"] == row["max_rows_per_slice"] / 10
    assert rows(maintain.hot_keys(df, top=1)) == [("hot", 30)]


def test_sort_and_retention(spark):
    draw = random.Random(19)
    df = facts(spark, [{"event_ts": START + dt.timedelta(seconds=draw.randrange(9_999))} for _ in range(100)])
    ordered = [r["event_ts"] for r in maintain.sort_rows(df).collect()]
    assert ordered == sorted(ordered)
    old = facts(spark, [{"event_ts": START - dt.timedelta(days=d)} for d in (0, 364, 365, 366)])
    assert maintain.retained(old, START).count() == 3


def test_statistics_of_a_catalog_table(spark):
    facts(spark, [{}, {}]).write.mode("overwrite").saveAsTable("stats_test")
    maintain.refresh_statistics(spark, "stats_test")
    described = spark.sql("DESCRIBE EXTENDED stats_test").where("col_name = 'Statistics'").first()["data_type"]
    assert "2 rows" in described
    column = spark.sql("DESCRIBE EXTENDED stats_test event_type").where("info_name = 'distinct_count'").first()
    assert column["info_value"] == "1"
