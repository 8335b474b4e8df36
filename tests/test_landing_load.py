"""Landing zone, fact table, load job and its failure cases."""

import datetime as dt
import gzip
import json
import os
import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from helpers import START, encoded, facts, payload, plan, records, rows
from tidemark import session
from tidemark.operators import enrich, validate
from tidemark.plans import load, maintain
from tidemark.schema import LOAD_AUDIT_SCHEMA
from tidemark.sources import landing, records as record_source, rejects
from tidemark.sources.fact import FactTable


def lines_of(spark, bodies, delivered=START):
    good = validate.good(validate.check(records(spark, bodies)))
    return enrich.enrich(good).withColumn("delivered_at", F.lit(delivered))


def files(root):
    return sorted(str(p.relative_to(root)) for p in Path(root).rglob("part-*"))


def test_landing_layout_and_round_trip(spark, folder):
    landing.land(lines_of(spark, [("1", payload("a", _tag="t")), ("2", payload("b"))]), folder, batch_id=3)
    found = files(folder)
    assert len(found) == 1
    assert found[0].startswith("events/year=2024/month=05/day=27/hour=14/batch_id=3/") and found[0].endswith(".gz")
    with gzip.open(os.path.join(folder, found[0]), "rt") as handle:
        landed = [json.loads(x) for x in handle]
    assert [x["event_id"] for x in landed] == ["a", "b"] and landed[0]["_tag"] == "t"
    back = landing.read_lines(spark, folder)
    assert rows(back, "year", "month", "day", "hour")[0] == ("2024", "05", "27", "14")


def test_landing_a_batch_again_replaces_it(spark, folder):
    for _ in range(2):
        landing.land(lines_of(spark, [("1", payload())]), folder, batch_id=1)
    landing.land(lines_of(spark, [("2", payload())]), folder, batch_id=2)
    assert landing.read_lines(spark, folder).count() == 2


def test_a_busy_hour_is_cut_into_files(spark, folder):
    landing.land(lines_of(spark, [(str(i), payload(str(i))) for i in range(50)]), folder, max_lines=20)
    assert len(files(folder)) == 3


def test_hour_scan_reads_one_folder(spark, folder):
    for hour in (13, 14):
        landing.land(lines_of(spark, [(str(hour), payload())], START.replace(hour=hour)), folder, batch_id=hour)
    one = landing.read_lines(spark, folder, 2024, 5, 27, 13)
    assert rows(one, "hour") == [("13",)]
    assert "PartitionFilters: [isnotnull(year" in plan(one)
    prefix = landing.read_prefix(spark, f"{folder}/events/year=2024/month=05/day=27/hour=14/")
    assert prefix.count() == 1


def test_old_days_expire(spark, folder):
    for n in (0, 364, 365, 366):
        landing.land(lines_of(spark, [(str(n), payload())], START - dt.timedelta(days=n)), folder, batch_id=n)
    removed = landing.expire(spark, folder, START.date())
    assert [r[-23:] for r in removed] == ["year=2023/month=05/day=27"[-23:]]
    assert landing.read_lines(spark, folder).count() == 3


def test_view_over_landing(spark, folder):
    landing.land(lines_of(spark, [("1", payload("a")), ("2", payload("b"))]), folder)
    landing.create_view(spark, folder, "landed_test")
    assert rows(spark.sql("SELECT event_id, kinesis_seq FROM landed_test")) == [("a", "1"), ("b", "2")]


def staged_lines(spark, events, file="f"):
    body = [
        (json.dumps({"event_id": i, "event_type": "x", "timestamp": t, "user_id": "u",
                     "properties": {"value": v}, "_meta": {"kinesis_sequence": s}}), file)
        for i, t, v, s in events
    ]
    return spark.createDataFrame(body, "line string, file string")


def day(n, hour=1):
    return f"2024-05-{n:02d}T{hour:02d}:00:00Z"


def test_load_upserts_across_dates(spark, folder):
    """An id whose event time moved to another date leaves the old date."""
    table = FactTable(spark, folder)
    first = load.load(table, staged_lines(spark, [("a", day(1), 1, "1"), ("b", day(1), 2, "2"), ("c", day(2), 3, "3")]), "one")
    assert (first["rows_loaded"], first["lines_failed"], first["source"]) == (3, 0, "one")
    load.load(table, staged_lines(spark, [("a", day(3), 9, "9"), ("d", day(2), 4, "4")]), "two")
    got = rows(table.read(), "event_id", F.col("value").cast("int"), F.col("event_date").cast("string"))
    assert got == [("a", 9, "2024-05-03"), ("b", 2, "2024-05-01"), ("c", 3, "2024-05-02"), ("d", 4, "2024-05-02")]


def test_load_without_matches_only_adds_files(spark, folder):
    table = FactTable(spark, folder)
    load.load(table, staged_lines(spark, [("a", day(1), 1, "1")]), "one")
    before = set(files(folder))
    load.load(table, staged_lines(spark, [("b", day(1), 1, "2")]), "two")
    assert before <= set(files(folder))
    live = table.live().collect()
    assert [r["event_date"] for r in live] == ["2024-05-01"] * 2 and {r["rows"] for r in live} == {1}
    assert table.read().count() == 2


def test_loading_the_same_lines_again_changes_nothing(spark, folder):
    table = FactTable(spark, folder)
    lines = staged_lines(spark, [("a", day(1), 1, "1"), ("a", day(1), 2, "2"), ("b", day(2), 1, "3")])
    for _ in range(2):
        load.load(table, lines, "same")
    assert rows(table.read(), "event_id", "kinesis_seq") == [("a", "1"), ("a", "2"), ("b", "3")]
    load.load(table, lines, "latest", intra_batch="latest")
    assert rows(table.read(), "event_id", "kinesis_seq") == [("a", "2"), ("b", "3")]


def test_load_rewrites_only_folders_with_a_match(spark, folder):
    table = FactTable(spark, folder)
    load.load(table, staged_lines(spark, [("a", day(1), 1, "1")]), "one")
    load.load(table, staged_lines(spark, [("b", day(1), 1, "2")]), "two")
    untouched, touched = sorted(r["version"] for r in table.live().collect())
    load.load(table, staged_lines(spark, [("b", day(1), 2, "3")]), "three")
    versions = {r["version"] for r in table.live().collect()}
    assert untouched in versions and touched not in versions and len(versions) == 2
    assert rows(table.read(), "event_id", "kinesis_seq") == [("a", "1"), ("b", "3")]


@pytest.mark.parametrize("limit", [load.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("match_dates", ["all", "staged"])
def test_loads_against_brute_force(spark, folder, limit, match_dates):
    """Random loads, with the ids broadcast and with both sides shuffled."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    draw = random.Random(11)
    moving = match_dates == "all"
    table, held, seq = FactTable(spark, folder), [], 0
    try:
        for _ in range(3):
            events = []
            for _ in range(40):
                seq += 1
                number = 0 if draw.random() < 0.33 else draw.randrange(25)
                date = draw.randrange(1, 8) if moving else 1 + number % 7
                events.append((f"e{number}", day(date), seq, str(seq)))
            ids = {e[0] for e in events}
            held = [e for e in held if e[0] not in ids] + events
            load.load(table, staged_lines(spark, events), "x", match_dates=match_dates, broadcast_bytes=limit)
        got = sorted(tuple(r) for r in table.read().select("event_id", "kinesis_seq").collect())
        assert got == sorted((e[0], e[3]) for e in held)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_bad_lines_are_rejected_and_audited(spark, folder, utc):
    table = FactTable(spark, f"{folder}/fact")
    lines = staged_lines(spark, [("a", day(1), 1, "1"), ("b", "soon", 1, "2"), (None, day(1), 1, "3")], "file-1")
    lines = lines.unionByName(staged_lines(spark, [("z", day(1), 1, "4")], "file-2"))
    lines = lines.unionByName(spark.createDataFrame([("not json", "file-2")], lines.schema))
    result = load.load(table, lines, "s", f"{folder}/audit", f"{folder}/rejects", loaded_at=utc("2024-06-01T00:00:00"))
    assert (result["rows_loaded"], result["lines_failed"]) == (2, 3)
    stored = rejects.read(spark, f"{folder}/rejects")
    assert rows(stored, "sequence_number", "error_type", "error") == [
        ("2", "load_error", "no usable value for: event_ts"),
        ("3", "load_error", "no usable value for: event_id"),
        (None, "load_error", "no usable value for: event_id, event_type, event_ts, user_id"),
    ]
    audit = spark.read.parquet(f"{folder}/audit")
    assert set(audit.columns) == {*LOAD_AUDIT_SCHEMA.fieldNames(), "batch_id"}
    history = load.load_history(audit, "2024-06-01 12:00:00")
    assert rows(history, "file", "lines_scanned", "lines_loaded", "lines_failed", "success_pct") == [
        ("file-1", 3, 1, 2, 33.3), ("file-2", 2, 1, 1, 50.0)
    ]
    assert load.load_history(audit, "2024-06-03 00:00:00").count() == 0


def test_unusable_numbers_and_long_keys_are_rejected(spark, folder):
    def line(event_id, **properties):
        return json.dumps({"event_id": event_id, "event_type": "view", "timestamp": day(1), "user_id": "u", "properties": properties})

    bodies = [
        line("a", value="abc"), line("b", value=1e12), line("c", duration_ms="soon"), line("d", duration_ms=3e10),
        line("e" * 37), line("f", value=None, duration_ms=None), line("g", value=1.5, duration_ms=3), line("h" * 36),
    ]
    table = FactTable(spark, f"{folder}/fact")
    load.load(table, spark.createDataFrame([(b, "f") for b in bodies], "line string, file string"), "s", None, f"{folder}/rejects")
    assert sorted(r[0] for r in rows(table.read(), "event_id")) == ["f", "g", "h" * 36]
    assert sorted(r["error"] for r in rejects.read(spark, f"{folder}/rejects").collect()) == (
        ["no usable value for: duration_ms"] * 2 + ["no usable value for: value"] * 2 + ["too long: event_id"]
    )


def test_a_repeated_batch_changes_nothing(spark, folder, utc):
    table = FactTable(spark, f"{folder}/fact")
    lines = staged_lines(spark, [("a", day(1), 1, "1"), ("b", "soon", 1, "2")], "file-1")
    lines = lines.withColumn("loaded_at", F.lit(utc("2024-06-01T23:59:59")))
    seen = []
    for _ in range(2):
        load.load(table, lines, "s", f"{folder}/audit", f"{folder}/rejects", batch_id="load-7")
        audit = spark.read.parquet(f"{folder}/audit").drop("load_id")
        parts = table.read().drop("version"), rejects.read(spark, f"{folder}/rejects"), audit
        seen.append([sorted(map(str, df.collect())) for df in parts])
    assert seen[0] == seen[1] and [len(x) for x in seen[0]] == [1, 1, 1]


def test_loaded_at_is_one_time_for_a_load(spark, folder):
    table = FactTable(spark, folder)
    load.load(table, staged_lines(spark, [(str(i), day(1), 1, str(i)) for i in range(9)]).repartition(4), "x")
    assert table.read().select("loaded_at").distinct().count() == 1


def test_a_load_cleans_up_its_working_folder(spark, folder):
    before = set(os.listdir(f"{session.shared_root(spark)}/tidemark")) if os.path.isdir(
        f"{session.shared_root(spark)}/tidemark") else set()
    load.load(FactTable(spark, folder), staged_lines(spark, [("a", day(1), 1, "1")]), "x")
    left = set(os.listdir(f"{session.shared_root(spark)}/tidemark")) - before
    assert not [n for n in left if n.startswith("load-")]


def test_dry_run_writes_nothing(spark, folder):
    lines = staged_lines(spark, [("a", day(1), 1, "1"), ("b", "soon", 1, "2")])
    got = [tuple(r) for r in load.dry_run(lines).collect()]
    assert got == [(dt.date(2024, 5, 1), 1, 1, 0), (None, 1, 0, 1)]
    assert not os.listdir(folder)


def test_a_load_that_dies_leaves_the_table_as_it_was(spark, folder, monkeypatch):
    table = FactTable(spark, folder)
    load.load(table, staged_lines(spark, [("a", day(1), 1, "1")]), "one")

    def die(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(FactTable, "_publish", die)
    with pytest.raises(RuntimeError):
        load.load(table, staged_lines(spark, [("a", day(1), 2, "2"), ("b", day(1), 2, "3")]), "two")
    assert rows(FactTable(spark, folder).read(), "event_id", "kinesis_seq") == [("a", "1")]
    monkeypatch.undo()
    load.load(table, staged_lines(spark, [("a", day(1), 2, "2"), ("b", day(1), 2, "3")]), "two")
    assert rows(table.read(), "event_id", "kinesis_seq") == [("a", "2"), ("b", "3")]
    assert table.purge() >= 2
    assert rows(table.read(), "event_id", "kinesis_seq") == [("a", "2"), ("b", "3")]


def test_an_unfinished_list_is_ignored(spark, folder):
    table = FactTable(spark, folder)
    table.commit(facts(spark, [{}]))
    os.makedirs(f"{folder}/live/version=9999999999999999")
    assert table.read().count() == 1


def test_read_opens_only_wanted_folders(spark, folder, utc):
    table = FactTable(spark, folder)
    for n in range(1, 4):
        at = F.lit(utc(f"2024-06-{n:02d}T00:00:00"))
        rows_of_day = facts(spark, [{"event_id": str(n), "event_ts": START + dt.timedelta(days=n)}])
        table.commit(rows_of_day.withColumn("loaded_at", at))
    assert rows(table.read(loaded_since=F.lit(utc("2024-06-02T00:00:00"))), "event_id") == [("2",), ("3",)]
    assert rows(table.read(since="2024-05-29", until="2024-05-29"), "event_id") == [("2",)]
    assert rows(table.read(dates=["2024-05-30"]), "event_id") == [("3",)]
    assert rows(table.recent(START + dt.timedelta(days=3), hours=24), "event_id") == [("2",), ("3",)]
    assert len(table.recent(START + dt.timedelta(days=3), hours=1).inputFiles()) == 1
    assert FactTable(spark, f"{folder}/none").read().count() == 0


def test_compaction_and_retention(spark, folder):
    table = FactTable(spark, folder)
    for n in range(3):
        table.commit(facts(spark, [{"event_id": f"{n}{i}", "event_ts": START - dt.timedelta(minutes=7 * i + n)} for i in range(9)]))
    table.commit(facts(spark, [{"event_id": "old", "event_ts": START - dt.timedelta(days=400)}]))
    assert maintain.dates_to_compact(table, min_rows=100_000) == []
    assert maintain.compact(table, min_rows=20) == ["2024-05-27"]
    live = {r["event_date"]: r["rows"] for r in table.live().collect()}
    assert live == {"2024-05-27": 27, "2023-04-23": 1}
    assert sum(r["unsorted_rows"] for r in maintain.unsorted_files(table.read()).collect()) == 0
    stats = maintain.file_stats(table.read(dates=["2024-05-27"])).collect()
    assert sum(r["rows"] for r in stats) == 27 and all(r["size_bytes"] > 0 for r in stats)
    maintain.apply_retention(table, dt.date(2024, 5, 28))
    assert table.read().count() == 27
    assert table.purge() == 4
    assert table.read().count() == 27


def test_publish(spark, folder):
    events = spark.createDataFrame([("u1", "2", 1), ("u1", "1", 2), ("u2", "1", 3)], "user_id string, timestamp string, n int")
    assert record_source.publish(events, f"{folder}/out") == {"sent": 3, "failed": 0}
    sent = spark.read.schema("key string, value string").json(f"{folder}/out")
    assert sent.count() == 3
    # A user's events are in one file, in time order.
    found = [json.loads(x)["value"] for f in files(folder) for x in open(f"{folder}/{f}")]
    mine = [json.loads(v)["timestamp"] for v in found if json.loads(v)["user_id"] == "u1"]
    assert mine == ["1", "2"]


def test_publish_that_fails_counts_all_as_failed(spark):
    events = spark.createDataFrame([("u1", "2")] * 3, "user_id string, timestamp string")
    with pytest.raises(record_source.PublishError) as failure:
        record_source.publish(events, "/proc/nowhere")
    assert failure.value.result == {"sent": 0, "failed": 3}


def test_message_sources_map_to_records(spark):
    assert set(record_source.MESSAGE_COLUMNS) == {"sequence_number", "partition_key", "data", "arrival_ts", "shard_id"}
    messages = spark.createDataFrame(
        [("t", 1, 5, bytearray(b"k"), bytearray(b"{}"), START)],
        "topic string, partition int, offset long, key binary, value binary, timestamp timestamp",
    )
    row = record_source._as_records(messages, record_source.MESSAGE_COLUMNS).first()
    assert tuple(row) == ("t-1-00000000000000000005", "k", bytearray(b"{}"), START, "1")
    made = record_source._as_records(messages, record_source.MESSAGE_COLUMNS)
    checked = validate.check(made.unionByName(made.withColumn("data", F.lit(bytearray(b"\xff")))))
    assert rows(checked, "error_type") == [("bad_encoding",), ("missing_fields",)]
    bad = rejects.as_rejects(checked, F.col("arrival_ts"))
    assert rows(bad, "body") == [("/w==",), ("{}",)]


def test_delivered_batches(spark, folder):
    def record(seq):
        return {"kinesis": {"sequenceNumber": seq, "data": encoded(payload()), "partitionKey": "user_001",
                            "approximateArrivalTimestamp": 1716818400.25}, "eventSource": "s"}

    Path(f"{folder}/a.json").write_text(json.dumps({"Records": [record("1"), record("2")]}, indent=1))
    Path(f"{folder}/b.json").write_text(json.dumps({"Records": []}))
    made = record_source.read_deliveries(spark, folder)
    assert rows(made, "sequence_number", "partition_key", F.col("arrival_ts").cast("string")) == [
        ("1", "user_001", "2024-05-27 14:00:00.25"), ("2", "user_001", "2024-05-27 14:00:00.25")
    ]
    assert validate.good(validate.check(made)).count() == 2


def test_broadcast_only_under_the_limit():
    assert session.fits_broadcast(10, 8, 80) and not session.fits_broadcast(11, 8, 80)


def test_shared_folder_comes_from_the_session(spark):
    assert session.work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_only_a_local_master_may_use_a_folder_of_its_machine():
    def unset(master):
        return SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master))

    assert session.shared_root(unset("local[2]")) == session.shared_root(unset("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_root(unset("spark://host:7077"))
