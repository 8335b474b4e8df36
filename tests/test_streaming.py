"""Streaming jobs: same result as the batch form, across files and restarts."""

import datetime as dt
import json
import time

import pytest
from pyspark.sql import functions as F

from helpers import START, facts, payload, records, rows
from checks import fixtures as fx
from tidemark.operators import dedupe, enrich, validate
from tidemark.schema import RECORD_SCHEMA
from tidemark.plans import backfill, load
from tidemark.sources import folders, landing, records as record_source, rejects
from tidemark.sources.fact import FactTable
from tidemark.streaming import live_windows, loader, transform_job


def run(spark, inbox, root, **options):
    source = record_source.stream_records(spark, inbox, options={"maxFilesPerTrigger": 1})
    query = transform_job.start(source, root, f"{root}/checkpoint", trigger=None, **options)
    query.awaitTermination()
    return query


def deliver(df, inbox):
    df.coalesce(1).write.mode("append").parquet(inbox)


def landed(spark, root):
    lines = landing.read_lines(spark, root)
    return rows(enrich.flatten(lines), "kinesis_seq", "event_id", "value")


def test_stream_equals_batch_across_files_and_a_restart(spark, folder):
    made = fx.records(spark, "/root/testdata/sf0.001", redelivered=True, resent=True)
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    cut = START.replace(year=2024, month=1, day=15)
    # Early records in two files, then a restart, then the rest with some early ones once more.
    deliver(made.where(F.col("arrival_ts") < F.lit(cut) - F.expr("interval 7 days")), inbox)
    deliver(made.where(F.col("arrival_ts").between(F.lit(cut) - F.expr("interval 7 days"), F.lit(cut))), inbox)
    run(spark, inbox, root)
    deliver(made.where(F.col("arrival_ts") > F.lit(cut) - F.expr("interval 8 days")), inbox)
    run(spark, inbox, root)

    good = validate.good(validate.check(made))
    expected = enrich.flatten(enrich.enrich(dedupe.first_delivery(good)).select("line"))
    assert landed(spark, root) == rows(expected, "kinesis_seq", "event_id", "value")


def test_duplicates_in_a_batch_across_batches_and_after_a_restart(spark, folder):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    deliver(records(spark, [("a", payload("1")), ("a", payload("1")), ("b", payload("2"))]), inbox)
    deliver(records(spark, [("b", payload("2")), ("c", payload("3"))]), inbox)
    run(spark, inbox, root)
    # A day-old record with a new number is late, and must still come through.
    late = records(spark, [("d", payload("4"))], start=START - dt.timedelta(days=30))
    deliver(records(spark, [("a", payload("1"))]).unionByName(late), inbox)
    run(spark, inbox, root)
    assert [r[0] for r in landed(spark, root)] == ["a", "b", "c", "d"]


@pytest.mark.parametrize("spread", [0, 4])
def test_one_key_with_most_of_the_copies(spark, folder, spread):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    body = [("hot", payload("1"))] * 60 + [(f"k{i}", payload(str(i))) for i in range(40)]
    records(spark, body).repartition(6).write.parquet(inbox)
    source = record_source.stream_records(spark, inbox)
    query = transform_job.start(source, root, f"{root}/checkpoint", trigger=None, spread=spread)
    query.awaitTermination()
    assert len(landed(spark, root)) == 41
    counts = transform_job.counters(query.lastProgress if query.lastProgress.numInputRows else query.recentProgress[0])
    assert counts == {"received": 100, "processed": 41, "skipped": 59, "errors": 0}


def test_keys_are_forgotten_after_their_time(spark, folder):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    again = records(spark, [("a", payload("1"))])
    deliver(again, inbox)
    run(spark, inbox, root, memory_seconds=2)
    for _ in range(3):
        # Time has to pass twice: once to move the clock, once to use it.
        time.sleep(2.5)
        deliver(records(spark, [("tick", payload("t"))]), inbox)
        run(spark, inbox, root, memory_seconds=2)
    deliver(again, inbox)
    run(spark, inbox, root, memory_seconds=2)
    assert [r[0] for r in landed(spark, root)].count("a") == 2


def test_rejects_count_each_time_and_keep_their_data(spark, folder):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    bodies = [("x", "not-json"), ("x", "not-json"), ("y", [1]), ("z", {"event_id": "q"}), ("ok", payload())]
    deliver(records(spark, bodies), inbox)
    deliver(records(spark, [("x", "not-json")]), inbox)
    run(spark, inbox, root)
    stored = rejects.read(spark, root)
    assert rows(rejects.by_type(stored)) == [("bad_json", 3), ("missing_fields", 1), ("not_object", 1)]
    kept = rows(stored.where("error_type <> 'bad_json'"), "sequence_number", "body")
    assert kept == [("y", "[1]"), ("z", json.dumps({"event_id": "q"}))]
    assert len(landed(spark, root)) == 1


def test_a_batch_that_fails_between_its_outputs_is_repeated_cleanly(spark, folder, monkeypatch):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    deliver(records(spark, [("a", payload("1")), ("x", "not-json")]), inbox)
    store = rejects.store

    def fail(*_args, **_kwargs):
        raise RuntimeError("sink lost")

    monkeypatch.setattr(rejects, "store", fail)
    with pytest.raises(Exception, match="sink lost"):
        run(spark, inbox, root, batch_log=f"{folder}/log", name="failing")
    monkeypatch.setattr(rejects, "store", store)
    run(spark, inbox, root)
    assert len(landed(spark, root)) == 1
    assert rows(rejects.by_type(rejects.read(spark, root))) == [("bad_json", 1)]
    assert wait_for(spark, f"{folder}/log", 1)[0]["failed"] == 1


def test_a_new_checkpoint_does_not_replace_what_was_landed(spark, folder):
    """A backfill starts its batch numbers over, under another query id."""
    deliver(records(spark, [("a", payload("1")), ("x", "not-json")]), f"{folder}/first")
    deliver(records(spark, [("b", payload("2")), ("y", "not-json")]), f"{folder}/second")
    for inbox in ("first", "second"):
        source = record_source.stream_records(spark, f"{folder}/{inbox}")
        transform_job.start(source, f"{folder}/out", f"{folder}/checkpoint-{inbox}", trigger=None).awaitTermination()
    assert [r[0] for r in landed(spark, f"{folder}/out")] == ["a", "b"]
    assert rejects.read(spark, f"{folder}/out").count() == 2
    assert "None" not in {r[0] for r in rejects.read(spark, f"{folder}/out").select("batch_id").collect()}.pop()


def wait_for(spark, path, count):
    for _ in range(40):
        try:
            found = spark.read.parquet(path).orderBy("batch_id").collect()
            if len(found) >= count:
                return found
        except Exception:
            pass
        time.sleep(0.25)
    raise AssertionError(f"no {count} log rows at {path}")


def test_batch_log(spark, folder):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    deliver(records(spark, [("a", payload("1")), ("a", payload("1")), ("x", "not-json")]), inbox)
    deliver(records(spark, [("a", payload("1"))]), inbox)
    run(spark, inbox, root, batch_log=f"{folder}/log", name="logged")
    log = wait_for(spark, f"{folder}/log", 2)
    assert sum(r["received"] for r in log) == 4 and sum(r["errors"] for r in log) == 1
    assert sum(r["processed"] for r in log) == 1 and sum(r["skipped"] for r in log) == 2
    assert all(r["duration_ms"] > 0 and r["failed"] == 0 for r in log)


def test_second_pass_by_event_id(spark, folder):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    deliver(records(spark, [("a", payload("1")), ("b", payload("1")), ("x", "not-json"), ("y", "not-json")]), inbox)
    run(spark, inbox, root, by_event_id=True)
    assert len(landed(spark, root)) == 1
    assert rejects.read(spark, root).count() == 2


def test_second_pass_takes_the_event_id_as_the_checks_do(spark, folder):
    """Of a repeated key the last counts, as in the load."""
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    twice = json.dumps(payload("1"))[:-1] + ', "event_id": "2"}'
    deliver(records(spark, [("a", twice), ("b", payload("2")), ("c", payload("1"))]), inbox)
    run(spark, inbox, root, by_event_id=True)
    assert sorted(r[1] for r in landed(spark, root)) == ["1", "2"]


def test_records_without_a_number_all_survive(spark, folder):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    made = records(spark, [(None, payload(str(i % 3))) for i in range(6)] + [("a", payload("9")), (None, "not-json")])
    for _ in range(2):  # the same records again in a later batch
        deliver(made, inbox)
    run(spark, inbox, root)
    assert sorted(r[1] for r in landed(spark, root)) == ["0", "0", "1", "1", "2", "2", "9"]
    assert rejects.read(spark, root).count() == 2


def test_a_backlog_takes_several_batches_by_default(spark, folder, monkeypatch):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    for i in range(4):
        deliver(records(spark, [(str(i), payload(str(i)))]), inbox)
    monkeypatch.setitem(record_source.ADMISSION, "files", {"maxBytesPerTrigger": "1"})
    query = transform_job.start(record_source.stream_records(spark, inbox), root, f"{root}/checkpoint", trigger=None)
    query.awaitTermination()
    assert len({p.batchId for p in query.recentProgress if p.numInputRows}) == 4
    assert len(landed(spark, root)) == 4


def test_windows_still_open_are_written_after_an_end_mark(spark, folder):
    made = [{"event_ts": START + dt.timedelta(minutes=m), "user_id": u, "event_type": "purchase", "value": None}
            for m, u in ((0, "a"), (0, "a"), (0, None), (1, "b"), (70, "a"))]
    facts(spark, made).coalesce(1).write.parquet(f"{folder}/in")
    stream = live_windows.closing(spark.readStream.schema(facts(spark, made).schema).parquet(f"{folder}/in"), f"{folder}/marks")
    for name, report, first, last in (
        ("minutes", live_windows.events_per_minute, 2, [(START, 3, 1, 0), (START + dt.timedelta(minutes=1), 1, 1, 0), (START + dt.timedelta(minutes=70), 1, 1, 0)]),
        ("hours", live_windows.revenue_by_hour, 1, [(START, 4, None), (START + dt.timedelta(hours=1), 1, None)]),
    ):
        frame = report(stream)
        for n in range(2):
            frame.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/{name}").format("parquet").trigger(
                availableNow=True).start(f"{folder}/{name}-out").awaitTermination()
            found = rows(spark.read.parquet(f"{folder}/{name}-out"))
            assert found == last if n else len(found) == first
            live_windows.close(spark, f"{folder}/marks", START + dt.timedelta(days=1))
        spark.read.parquet(f"{folder}/marks").count()
        folders.remove(spark, f"{folder}/marks")
        stream = live_windows.closing(spark.readStream.schema(facts(spark, made).schema).parquet(f"{folder}/in"), f"{folder}/marks")


def test_second_pass_keeps_records_without_event_id(spark, folder):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    bodies = [(n, payload(None)) for n in "cdef"]
    deliver(records(spark, [("a", payload("1")), ("b", payload("1")), *bodies]), inbox)
    run(spark, inbox, root, by_event_id=True)
    assert [r[0] for r in landed(spark, root)].count("c") == 1 and len(landed(spark, root)) == 5


def test_full_strictness_and_full_meta(spark, folder):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    deliver(records(spark, [("a", payload("1")), ("b", payload("2", event_type="zzz"))]), inbox)
    run(spark, inbox, root, strictness="full", form="full")
    line = json.loads(landing.read_lines(spark, root).first()["line"])
    assert line["_meta"]["kinesis_shard_id"] == "shard-0" and line["_meta"]["schema_version"] == "1.0"
    assert rows(rejects.by_type(rejects.read(spark, root))) == [("invalid_fields", 1)]


def test_landing_as_parquet(spark, folder):
    inbox, root = f"{folder}/inbox", f"{folder}/out"
    deliver(records(spark, [("a", payload("1")), ("x", "not-json")]), inbox)
    run(spark, inbox, root, zone_format="parquet")
    assert rows(spark.read.parquet(f"{root}/events"), "event_id", "kinesis_seq") == [("1", "a")]


def test_starting_at_the_newest_record(spark, folder):
    inbox = f"{folder}/inbox"
    deliver(records(spark, [("old", payload()), ("new", payload())]), inbox)
    newest = record_source.stream_records(spark, inbox, since=START + dt.timedelta(seconds=1))
    assert newest.isStreaming
    query = newest.writeStream.format("memory").queryName("newest").trigger(availableNow=True).start()
    query.awaitTermination()
    assert rows(spark.table("newest"), "sequence_number") == [("new",)]
    assert record_source.read_records(spark, inbox).schema == RECORD_SCHEMA


def test_backfill_repeats_and_expires(spark, folder):
    made = records(spark, [("a", payload("1")), ("a", payload("1")), ("b", payload("2")), ("x", "not-json")])
    more = made.unionByName(records(spark, [("c", payload("3"))]))
    root, keys_root = f"{folder}/zone", f"{folder}/keys"

    def landed_by(run):
        return sorted(r[0] for r in enrich.flatten(landing.read_lines(spark, root, batch_id=run)).select("kinesis_seq").collect())

    for _ in range(2):
        # The same run again changes nothing.
        backfill.run(made, root, keys_root, "one", "2024-06-01 00:00:00")
        assert landed_by("one") == ["a", "b"] and rejects.read(spark, root).count() == 1
    backfill.run(more, root, keys_root, "two", "2024-06-01 23:59:59")
    assert landed_by("two") == ["c"]
    # A day after the first run its keys are forgotten, those of the second are not.
    backfill.run(more, root, keys_root, "three", "2024-06-02 00:00:00")
    assert landed_by("three") == ["a", "b"]
    assert rejects.read(spark, root).count() == 3


def test_loading_as_files_arrive(spark, folder):
    root, table = f"{folder}/zone", FactTable(spark, f"{folder}/fact")

    def land(bodies, batch):
        good = validate.good(validate.check(records(spark, bodies)))
        landing.land(enrich.enrich(good).withColumn("delivered_at", F.col("arrival_ts")), root, batch)

    def load_now():
        loader.start(table, root, f"{folder}/checkpoint", trigger=None, audit_root=f"{folder}/audit").awaitTermination()

    land([("1", payload("a")), ("2", payload("b"))], 0)
    load_now()
    land([("3", payload("b")), ("4", payload("c"))], 1)
    load_now()
    load_now()
    assert rows(table.read(), "event_id", "kinesis_seq") == [("a", "1"), ("b", "3"), ("c", "4")]
    assert spark.read.parquet(f"{folder}/audit").agg(F.sum("lines_loaded")).first()[0] == 4


def test_a_repeated_load_batch_replaces_its_rejects(spark, folder, monkeypatch):
    root, table = f"{folder}/zone", FactTable(spark, f"{folder}/fact")
    good = validate.good(validate.check(records(spark, [("1", payload("a")), ("2", payload("b", timestamp="soon"))])))
    landing.land(enrich.enrich(good).withColumn("delivered_at", F.col("arrival_ts")), root)

    def start():
        loader.start(table, root, f"{folder}/checkpoint", trigger=None, audit_root=f"{folder}/audit",
                     rejects_root=f"{folder}/rejects").awaitTermination()

    def fail(*_args):
        raise RuntimeError("audit lost")

    with monkeypatch.context() as patch:
        patch.setattr(load, "audit_rows", fail)
        with pytest.raises(Exception, match="audit lost"):
            start()
    start()
    assert rejects.read(spark, f"{folder}/rejects").count() == 1
    assert rows(table.read(), "event_id") == [("a",)]


def test_live_windows(spark, folder):
    made = [{"event_ts": START + dt.timedelta(minutes=m), "user_id": f"u{m % 3}", "event_type": t}
            for m, t in ((0, "error"), (0, "x"), (1, "x"), (30, "x"), (200, "x"))]
    facts(spark, made).coalesce(1).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(facts(spark, made).schema).parquet(f"{folder}/in")
    for name, frame in (("minutes", live_windows.events_per_minute(stream)),
                        ("sliding", live_windows.active_users_sliding(stream))):
        frame.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/{name}").format(
            "memory").queryName(f"live_{name}").trigger(availableNow=True).start().awaitTermination()
    minutes = rows(spark.table("live_minutes"))
    assert minutes == [(START, 2, 1, 1), (START + dt.timedelta(minutes=1), 1, 1, 0),
                       (START + dt.timedelta(minutes=30), 1, 1, 0)]
    sliding = {r["window_start"]: r["events"] for r in spark.table("live_sliding").collect()}
    assert sliding[START - dt.timedelta(minutes=4)] == 2 and sliding[START] == 3
