"""Expiry of landed files, rejects, replayed ids and seen keys in two steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import payload, plan, records, rows
from tidemark.__main__ import parser, run
from tidemark.operators import dedupe, validate
from tidemark.plans import replay, retention
from tidemark.sources import days, folders, keys, landing, rejects

NOW = dt.datetime(2024, 5, 27, 18, tzinfo=dt.timezone.utc)


def stored_at(spark, root, day, sequence):
    """A landed line, two rejects (one is no JSON) and a seen key of one day."""
    at = F.lit(f"{day} 10:00:00").cast("timestamp")
    checked = validate.check(records(spark, [(f"{sequence}a", payload()), (f"{sequence}b", "[1]"), (f"{sequence}c", "no")]))
    rejects.store(rejects.as_rejects(validate.bad(checked), at), root, batch_id=sequence)
    landing.land(spark.createDataFrame([(f"line {sequence}",)], "line string").withColumn("delivered_at", at), root, sequence)
    keys.add(dedupe.seen_keys(validate.good(checked), at), f"{root}/keys", sequence)


@pytest.fixture
def zones(spark, folder):
    for n, day in enumerate(("2023-01-05", "2024-05-01", "2024-05-27")):
        stored_at(spark, folder, day, str(n))
    replay.replay(replay.sendable(rejects.read(spark, folder)), f"{folder}/replayed", NOW, path=f"{folder}/target")
    return folder


def held(spark, root):
    return {name: [str(d) for d in sorted(z.held(spark))] for name, z in retention.zones(root, f"{root}/keys").items()}


def seen(spark, root):
    return (
        rows(landing.read_lines(spark, root), "line"),
        rejects.read(spark, root).count(),
        replay.replayed(spark, f"{root}/replayed")[0].count(),
        keys.read(spark, f"{root}/keys", "2023-01-01").count(),
    )


def test_days_are_retired_first_and_deleted_later(spark, zones):
    before = held(spark, zones)
    assert all(v == ["2023-01-05", "2024-05-01", "2024-05-27"] for v in before.values())
    found = retention.expire(spark, zones, NOW, f"{zones}/keys")
    assert found["landing"] == {"retired": ["2023-01-05"], "deleted": []}
    assert found["rejects"]["retired"] == found["replayed"]["retired"] == found["keys"]["retired"] == ["2023-01-05", "2024-05-01"]
    # A reader that began before still finds its files; new ones leave the days out.
    assert held(spark, zones) == before
    assert seen(spark, zones) == ([("line 1",), ("line 2",)], 2, 1, 1)
    later = retention.expire(spark, zones, NOW + dt.timedelta(hours=23), f"{zones}/keys")
    assert not any(z["deleted"] for z in later.values())
    last = retention.expire(spark, zones, NOW + dt.timedelta(hours=25), f"{zones}/keys")
    assert last["landing"]["deleted"] == ["2023-01-05"] and last["replayed"]["deleted"] == ["2023-01-05", "2024-05-01"]
    assert held(spark, zones)["rejects"] == held(spark, zones)["keys"] == ["2024-05-27"]
    assert seen(spark, zones)[:3] == ([("line 1",), ("line 2",)], 2, 1)


def test_retired_days_do_not_come_back(spark, folder):
    zone = days.Zone(f"{folder}/zone", ("key_date",))
    assert days.first_in_use(spark, zone) is None and zone.held(spark) == {}
    assert days.retire(spark, zone, dt.date(2024, 5, 2), NOW) == [] and days.delete(spark, zone, NOW) == []
    days.retire(spark, zone, dt.date(2024, 5, 1), NOW + dt.timedelta(days=1))
    assert days.first_in_use(spark, zone) == dt.date(2024, 5, 2)
    # Repeating a retirement does not put its deletion off.
    days.retire(spark, zone, dt.date(2024, 5, 2), NOW + dt.timedelta(days=1))
    assert folders.read_number(spark, f"{zone.root}/{days.NOTES}/2024-05-02") == int(NOW.timestamp())


def test_retired_days_are_not_opened(spark, zones):
    retention.expire(spark, zones, NOW, f"{zones}/keys")
    assert len(rejects.read(spark, zones).inputFiles()) > 1
    shown = plan(rejects.read(spark, zones))
    assert "PartitionFilters: [" in shown and "2024-05-13" in shown


def test_no_reject_is_open_again_when_the_note_of_its_replay_expires(spark, zones):
    for hours in (0, 25, 24 * 20, 24 * 40):
        now = NOW + dt.timedelta(hours=hours)
        open_ones = replay.sendable(replay.open_rejects(spark, zones))
        assert open_ones.count() == 0
        retention.expire(spark, zones, now, f"{zones}/keys")
        assert replay.sendable(replay.open_rejects(spark, zones)).count() == 0


def test_ids_noted_without_a_day_still_count(spark, folder):
    stored_at(spark, folder, "2024-05-27", "1")
    sent = replay.sendable(rejects.read(spark, folder)).select("reject_id", F.lit(NOW).alias("replayed_at"))
    sent.write.parquet(f"{folder}/replayed")
    stored_at(spark, folder, "2024-05-28", "2")
    replay.replay(replay.sendable(replay.open_rejects(spark, folder)), f"{folder}/replayed", NOW, path=f"{folder}/target")
    assert spark.read.json(f"{folder}/target").count() == 1
    assert replay.sendable(replay.open_rejects(spark, folder)).count() == 0


def test_few_replayed_ids_are_broadcast(spark, zones):
    few = plan(replay.open_rejects(spark, zones))
    assert "BroadcastHashJoin" in few and "SortMergeJoin" not in few
    ids, size = replay.replayed(spark, f"{zones}/replayed")
    many = replay.remaining(rejects.read(spark, zones), ids, size, limit=0)
    assert "SortMergeJoin" in plan(many)
    assert rows(many, "reject_id") == rows(replay.open_rejects(spark, zones), "reject_id")


def test_maintain_expires_zones(spark, zones, capsys):
    run(spark, parser().parse_args(["maintain", "--expire", zones, "--keys", f"{zones}/keys", "--grace", "0"]))
    assert "2023-01-05" in capsys.readouterr().out
    assert "2023-01-05" not in str(held(spark, zones))
    with pytest.raises(SystemExit):
        run(spark, parser().parse_args(["maintain", "--compact"]))
