"""Writers side by side, the id lookup, compaction of small folders."""

import datetime as dt
import random
import threading

import pytest
from pyspark.sql import functions as F

from helpers import START, facts, plan, rows
from tidemark.plans import load, maintain
from tidemark.sources import folders
from tidemark.sources.fact import Conflict, FactTable


def day_rows(spark, ids, day=0, seq="1"):
    return facts(spark, [{"event_id": i, "event_ts": START + dt.timedelta(days=day), "kinesis_seq": seq} for i in ids])


def held(table):
    return rows(table.read(), "event_id", "kinesis_seq")


def during_write(monkeypatch, table, action):
    """Run an action after the table's next write and before its commit."""
    original, done = table.write, []

    def write(version, frame):
        entries = original(version, frame)
        if not done:
            done.append(version)
            action()
        return entries

    monkeypatch.setattr(table, "write", write)


@pytest.mark.parametrize("linked", [True, False])
def test_a_file_is_created_once(spark, folder, linked):
    path = f"{folder}/commits/000000000001"
    made = []

    def claim(number):
        if folders.create_once(spark, path, number, linked):
            made.append(number)

    threads = [threading.Thread(target=claim, args=(n,)) for n in range(8)]
    for t in threads:
        t.start()
        if not linked:  # a local rename is not atomic, so that links are used there
            t.join()
    for t in threads:
        t.join()
    assert len(made) == 1 and folders.read_number(spark, path) == made[0]
    assert [n for n in folders.names(spark, f"{folder}/commits") if not n.startswith(".")] == ["000000000001"]


def test_load_within_compaction(spark, folder, monkeypatch):
    """The compaction leaves the dates that the load has replaced, and merges the others."""
    table, other = FactTable(spark, folder), FactTable(spark, folder)
    for n in "abc":
        table.commit(day_rows(spark, [n]).unionByName(day_rows(spark, [n + "2"], 1)))
    during_write(monkeypatch, table, lambda: load.merge(other, day_rows(spark, ["b", "new"], 0, "2")))
    maintain.compact(table)
    want = sorted([("a", "1"), ("a2", "1"), ("b", "2"), ("b2", "1"), ("c", "1"), ("c2", "1"), ("new", "2")])
    assert held(table) == want
    assert table.live().where("event_date = '2024-05-28'").count() == 1
    monkeypatch.undo()
    maintain.compact(table)
    assert held(table) == want and table.live().count() == 2
    assert table.purge() > 0 and held(table) == want


def test_load_that_only_adds_within_compaction(spark, folder, monkeypatch):
    table, other = FactTable(spark, folder), FactTable(spark, folder)
    for n in "ab":
        table.commit(day_rows(spark, [n]))
    during_write(monkeypatch, table, lambda: load.merge(other, day_rows(spark, ["c"])))
    maintain.compact(table)
    assert held(table) == [("a", "1"), ("b", "1"), ("c", "1")] and table.live().count() == 2


def test_two_loads_of_the_same_ids(spark, folder, monkeypatch):
    """New ids and ids of the table: neither lost nor doubled, the last commit wins."""
    table, other = FactTable(spark, folder), FactTable(spark, folder)
    table.commit(day_rows(spark, ["a", "z"]))
    during_write(monkeypatch, table, lambda: load.merge(other, day_rows(spark, ["a", "b"], 3, "2")))
    load.merge(table, day_rows(spark, ["a", "b", "c"], 1, "3"))
    assert held(table) == [("a", "3"), ("b", "3"), ("c", "3"), ("z", "1")]
    assert not folders.names(spark, table.leases)


def test_loads_from_several_threads(spark, folder):
    draw, made, failed = random.Random(2), [], []
    loads = [[f"e{draw.randrange(12)}" for _ in range(6)] for _ in range(5)]

    def run(n):
        try:
            load.merge(FactTable(spark, folder), day_rows(spark, sorted(set(loads[n])), n % 3, str(n)))
            made.append(n)
        except Exception as problem:  # shown by the assertion below
            failed.append(problem)

    threads = [threading.Thread(target=run, args=(n,)) for n in range(len(loads))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and len(made) == 5
    found = held(FactTable(spark, folder))
    assert [i for i, _ in found] == sorted({i for ids in loads for i in ids})
    assert all(i in loads[int(n)] for i, n in found)


def test_load_within_retention(spark, folder, monkeypatch):
    table, other = FactTable(spark, folder), FactTable(spark, folder)
    table.commit(day_rows(spark, ["old"], -400).unionByName(day_rows(spark, ["a"])))
    original, done = table.publish, []

    def publish(*args, **options):
        if not done:
            done.append(1)
            load.merge(other, day_rows(spark, ["b"]).unionByName(day_rows(spark, ["late"], -500)))
        return original(*args, **options)

    monkeypatch.setattr(table, "publish", publish)
    maintain.apply_retention(table, START.date())
    assert held(table) == [("a", "1"), ("b", "1")]


def test_replacing_what_is_gone_is_refused(spark, folder):
    table = FactTable(spark, folder)
    first = table.commit(day_rows(spark, ["a"]))
    part = ("2024-05-27", first)
    table.commit(day_rows(spark, ["b"]), replaces=[part])
    with pytest.raises(Conflict):
        table.commit(day_rows(spark, ["c"]), replaces=[part])
    assert held(table) == [("b", "1")]


def test_purge_spares_a_write_that_goes_on(spark, folder):
    table = FactTable(spark, folder)
    table.commit(day_rows(spark, ["a"]))
    with table.writing() as version:
        added = table.write(version, day_rows(spark, ["b"]))
        assert table.purge() == 0
        assert table.publish(table.snapshot(), added)
    assert held(table) == [("a", "1"), ("b", "1")]
    with table.writing() as version:
        table.write(version, day_rows(spark, ["dead"]))
        assert table.purge(write_seconds=0) == 1


def test_load_of_new_ids_opens_no_fact_folder(spark, folder, monkeypatch):
    table = FactTable(spark, folder)
    first = table.commit(day_rows(spark, [f"a{i}" for i in range(50)]))
    second = table.commit(day_rows(spark, [f"b{i}" for i in range(50)], 1))
    opened, original = [], table.open

    def noted(parts):
        opened.extend(parts)
        return original(parts)

    monkeypatch.setattr(table, "open", noted)
    load.merge(table, day_rows(spark, [f"c{i}" for i in range(50)]))
    assert opened and not {v for _, v in opened} & {first, second}
    opened.clear()
    load.merge(table, day_rows(spark, ["b7"], 2, "2"))
    assert {v for _, v in opened} & {first, second} == {second}
    assert ("b7", "2") in held(table) and len(held(table)) == 150


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_lookup_is_joined_bucket_by_bucket_without_a_shuffle_of_it(spark, folder, share):
    """With ids of `share` times the limit; beyond one bucket's worth the lookup is shuffled."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        table = FactTable(spark, folder, id_buckets=8)
        versions = [table.commit(day_rows(spark, [f"{n}-{i}" for i in range(20)], n)) for n in range(3)]
        ids = spark.createDataFrame([("1-3",), ("2-19",), ("x",)], "event_id string")
        parts = table.snapshot().parts
        assert table.holding(ids, parts, 1000 * share, 1000) == {("2024-05-28", versions[1]), ("2024-05-29", versions[2])}
        lookup = spark.read.schema("event_id string, event_date date, version long, bucket int").option("basePath", table.ids).parquet(table.ids)
        text = plan(table._bucketed(lookup, ids, 1000 * share, 1000))
        assert ("SortMergeJoin" in text) == (share == 1000)
        assert text.count("BroadcastHashJoin") == {1: 1, 3: 4, 1000: 0}[share]
        folders.remove(spark, table.ids)
        assert table.holding(ids, parts, 1000 * share, 1000) == {("2024-05-28", versions[1]), ("2024-05-29", versions[2])}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_ids_beyond_the_limit_reach_the_driver_some_buckets_at_a_time(spark, folder, monkeypatch):
    table = FactTable(spark, folder, id_buckets=8)
    version = table.commit(day_rows(spark, [f"a{i}" for i in range(20)]))
    kind = type(table.live())
    parts, plans, collect = table.snapshot().parts, [], kind.collect

    def noted(frame):
        found = collect(frame)
        plans.append(plan(frame).split("Initial Plan")[0])
        return found

    monkeypatch.setattr(kind, "collect", noted)
    none = spark.createDataFrame([(f"x{i}",) for i in range(40)], "event_id string")
    assert table.holding(none, parts, 3000, 1000) == set()
    assert [p.count("BroadcastExchange") <= 1 for p in plans] == [True] * 4
    plans.clear()
    every = spark.createDataFrame([(f"a{i}",) for i in range(20)], "event_id string")
    assert table.holding(every, parts, 3000, 1000) == {("2024-05-27", version)} and len(plans) < 4


def test_find_opens_the_folders_of_the_ids(spark, folder):
    table = FactTable(spark, folder)
    for n in range(3):
        table.commit(day_rows(spark, [f"{n}-{i}" for i in range(5)], n))
    found = table.find(["1-2", "nothing"])
    assert rows(found, "event_id") == [("1-2",)] and {f.split("event_date=")[1][:10] for f in found.inputFiles()} == {"2024-05-28"}
    assert table.find(["nothing"]).count() == 0


def test_tables_of_earlier_lists_are_read_and_loaded(spark, folder):
    """Complete lists without numbered commits, sizes and id lookups."""
    table = FactTable(spark, folder)
    with table.writing() as version:
        entries = table.write(version, day_rows(spark, ["a", "b"]))
    folders.remove(spark, table.ids)
    live = spark.createDataFrame([e[:3] + e[4:] for e in entries], "event_date string, version long, rows long, min_ts timestamp, max_ts timestamp, max_loaded_at timestamp")
    live.coalesce(1).write.parquet(f"{table.lists}/version=1700000000000")
    assert held(table) == [("a", "1"), ("b", "1")]
    load.merge(table, day_rows(spark, ["b", "c"], 1, "2"))
    assert held(table) == [("a", "1"), ("b", "2"), ("c", "2")]


def test_bins_take_the_largest_first():
    assert maintain.bins({"a": 5, "b": 4, "c": 3, "d": 3, "e": 2}, 7) == [["a", "e"], ["b", "c"], ["d"]]
    assert maintain.bins({"a": 9, "b": 0}, 7) == [["a"], ["b"]]
    draw = random.Random(1)
    sizes = {i: draw.randrange(1, 60) for i in range(200)}
    made = maintain.bins(sizes, 100)
    assert sorted(k for own in made for k in own) == list(range(200))
    assert all(sum(sizes[k] for k in own) <= 100 for own in made)
    assert len(made) <= 11 / 9 * sum(sizes.values()) / 100 + 1


def test_several_bins_to_a_date(spark, folder):
    """Folders as large as the target stay, the small ones are merged in as many folders as they need."""
    table = FactTable(spark, folder)
    for n in range(4):
        table.commit(day_rows(spark, [f"{n}-{i}" for i in range(3)]))
    sizes = [r["bytes"] for r in table.live().collect()]
    maintain.compact(table, target_bytes=2 * max(sizes) + 1)
    assert table.live().count() == 2 and table.read().count() == 12
    assert maintain.folders_to_merge(table, min(sizes)) == []
    maintain.compact(table)
    assert table.live().count() == 1 and table.read().select(F.countDistinct("event_id")).first()[0] == 12
