"""Seen keys, one row per key, and the upsert."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from helpers import START, encoded, facts, payload, plan, records, rows
from tidemark.operators import dedupe, matching, upsert, validate
from tidemark.schema import RECORD_SCHEMA, SEEN_KEY_SCHEMA


def test_counters_of_a_batch(spark):
    def counts(bodies):
        row = dedupe.batch_counters(validate.check(records(spark, bodies))).first()
        return row["processed"], row["skipped"], row["errors"]

    assert counts([("seq-001", payload())]) == (1, 0, 0)
    assert counts([("seq-dup", payload()), ("seq-dup", payload())]) == (1, 1, 0)
    assert counts([("seq-bad", "not-json")]) == (0, 0, 1)
    assert counts([("b", "not-json"), ("b", "not-json")]) == (0, 0, 2)
    assert counts([]) == (0, 0, 0)


def test_seen_keys_expire_after_a_day(spark):
    made = validate.good(validate.check(records(spark, [("old", payload()), ("new", payload())])))
    keys = spark.createDataFrame([("old", 0, 86_400)], SEEN_KEY_SCHEMA)
    assert rows(dedupe.drop_seen(made, keys, "1970-01-01 12:00:00"), "sequence_number") == [("new",)]
    assert rows(dedupe.drop_seen(made, keys, "1970-01-02 00:00:00"), "sequence_number") == [("new",), ("old",)]
    twice = made.unionByName(made)
    assert rows(dedupe.drop_seen(twice, keys, "1970-01-01 12:00:00"), "sequence_number") == [("new",)]


def test_records_without_a_number_are_told_apart(spark):
    """By text, partition key, shard and arrival; the same record twice is one. None is taken for a numbered one."""
    at = START
    one = (None, "u", encoded(payload("a")), at, "s-0")
    others = [
        (None, "u", encoded(payload("b")), at, "s-0"), (None, "v", encoded(payload("a")), at, "s-0"),
        (None, "u", encoded(payload("a")), at + dt.timedelta(seconds=1), "s-0"), (None, "u", encoded(payload("a")), at, None),
        (None, None, encoded(payload("a")), at, "s-0"), (None, "u", encoded(payload("a")), None, "s-0"),
        (None, "", encoded(payload("a")), at, "s-0"), ("7", "u", encoded(payload("a")), at, "s-0"),
    ]
    made = validate.check(spark.createDataFrame([one, one, *others, others[-1]], RECORD_SCHEMA))
    good = validate.good(made)
    assert dedupe.first_delivery(good).count() == 9
    counted = dedupe.batch_counters(made).first()
    assert (counted["received"], counted["processed"], counted["skipped"], counted["errors"]) == (11, 9, 2, 0)
    keys = dedupe.seen_keys(good, F.lit(START))
    assert keys.count() == 9 and keys.where("sequence_number is null").count() == 0
    assert dedupe.drop_seen(good, keys, START).count() == 0
    some = dedupe.seen_keys(good.where("partition_key = 'v'"), F.lit(START))
    assert dedupe.drop_seen(good, some, START).count() == 8


def test_first_writer_of_a_key_wins(spark, utc):
    first = dedupe.seen_keys(records(spark, [("a", payload())]), F.lit(utc("2024-05-27T14:00:00")))
    later = dedupe.seen_keys(
        records(spark, [("a", payload()), ("b", payload())]), F.lit(utc("2024-05-27T15:00:00"))
    )
    kept = rows(dedupe.remember(first, later, "2024-05-27 15:00:00"))
    day = 86_400
    at = int(utc("2024-05-27T14:00:00").timestamp())
    assert kept == [("a", at, at + day), ("b", at + 3600, at + 3600 + day)]


def test_copies_are_reduced_before_the_shuffle(spark):
    good = validate.good(validate.check(records(spark, [(str(i), payload()) for i in range(8)])))
    text = plan(dedupe.first_delivery(good.repartition(2)))
    assert text.count("WindowGroupLimit") == 2 and "Partial" in text


def brute_upsert(live, staged, latest):
    ids = {r["event_id"] for r in staged}
    if latest:
        best = {}
        for r in staged:
            key = (r["event_ts"], r["kinesis_seq"])
            if r["event_id"] not in best or key > best[r["event_id"]][0]:
                best[r["event_id"]] = (key, r)
        staged = [r for _, r in best.values()]
    return sorted(
        (r["event_id"], r["event_ts"], r["kinesis_seq"])
        for r in [x for x in live if x["event_id"] not in ids] + list(staged)
    )


@pytest.mark.parametrize("spread", [0, 5])
def test_matching_with_a_frequent_key(spark, spread):
    draw = random.Random(23)
    made = [("hot" if draw.random() < 0.33 else f"k{draw.randrange(40)}", i) for i in range(500)]
    chosen = {f"k{n}" for n in range(0, 40, 3)} | {"hot"}
    left = spark.createDataFrame(made, "k string, i int").repartition(7)
    keys = spark.createDataFrame([(k,) for k in chosen], "k string")
    assert rows(matching.matched(left, keys, "k", spread)) == sorted((r for r in made if r[0] in chosen), key=repr)
    assert rows(matching.unmatched(left, keys, "k", spread)) == sorted((r for r in made if r[0] not in chosen), key=repr)


@pytest.mark.parametrize("latest", [False, True])
def test_upsert_against_brute_force(spark, latest):
    draw = random.Random(3)

    def some(n, tag):
        return [
            {
                # A third of all rows share one id.
                "event_id": "hot" if draw.random() < 0.33 else f"e{draw.randrange(60)}",
                "event_ts": START + dt.timedelta(minutes=draw.randrange(5000)),
                "kinesis_seq": f"{tag}{i:04d}",
            }
            for i in range(n)
        ]

    live, staged = some(300, "l"), some(120, "s")
    merged = upsert.upsert(facts(spark, live), facts(spark, staged), "latest" if latest else "all")
    got = sorted(tuple(r) for r in merged.select("event_id", "event_ts", "kinesis_seq").collect())
    assert got == brute_upsert(live, staged, latest)


def test_intra_batch_is_checked(spark):
    with pytest.raises(ValueError):
        upsert.upsert(facts(spark, [{}]), facts(spark, [{}]), "some")
