"""How the registered jobs lay out their work where the tables are large."""

import os

import pytest

from checks import load_checks, stream_checks
from tidemark.operators import validate


@pytest.fixture
def events(spark, folder):
    kinds = "element_at(array('view', 'error', 'signup'), cast(id % 3 + 1 as int)) as event_type"
    made = spark.range(240).selectExpr(
        "id as event_id", "timestamp_seconds(1704100000 + id * 60) as ts", "id % 7 as user_id", kinds,
        "cast(id as double) / 4 as value", "concat('{\"k\": ', id % 60, '}') as props",
    )
    made.write.parquet(f"{folder}/events.parquet")
    return folder


def test_a_backlog_has_several_files_for_every_core(spark, events, monkeypatch):
    monkeypatch.setattr(stream_checks, "work_folder", lambda spark, name: f"{events}/{name}")
    found = stream_checks.stream_backlog(spark, events).collect()
    files = [f for f in os.listdir(f"{events}/backlog/inbox") if f.endswith(".parquet")]
    assert len(files) >= 3 * spark.sparkContext.defaultParallelism
    assert found[0].several_batches and found[0].landed == sum(1 + (i % 3 == 2) for i in range(240) if i % 60 not in (7, 13, 21, 29, 37))


def test_records_are_checked_once_for_rejects_and_loads(spark, events, monkeypatch):
    calls, check = [], validate.check
    monkeypatch.setattr(validate, "check", lambda *a, **k: calls.append(1) or check(*a, **k))
    found = {r.error_type: r.rejects for r in load_checks.rejects_by_type(spark, events).collect()}
    assert len(calls) == 1
    # Of each k there are four records; those of an error or a signup come twice.
    times = {k: sum(1 + (i % 3 > 0) for i in range(240) if i % 60 == k) for k in range(60)}
    assert found == {
        "bad_json": times[7], "missing_fields": times[13], "not_object": times[21],
        "bad_encoding": times[29] + times[37], "load_error": times[43] + times[53],
    }
