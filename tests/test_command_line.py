"""The commands, one after the other, as an operator runs them."""

import json

from pyspark.sql import functions as F

from helpers import payload, records, rows
from tidemark.__main__ import parser, run
from tidemark.sources.fact import FactTable


def call(spark, capsys, *argv):
    run(spark, parser().parse_args([str(a) for a in argv]))
    return capsys.readouterr().out


def test_transform_load_report_replay(spark, folder, capsys):
    bodies = [(str(i), payload(f"e{i}", event_type="purchase", properties={"value": 10})) for i in range(5)]
    bodies += [("bad", "not-json"), ("odd", {"user_id": "u9"})]
    records(spark, bodies).write.parquet(f"{folder}/records")
    call(spark, capsys, "transform", "--source", f"{folder}/records", "--root", f"{folder}/zone",
         "--checkpoint", f"{folder}/cp", "--once")

    prefix = f"{folder}/zone/events/"
    assert "2024-05-27" in call(spark, capsys, "load", "--prefix", prefix, "--table", f"{folder}/fact", "--dry-run")
    assert FactTable(spark, f"{folder}/fact").read().count() == 0
    result = json.loads(call(spark, capsys, "load", "--prefix", prefix, "--table", f"{folder}/fact"))
    assert result["rows_loaded"] == 5 and result["source"] == prefix

    shown = call(spark, capsys, "report", "revenue-by-hour", "--table", f"{folder}/fact", "--as-of", "2024-05-28")
    assert "50.0" in shown
    assert "|5" in call(spark, capsys, "report", "events-per-minute", "--table", f"{folder}/fact",
                        "--as-of", "2024-05-27T14:30:00")

    for name in ("duplicates", "duplicate-check", "skew", "funnel"):
        assert "|" in call(spark, capsys, "report", name, "--table", f"{folder}/fact")

    seen = call(spark, capsys, "replay", "--rejects", f"{folder}/zone", "--dry-run")
    assert '"dry_run": 1' in seen
    sent = call(spark, capsys, "replay", "--rejects", f"{folder}/zone", "--target", f"{folder}/again")
    assert json.loads(sent) == {"sent": 1, "failed": 0}
    assert '"dry_run": 0' in call(spark, capsys, "replay", "--rejects", f"{folder}/zone", "--dry-run")

    shards = call(spark, capsys, "shards", "--records", f"{folder}/records", "--as-of", "2024-05-27T14:00:09")
    assert "shard-0" in shards and "green" in shards

    call(spark, capsys, "load-stream", "--root", f"{folder}/zone", "--table", f"{folder}/fact",
         "--checkpoint", f"{folder}/cp2", "--once")
    out = call(spark, capsys, "maintain", "--table", f"{folder}/fact", "--compact", "--purge")
    assert json.loads(out.splitlines()[-1])["removed_folders"] == 1
    assert rows(FactTable(spark, f"{folder}/fact").read().select(F.count("event_id"))) == [(5,)]
