"""Loading landed lines into the fact table."""

import datetime as dt
import time

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import measures, timing
from tidemark.operators.enrich import flatten
from tidemark.operators.matching import SPREAD
from tidemark.operators.upsert import settle, upsert
from tidemark.schema import FACT_COLUMNS, LOAD_ERROR
from tidemark.session import work_folder, written
from tidemark.sources import folders, rejects
from tidemark.sources.fact import BROADCAST_BYTES, FactTable

# Bytes of an event id in a broadcast table beside its text: Spark's own figure for ids of 8 characters with their bucket is
# 118 to 131 bytes a row.
ID_BYTES = 128


def stage(lines: DataFrame, loaded_at=None, ignore_case: bool = True) -> DataFrame:
    """Lines as fact rows with `line`, `file` and `error`.

    A line that must not be loaded gets an error and keeps its text, which the
    others do not need any more. `loaded_at` is set here, for all rows of a
    load alike; lines that bring a `loaded_at` keep theirs.
    """
    own = ["loaded_at"] if "loaded_at" in lines.columns else []
    at = F.col("loaded_at") if own else loaded_at
    staged = flatten(lines.select("line", "file", *own), loaded_at=at, ignore_case=ignore_case, problem="error")
    return staged.withColumn("line", F.when(F.col("error").isNotNull(), F.col("line")))


def fact_rows(staged: DataFrame) -> DataFrame:
    return staged.where(F.col("error").isNull()).select(*FACT_COLUMNS)


def dry_run(lines: DataFrame, ignore_case: bool = True) -> DataFrame:
    """What a load would do: lines per event date and their outcome. Writes nothing."""
    staged = stage(lines, ignore_case=ignore_case)
    return (
        staged.groupBy(F.when(F.col("error").isNull(), F.to_date("event_ts")).alias("event_date"))
        .agg(
            F.count(F.lit(1)).alias("lines_scanned"),
            F.count_if(F.col("error").isNull()).alias("lines_to_load"),
            F.count_if(F.col("error").isNotNull()).alias("lines_failed"),
        )
        .orderBy(F.asc_nulls_last("event_date"))
    )


def load(
    table: FactTable,
    lines: DataFrame,
    source: str,
    audit_root: str | None = None,
    rejects_root: str | None = None,
    intra_batch: str = "all",
    match_dates: str = "all",
    ignore_case: bool = True,
    loaded_at: dt.datetime | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    batch_id: str | None = None,
) -> dict:
    """Upsert lines into the table; returns source, rows loaded and seconds taken.

    1. Parse once into a staging folder, counting on the way.
    2. Find the folders that already hold a staged id, in the table's id
       lookup: the ids go to the tasks that read it, bucket by bucket where
       they are too large together. No fact file is opened for that.
    3. Rewrite those folders without the ids; add the staged rows. Everything
       else stays as it is, so a load of new events only adds files.
    4. Switch readers over, then write audit rows and rejects. Other loads,
       compaction and retention may commit at the same time.

    `match_dates='staged'` searches only the dates of the staged rows, which is
    exact as long as an event id never changes its event time. `batch_id` names
    the reject and audit folders, so that a repeated load replaces its own. For
    that its time must be the same as well: give `loaded_at`, or lines with a
    column of that name.
    """
    if match_dates not in ("all", "staged"):
        raise ValueError(f"match_dates must be 'all' or 'staged', not {match_dates!r}")
    started = time.monotonic()
    at = timing.as_of_column(loaded_at or dt.datetime.now(dt.timezone.utc))
    folder = work_folder(table.spark, "load")
    name = batch_id or f"load-{folder.rsplit('-', 1)[1]}"
    try:
        counts = Observation("staged")
        staged = written(
            stage(lines, at, ignore_case).observe(
                counts,
                F.count(F.lit(1)).alias("scanned"),
                F.count_if(F.col("error").isNull()).alias("good"),
            ),
            f"{folder}/staged",
        )
        scanned, loaded = counts.get["scanned"], counts.get["good"]
        version = 0
        if loaded:
            good = settle(fact_rows(staged), intra_batch)
            version = _merge(table, good, f"{folder}/ids", match_dates, broadcast_bytes)
        if rejects_root and scanned > loaded:
            rejects.store(_load_rejects(staged), rejects_root, batch_id=name)
        if audit_root:
            _store_audit(audit_rows(staged, version), audit_root, name)
    finally:
        folders.remove(table.spark, folder)
    return {
        "source": source,
        "rows_loaded": loaded,
        "lines_failed": scanned - loaded,
        "elapsed_secs": round(time.monotonic() - started, 3),
    }


def merge(table: FactTable, rows: DataFrame, intra_batch: str = "all", broadcast_bytes: int = BROADCAST_BYTES) -> int:
    """Upsert fact rows; returns the new version. The rows are written out first, so that all steps see the same."""
    folder = work_folder(table.spark, "merge")
    try:
        good = written(settle(rows.select(*FACT_COLUMNS), intra_batch), f"{folder}/rows")
        return _merge(table, good, f"{folder}/ids", "all", broadcast_bytes)
    finally:
        folders.remove(table.spark, folder)


def _merge(table: FactTable, good: DataFrame, ids_folder: str, match_dates: str, broadcast_bytes: int) -> int:
    """Put the staged rows in place of the rows with their ids; returns the new version.

    Other writes may commit meanwhile. Folders they add are looked through as well; only when one holds a staged id,
    or a folder to rewrite is gone, does the merge start anew.
    """
    # Written out, so that the joins below do not each repeat the distinct.
    distinct = Observation("ids")
    size = F.sum(F.octet_length("event_id") + F.lit(ID_BYTES))
    ids = good.select("event_id").distinct().observe(distinct, F.coalesce(size, F.lit(0)).alias("bytes"))
    ids = written(ids, ids_folder)
    id_bytes = distinct.get["bytes"]
    small = id_bytes <= broadcast_bytes

    dates = None
    if match_dates == "staged":
        dates = {str(r["d"]) for r in good.select(F.to_date("event_ts").alias("d")).distinct().collect()}

    def holding(parts):
        searched = [p for p in parts if dates is None or p[0] in dates]
        return table.holding(ids, searched, id_bytes, broadcast_bytes) if searched else set()

    while True:
        base = table.snapshot()
        hit = holding(base.parts)
        rows = good
        if hit:
            keys, spread = (F.broadcast(ids), 0) if small else (ids, SPREAD)
            rows = upsert(table.open(hit).select(*FACT_COLUMNS), good, staged_ids=keys, spread=spread)
        with table.writing() as version:
            added = table.write(version, rows)
            if table.commit_over(base, added, hit, may_add=lambda parts: not holding(parts)) is not None:
                return version


def _load_rejects(staged: DataFrame) -> DataFrame:
    failed = staged.where(F.col("error").isNotNull()).select(
        F.col("kinesis_seq").alias("sequence_number"),
        F.col("line").alias("raw"),
        F.lit(None).cast("string").alias("data"),
        "error",
        F.lit(LOAD_ERROR).alias("error_type"),
        "loaded_at",
    )
    return rejects.as_rejects(failed, F.col("loaded_at"))


def _store_audit(audit: DataFrame, root: str, batch_id: str) -> None:
    """Write audit rows to the folder of their batch, in place of those of an earlier attempt."""
    (
        audit.withColumn("batch_id", F.lit(batch_id))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("batch_id")
        .parquet(root)
    )


def audit_rows(staged: DataFrame, load_id) -> DataFrame:
    """One row per loaded file."""
    return staged.groupBy("file").agg(
        F.lit(load_id).cast("long").alias("load_id"),
        F.count(F.lit(1)).alias("lines_scanned"),
        F.count_if(F.col("error").isNull()).alias("lines_loaded"),
        F.count_if(F.col("error").isNotNull()).alias("lines_failed"),
        F.max("loaded_at").alias("completed_at"),
    )


def load_history(audit: DataFrame, as_of=None, hours: int = 24, top: int = 50) -> DataFrame:
    """The newest load records with their share of good lines."""
    now = timing.as_of_column(as_of)
    return (
        audit.where(F.col("completed_at") >= now - timing.hours(hours))
        .orderBy(F.desc("completed_at"), "file", "load_id")
        .limit(top)
        .select(
            "load_id",
            F.substring("file", 1, 60).alias("file"),
            "lines_scanned",
            "lines_loaded",
            "lines_failed",
            measures.percent(F.col("lines_loaded"), F.col("lines_scanned"), 1).alias("success_pct"),
            "completed_at",
        )
    )
