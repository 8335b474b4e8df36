"""Table statistics, sorting, skew, compaction and retention."""

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import measures, timing
from tidemark.schema import EVENT_RETENTION_DAYS, FACT_COLUMNS
from tidemark.sources.fact import FactTable

TARGET_BYTES = 256 * 1024 * 1024
SKEW_TARGET = 1.5
MEGABYTE = 1024 * 1024


def file_stats(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Rows, size and time range of every file behind a frame read from files."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.max("_metadata.file_size").alias("size_bytes"),
        F.min(ts).alias("min_ts"),
        F.max(ts).alias("max_ts"),
    )


def table_stats(tables: DataFrame, parts: DataFrame, schema_name: str) -> DataFrame:
    """Listed tables of one schema with totals over their parts, largest first.

    `tables`: table_id, schema_name, table_name. `parts`: table_id, rows,
    size_kb, unsorted_pct, stats_off, one row per file or slice.
    """
    totals = parts.groupBy("table_id").agg(
        F.sum("rows").alias("num_rows"),
        F.round(F.sum("size_kb") / 1024.0, 1).alias("size_in_mb"),
        F.max("unsorted_pct").alias("pct_unsorted"),
        F.max("stats_off").alias("stats_off"),
    )
    return (
        tables.where(F.col("schema_name") == schema_name)
        .join(totals, "table_id")
        .select("schema_name", "table_name", "num_rows", "size_in_mb", "pct_unsorted", "stats_off")
        .orderBy(F.desc("size_in_mb"), "table_name")
    )


def unsorted_share(rows: DataFrame, part: str, position: str, ts: str, chunk_rows: int = 1_000_000) -> DataFrame:
    """Rows per part that come after a later-stamped row, and their share.

    A part can be large, so it is cut into chunks of positions. The highest
    stamp before a chunk comes from one row per chunk; inside a chunk a running
    maximum does the rest. No task holds more than one chunk at a time.
    """
    chunked = rows.select(
        F.col(part).alias("part"),
        F.col(position).alias("pos"),
        F.col(ts).alias("ts"),
        F.floor(F.col(position) / F.lit(chunk_rows)).alias("chunk"),
    )
    earlier_chunks = Window.partitionBy("part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    tops = (
        chunked.groupBy("part", "chunk")
        .agg(F.max("ts").alias("top"))
        .select("part", "chunk", F.max("top").over(earlier_chunks).alias("before"))
    )
    earlier_rows = (
        Window.partitionBy("part", "chunk").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    )
    judged = (
        chunked.join(tops, ["part", "chunk"])
        .withColumn("inside", F.max("ts").over(earlier_rows))
        .withColumn("late", F.coalesce(F.col("ts") < F.greatest("before", "inside"), F.lit(False)))
    )
    return (
        judged.groupBy("part")
        .agg(F.count(F.lit(1)).alias("rows"), F.count_if("late").alias("unsorted_rows"))
        .withColumn("unsorted_pct", measures.percent(F.col("unsorted_rows"), F.col("rows")))
    )


def unsorted_files(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Unsorted share of every parquet file behind a frame."""
    rows = df.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("pos"), F.col(ts).alias("ts")
    )
    return unsorted_share(rows, "file", "pos", "ts")


def skew_report(df: DataFrame, key: str = "user_id", slices: int = 16, name: str = "events") -> DataFrame:
    """How evenly rows spread over hash buckets of a key.

    Buckets without rows count as zero.
    """
    bucket = F.pmod(F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long"), F.lit(slices))
    counted = df.groupBy(bucket.alias("slice")).agg(F.count(F.lit(1)).alias("rows"))
    every = df.sparkSession.range(slices).withColumnRenamed("id", "slice")
    spread = every.join(counted, "slice", "left").fillna(0, ["rows"])
    return spread.agg(
        F.lit(name).alias("table_name"),
        F.count(F.lit(1)).alias("slice_count"),
        F.min("rows").alias("min_rows_per_slice"),
        F.max("rows").alias("max_rows_per_slice"),
        measures.ratio(F.sum("rows"), F.count(F.lit(1)), 0).alias("avg_rows_per_slice"),
        measures.ratio(F.max("rows") * F.count(F.lit(1)), F.sum("rows"), 2).alias("skew_ratio"),
    )


def hot_keys(df: DataFrame, key: str = "user_id", top: int = 20) -> DataFrame:
    """The keys with most rows."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), key)
        .limit(top)
    )


def bins(sizes: dict, capacity: int) -> list[list]:
    """Keys dealt into bins of `capacity`, the largest first, each into the first bin with space."""
    out = []
    for key, size in sorted(sizes.items(), key=lambda item: (-item[1], item[0])):
        for own in out:
            if own[0] + size <= capacity:
                own[0] += size
                own[1].append(key)
                break
        else:
            out.append([size, [key]])
    return [keys for _, keys in out]


def folders_to_merge(table: FactTable, target_bytes: int = TARGET_BYTES, min_rows: int = 0, dates=None) -> list[set]:
    """Sets of small folders (date, version), each of one date and together of about the target size."""
    live = table.live()
    if dates is not None:
        live = live.where(F.col("event_date").isin([str(d) for d in dates]))
    by_date, rows = {}, {}
    for r in live.collect():  # one row per folder
        by_date.setdefault(r["event_date"], {})[r["event_date"], r["version"]] = r["bytes"] or 0
        rows[r["event_date"]] = rows.get(r["event_date"], 0) + r["rows"]
    found = []
    for date, sizes in sorted(by_date.items()):
        small = {p: s for p, s in sizes.items() if s < target_bytes}
        if rows[date] > min_rows:
            found += [set(own) for own in bins(small, target_bytes) if len(own) > 1]
    return found


def dates_to_compact(table: FactTable, min_rows: int = 0, target_bytes: int = TARGET_BYTES) -> list:
    """Dates with several small folders that fit into one."""
    return sorted({date for own in folders_to_merge(table, target_bytes, min_rows) for date, _ in own})


def compact(table: FactTable, dates=None, min_rows: int = 0, target_bytes: int = TARGET_BYTES) -> list:
    """Merge the small folders of a date into sorted ones of about the target size; large ones stay. Returns the dates.

    Loads may commit meanwhile: what they add stays, and a folder they replaced is left to the next run. With several
    bins to a date, each goes into a version of its own.
    """
    merged = folders_to_merge(table, target_bytes, min_rows, dates)
    rounds = []  # at most one bin of a date in each
    for own in merged:
        date = next(iter(own))[0]
        for some in rounds:
            if date not in {d for d, _ in some}:
                some |= own
                break
        else:
            rounds.append(set(own))
    for parts in rounds:
        while parts:
            base = table.snapshot()
            gone = {d for d, v in parts - base.parts}
            parts = {(d, v) for d, v in parts if d not in gone}
            if not parts:
                break
            with table.writing() as version:
                added = table.write(version, table.open(parts).select(*FACT_COLUMNS))
                if table.commit_over(base, added, parts) is not None:
                    break
    return sorted({date for own in merged for date, _ in own})


def sort_rows(df: DataFrame, ts: str = "event_ts") -> DataFrame:
    """Rows split into time ranges and sorted inside them: a total order by time."""
    return df.repartitionByRange(ts).sortWithinPartitions(ts)


def retained(df: DataFrame, as_of=None, days: int = EVENT_RETENTION_DAYS, ts: str = "event_ts") -> DataFrame:
    """Rows of the dates still within retention; whole dates are kept or dropped."""
    first = F.to_date(timing.as_of_column(as_of)) - F.make_dt_interval(F.lit(days))
    kept = df.where(F.col(ts) >= first.cast("timestamp"))
    return kept.where(F.col("event_date") >= F.to_date(first)) if "event_date" in df.columns else kept


def apply_retention(table: FactTable, today: dt.date, days: int = EVENT_RETENTION_DAYS) -> int:
    return table.keep_from(today - dt.timedelta(days=days))


def refresh_statistics(spark: SparkSession, table_name: str) -> None:
    """Row counts and column statistics of a catalog table for the optimizer."""
    spark.sql(f"ANALYZE TABLE {table_name} COMPUTE STATISTICS FOR ALL COLUMNS")
