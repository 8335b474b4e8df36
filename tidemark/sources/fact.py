"""The fact table: parquet by event date, replaced by folder and switched at once, by any number of writers.

Every write puts its dates into new folders `version=/event_date=`, then a small list of the folders in use, and then
claims the next commit number for that list. A number can be claimed once. Who comes second reads the list that won,
checks that the folders it replaces are still in use, and tries the next number with its change on top of that list.
Readers follow the newest commit, so they see the table before or after a write and never between, and a write that
dies leaves nothing visible.

Beside its data each version keeps the ids it holds, with their dates, in hash buckets. A load looks its ids up there
and opens only the fact folders that hold one of them.
"""

import datetime as dt
import random
import time
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.matching import SPREAD, matched
from tidemark.schema import FACT_SCHEMA
from tidemark.sources import folders

TABLE_SCHEMA = T.StructType(
    [*FACT_SCHEMA.fields, T.StructField("event_date", T.DateType()), T.StructField("version", T.LongType())]
)

_LIVE_SCHEMA = (
    "event_date string, version long, rows long, bytes long, min_ts timestamp, max_ts timestamp, "
    "max_loaded_at timestamp"
)
_IDS_SCHEMA = "event_id string, event_date date, bucket int, version long"

# Hash buckets of the id lookup, and bytes of ids that are sent to all tasks at a time.
ID_BUCKETS = 64
BROADCAST_BYTES = 128 * 1024 * 1024

# A version number is a time in nanoseconds, less its last digits.
_ID_STEP = 1_000_000
# How long a write may take before what it left is taken for that of a dead one.
WRITE_SECONDS = 86_400


class Conflict(RuntimeError):
    """Another write has replaced a folder that this one was to replace."""


@dataclass(frozen=True)
class Snapshot:
    """The folders (date, version) in use after a commit."""

    number: int
    list_id: int | None
    parts: frozenset


class FactTable:
    def __init__(self, spark: SparkSession, root: str, id_buckets: int = ID_BUCKETS):
        self.spark = spark
        root = root.rstrip("/")
        self.data = f"{root}/data"
        self.lists = f"{root}/live"
        self.commits = f"{root}/commits"
        self.leases = f"{root}/writing"
        self.buckets = id_buckets
        self.ids = f"{root}/ids-{id_buckets}"

    # --- what is in use -----------------------------------------------------

    def _newest(self) -> tuple[int, int | None]:
        """Number of the newest commit and its list."""
        numbers = [n for n in folders.names(self.spark, self.commits) if n.isdigit()]
        if numbers:
            return int(numbers[-1]), folders.read_number(self.spark, f"{self.commits}/{numbers[-1]}")
        # Tables written before commits were numbered: the newest list that is complete.
        for version in sorted(folders.parts(self.spark, self.lists, "version"), key=int, reverse=True):
            if "_SUCCESS" in folders.names(self.spark, f"{self.lists}/version={version}"):
                return 0, int(version)
        return 0, None

    def _listed(self, list_id: int | None) -> DataFrame:
        if list_id is None:
            return self.spark.createDataFrame([], _LIVE_SCHEMA)
        return self.spark.read.schema(_LIVE_SCHEMA).parquet(f"{self.lists}/version={list_id}")

    def live(self) -> DataFrame:
        """Folders in use with their row counts, sizes and time ranges."""
        return self._listed(self._newest()[1])

    def snapshot(self) -> Snapshot:
        number, list_id = self._newest()
        # One row per folder: dates times loads since the last compaction.
        parts = self._listed(list_id).select("event_date", "version").collect()
        return Snapshot(number, list_id, frozenset(tuple(r) for r in parts))

    @staticmethod
    def _new_id() -> int:
        """Never used before, later ones larger; of two at the same moment the last digits differ."""
        return time.time_ns() // _ID_STEP * _ID_STEP + random.randrange(_ID_STEP)

    # --- reading ------------------------------------------------------------

    def read(self, since=None, until=None, dates=None, loaded_since=None) -> DataFrame:
        """Fact rows with `event_date` and `version`.

        `since`/`until` (dates), `dates` and `loaded_since` (a timestamp
        column) only choose which folders are opened; they filter no rows.
        """
        live = self.live()
        if since is not None:
            live = live.where(F.col("event_date") >= str(since))
        if until is not None:
            live = live.where(F.col("event_date") <= str(until))
        if dates is not None:
            live = live.where(F.col("event_date").isin([str(d) for d in dates]))
        if loaded_since is not None:
            live = live.where(F.col("max_loaded_at") >= loaded_since)
        return self.open([(r["event_date"], r["version"]) for r in live.collect()])

    def recent(self, as_of: dt.datetime | None = None, hours: int = 1) -> DataFrame:
        """Rows of the dates a look-back reaches; files of other dates are not even listed."""
        now = as_of or dt.datetime.now(dt.timezone.utc)
        return self.read(since=(now - dt.timedelta(hours=hours)).date())

    def open(self, parts) -> DataFrame:
        """Rows of the given (date, version) folders."""
        if not parts:
            return self.spark.createDataFrame([], TABLE_SCHEMA)
        paths = [f"{self.data}/version={v}/event_date={d}" for d, v in sorted(parts)]
        return (
            self.spark.read.schema(TABLE_SCHEMA)
            .option("basePath", self.data)
            .parquet(*paths)
            .select(*TABLE_SCHEMA.fieldNames())
        )

    def find(self, event_ids: list[str]) -> DataFrame:
        """Rows of some event ids: only folders that hold one are opened, and in them only row groups that may."""
        ids = self.spark.createDataFrame([(i,) for i in event_ids], "event_id string")
        held = self.holding(ids, self.snapshot().parts, sum(map(len, event_ids)))
        return self.open(held).where(F.col("event_id").isin(list(event_ids)))

    # --- the id lookup --------------------------------------------------------

    def bucket(self, event_id="event_id"):
        return F.pmod(F.xxhash64(event_id), F.lit(self.buckets)).cast("int")

    def holding(self, ids: DataFrame, parts, id_bytes: int, limit: int = BROADCAST_BYTES) -> set:
        """Those of the (date, version) folders that hold one of the distinct ids; `id_bytes` is the ids' size.

        Ids are sent to the tasks that read the lookup, bucket by bucket where they are too large together, so the
        lookup itself is never shuffled. One query asks for some buckets and the next begins when it is done, so the
        driver holds the ids of one at a time; none follows once every folder is found. Versions without a lookup are
        searched by their id column.
        """
        known = {int(v) for v in folders.parts(self.spark, self.ids, "version")}
        covered = {p for p in parts if p[1] in known}
        found = set()
        if covered:
            versions = sorted({v for _, v in covered})
            lookup = (
                self.spark.read.schema(_IDS_SCHEMA)
                .option("basePath", self.ids)
                .parquet(*[f"{self.ids}/version={v}" for v in versions])
            )
            for some in self._by_buckets(lookup, ids, id_bytes, limit):
                hits = some.select(F.col("event_date").cast("string"), "version")
                found |= {tuple(r) for r in hits.distinct().collect()} & covered
                if found == covered:
                    break
        bare = set(parts) - covered
        if bare:
            small = id_bytes <= limit
            searched = self.open(bare).select("event_id", F.col("event_date").cast("string"), "version")
            hits = matched(searched, F.broadcast(ids) if small else ids, "event_id", 0 if small else SPREAD)
            found |= {tuple(r) for r in hits.select("event_date", "version").distinct().collect()}
        return found

    def _by_buckets(self, lookup: DataFrame, ids: DataFrame, id_bytes: int, limit: int):
        """Rows of the lookup with one of the ids, in frames of which each sends ids within the limit."""
        keyed = ids.select("event_id", self.bucket().alias("bucket"))
        each = max(1, self.buckets * limit // max(1, id_bytes)) if limit else 0
        if id_bytes <= limit:
            yield lookup.join(F.broadcast(keyed), ["bucket", "event_id"], "left_semi")
        elif not each or id_bytes > limit * self.buckets:  # one bucket alone is too large
            yield lookup.join(keyed.hint("merge"), ["bucket", "event_id"], "left_semi")
        else:
            for first in range(0, self.buckets, each):
                own = F.col("bucket").between(first, first + each - 1)
                yield lookup.where(own).join(F.broadcast(keyed.where(own)), ["bucket", "event_id"], "left_semi")

    def _bucketed(self, lookup: DataFrame, ids: DataFrame, id_bytes: int, limit: int) -> DataFrame:
        """All of `_by_buckets` in one frame; run at once, all ids reach the driver together."""
        return reduce(DataFrame.unionByName, self._by_buckets(lookup, ids, id_bytes, limit))

    def _write_ids(self, version: int) -> None:
        """The ids of one version, read back from its files by column, few files, each sorted by bucket."""
        parts = [(d, version) for d in folders.parts(self.spark, f"{self.data}/version={version}", "event_date")]
        rows = self.open(parts).select("event_id", "event_date", self.bucket().alias("bucket"))
        placed = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "event_id")
        placed.write.parquet(f"{self.ids}/version={version}")

    # --- writing ------------------------------------------------------------

    @contextmanager
    def writing(self):
        """A new version number that `purge` leaves alone until the block ends."""
        version = self._new_id()
        lease = f"{self.leases}/{version}"
        folders.write_number(self.spark, lease, version)
        try:
            yield version
        finally:
            folders.remove(self.spark, lease)

    def write(self, version: int, rows: DataFrame) -> list[tuple]:
        """Write the folders of a new version; returns their list entries. Readers do not see them yet.

        Rows are rebalanced by event hour and sorted by time: files hold narrow
        time ranges for row-group skipping, an hour with most of the rows is
        split over many files, and quiet hours share one.
        """
        (
            rows.select(*FACT_SCHEMA.fieldNames())
            .withColumns({"event_date": F.to_date("event_ts"), "_hour": F.date_trunc("hour", "event_ts")})
            .hint("rebalance", "event_date", "_hour")
            .sortWithinPartitions("event_date", "event_ts")
            .drop("_hour")
            .write.option("parquet.bloom.filter.enabled#event_id", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .partitionBy("event_date")
            .parquet(f"{self.data}/version={version}")
        )
        self._write_ids(version)
        return self._described(version)

    def _described(self, version: int) -> list[tuple]:
        """Counts, sizes and ranges of the folders one version wrote, read back by column; one per date."""
        base = f"{self.data}/version={version}"
        parts = [(d, version) for d in folders.parts(self.spark, base, "event_date")]
        found = (
            self.open(parts)
            .groupBy(F.col("event_date").cast("string").alias("event_date"))
            .agg(
                F.count(F.lit(1)).alias("rows"),
                F.min("event_ts").alias("min_ts"),
                F.max("event_ts").alias("max_ts"),
                F.max("loaded_at").alias("max_loaded_at"),
            )
        )
        return [
            (r["event_date"], version, r["rows"], folders.size(self.spark, f"{base}/event_date={r['event_date']}"),
             r["min_ts"], r["max_ts"], r["max_loaded_at"])
            for r in found.collect()
        ]

    def publish(self, base: Snapshot, added=(), replaces=(), kept_if=None) -> bool:
        """Claim the commit after `base`: its folders without `replaces` (and only those `kept_if` holds for), and
        the entries `added`. False when another write has claimed it."""
        live = self._listed(base.list_id)
        if kept_if is not None:
            live = live.where(kept_if)
        if replaces:
            folder = F.concat_ws("/", "event_date", F.col("version").cast("string"))
            live = live.where(~folder.isin([f"{d}/{v}" for d, v in replaces]))
        if added:
            live = live.unionByName(self.spark.createDataFrame(list(added), _LIVE_SCHEMA))
        return self._publish(live, base.number + 1)

    def _publish(self, live: DataFrame, number: int) -> bool:
        list_id = self._new_id()
        live.coalesce(1).write.parquet(f"{self.lists}/version={list_id}")
        return folders.create_once(self.spark, f"{self.commits}/{number:012d}", list_id)

    def commit_over(self, base: Snapshot, added=(), replaces=(), may_add=None) -> Snapshot | None:
        """Publish on top of `base` or of whatever was committed since.

        None when a replaced folder is no longer in use, or when `may_add` refuses the folders that others have added
        meanwhile: then the change has to be worked out anew.
        """
        while not self.publish(base, added, replaces):
            newer = self.snapshot()
            if not set(replaces) <= newer.parts:
                return None
            if may_add is not None and not may_add(newer.parts - base.parts):
                return None
            base = newer
        return base

    def commit(self, rows: DataFrame, replaces=()) -> int:
        """Add rows as a new version; the (date, version) folders in `replaces` go out of use with it."""
        replaces = {(str(d), v) for d, v in replaces}
        base = self.snapshot()
        if not replaces <= base.parts:
            raise Conflict(f"no longer in use: {sorted(replaces - base.parts)}")
        with self.writing() as version:
            added = self.write(version, rows)
            if self.commit_over(base, added, replaces) is None:
                raise Conflict("a folder to replace was replaced meanwhile")
        return version

    def keep_from(self, first_kept: dt.date) -> int:
        """Retention: take earlier dates out of use, also those others add meanwhile; their files go with `purge`."""
        while True:
            base = self.snapshot()
            if self.publish(base, kept_if=F.col("event_date") >= str(first_kept)):
                return base.number + 1

    def purge(self, write_seconds: int = WRITE_SECONDS, keep_commits: int = 1_000) -> int:
        """Remove data folders and lists no longer in use; returns how many data folders.

        Run it when no report still reads an older list. Folders of a write that goes on are left alone, for
        `write_seconds` at most. The newest commit numbers stay claimed, so that a slow writer can't take one again.
        """
        number, newest = self._newest()
        leased = {int(n) for n in folders.names(self.spark, self.leases) if n.isdigit()}
        alive = {v for v in leased if v > time.time_ns() - write_seconds * 1_000_000_000}
        used = self.snapshot().parts
        removed = 0
        for version in map(int, folders.parts(self.spark, self.data, "version")):
            if version in alive:
                continue
            days = folders.parts(self.spark, f"{self.data}/version={version}", "event_date")
            unused = [d for d in days if (d, version) not in used]
            for day in unused:
                folders.remove(self.spark, f"{self.data}/version={version}/event_date={day}")
            removed += len(unused)
            if len(unused) == len(days):
                folders.remove(self.spark, f"{self.data}/version={version}")
                folders.remove(self.spark, f"{self.ids}/version={version}")
        for version in map(int, folders.parts(self.spark, self.lists, "version")):
            if newest is not None and version < newest and version not in alive:
                folders.remove(self.spark, f"{self.lists}/version={version}")
        for name in folders.names(self.spark, self.commits):
            if name.isdigit() and int(name) <= number - keep_commits:
                folders.remove(self.spark, f"{self.commits}/{name}")
        for version in leased - alive:
            folders.remove(self.spark, f"{self.leases}/{version}")
        return removed
