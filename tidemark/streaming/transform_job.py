"""The streaming transform: check, deduplicate, enrich, land."""

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from tidemark.operators import dedupe, enrich, validate
from tidemark.operators.matching import SPREAD
from tidemark.schema import BATCH_LOG_SCHEMA, KEY_MEMORY_SECONDS, VALID_EVENT_TYPES
from tidemark.sources import landing, rejects

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Set by Spark in the thread of a streaming query; stays the same over restarts.
QUERY_ID = "sql.streaming.queryId"

INTAKE = "intake"
OUTCOME = "outcome"


def remembering(checked: DataFrame, memory_seconds: int = KEY_MEMORY_SECONDS) -> DataFrame:
    """Set how long keys are remembered, by the time they were first seen.

    That is `seen_at`, the batch time, and not the record's own time: a late
    or replayed record is never behind the watermark and so never lost. Spark
    keeps a key until the watermark passes its time plus the delay, hence half
    the memory as delay.
    """
    return checked.withWatermark("seen_at", f"{memory_seconds / 2} seconds")


def drop_repeats(checked: DataFrame, key: str, spread: int = SPREAD) -> DataFrame:
    """Drop good records whose key was seen before; rejected ones all pass.

    Rejected records get an id of their own, so none counts as a repeat.

    With `spread`, copies of a key are first reduced within each of that many
    groups of input partitions and then overall. A key that makes up much of a
    batch is so handled by many tasks, at the price of keeping keys twice;
    `spread=0` turns it off.
    """
    own_id = F.when(F.col("error_type").isNotNull(), F.uuid())
    keyed = checked.withColumn("_own", own_id)
    if spread:
        keyed = (
            keyed.withColumn("_spread", F.spark_partition_id() % F.lit(spread))
            .dropDuplicatesWithinWatermark([key, "_own", "_spread"])
            .drop("_spread")
        )
    return keyed.dropDuplicatesWithinWatermark([key, "_own"]).drop("_own")


def transformed(
    records: DataFrame,
    strictness: str = "required",
    event_types=VALID_EVENT_TYPES,
    memory_seconds: int = KEY_MEMORY_SECONDS,
    spread: int = SPREAD,
    by_event_id: bool = False,
) -> DataFrame:
    """Checked and deduplicated records of a stream.

    `by_event_id` adds a second pass on the event id, for events sent again
    under a new sequence number.
    """
    stamped = records.withColumn("seen_at", F.current_timestamp())
    checked = validate.check(stamped, strictness, event_types, with_event_id=by_event_id)
    checked = checked.withColumn("_record", dedupe.record_key(checked)).drop("partition_key")
    checked = checked.observe(
        INTAKE,
        F.count(F.lit(1)).alias("received"),
        F.count_if(F.col("error_type").isNotNull()).alias("errors"),
    )
    unique = drop_repeats(remembering(checked, memory_seconds), "_record", spread)
    if by_event_id:
        # Records without an event id share none: each stands for itself by its own key.
        unique = unique.withColumn("_event_id", F.coalesce("checked_event_id", F.concat(F.lit("\u0000"), "_record")))
        unique = drop_repeats(unique, "_event_id", spread).drop("_event_id", "checked_event_id")
    unique = unique.drop("_record")
    return unique.observe(OUTCOME, F.count_if(F.col("error_type").isNull()).alias("processed"))


def batch_name(batch: DataFrame, batch_id: int) -> str:
    """A name for a batch that no other query has and that a repeat has again.

    Batches are numbered per checkpoint; with the number alone, a run with a
    new checkpoint would replace what another one wrote.
    """
    return f"{batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID)}-{batch_id}"


def batch_writer(root: str, form: str = "short", zone_format: str = "json"):
    """A foreachBatch function: good rows to the landing zone, the rest to rejects.

    `zone_format='parquet'` lands the fact columns instead of JSON lines, for
    zones that are queried in place.

    Both outputs lie in folders of their batch and are replaced when the batch
    runs again. All times come from `seen_at`, which Spark fixes per batch, so
    a second run writes the same folders.
    """

    land = {"json": landing.land, "parquet": landing.land_parquet}[zone_format]

    def write(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch, batch_id)
        batch.persist()
        try:
            good = enrich.enrich(validate.good(batch), form, processed_at=F.col("seen_at"))
            land(good.withColumnRenamed("seen_at", "delivered_at"), root, name)
            rejects.store(rejects.as_rejects(validate.bad(batch), F.col("seen_at")), root, name)
        finally:
            batch.unpersist()

    return write


def start(
    records: DataFrame,
    root: str,
    checkpoint: str,
    trigger: str | None = "60 seconds",
    form: str = "short",
    name: str = "transform",
    batch_log: str | None = None,
    zone_format: str = "json",
    **options,
) -> StreamingQuery:
    """Start the job. `trigger=None` works off what is there and ends.

    The trigger is the landing zone's flush time. A restart with the same
    checkpoint goes on where the last finished batch ended. Keys are kept in
    RocksDB on the executors' disks, not on the JVM heap.
    """
    spark = records.sparkSession
    if batch_log:
        spark.streams.addListener(BatchLog(spark, batch_log, name))
    writer = (
        transformed(records, **options)
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(batch_writer(root, form, zone_format))
    )
    writer = writer.trigger(processingTime=trigger) if trigger else writer.trigger(availableNow=True)
    usual = spark.conf.get(STATE_STORE)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        return writer.start()
    finally:
        spark.conf.set(STATE_STORE, usual)


def counters(progress) -> dict:
    """`{received, processed, skipped, errors}` of one batch, from its progress report."""
    seen = progress.observedMetrics.get(INTAKE)
    out = progress.observedMetrics.get(OUTCOME)
    received = (seen["received"] if seen else 0) or 0
    errors = (seen["errors"] if seen else 0) or 0
    processed = (out["processed"] if out else 0) or 0
    return {
        "received": received,
        "processed": processed,
        "skipped": received - errors - processed,
        "errors": errors,
    }


class BatchLog(StreamingQueryListener):
    """Appends one row per batch of a named query, and one when it fails."""

    def __init__(self, spark, path: str, name: str):
        self._spark = spark
        self._path = path
        self._name = name
        self._runs = set()

    def onQueryStarted(self, event):
        if event.name == self._name:
            self._runs.add(str(event.runId))

    def onQueryProgress(self, event):
        progress = event.progress
        if str(progress.runId) not in self._runs or not progress.numInputRows:
            return
        started = dt.datetime.fromisoformat(progress.timestamp.replace("Z", "+00:00"))
        self._append(progress.batchId, started, progress.batchDuration, counters(progress), 0)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if str(event.runId) in self._runs and event.exception:
            none = {"received": None, "processed": None, "skipped": None, "errors": None}
            self._append(None, dt.datetime.now(dt.timezone.utc), None, none, 1)

    def _append(self, batch_id, started, duration, counts, failed):
        row = (batch_id, started, duration, counts["received"], counts["processed"],
               counts["skipped"], counts["errors"], failed)
        frame = self._spark.createDataFrame([row], BATCH_LOG_SCHEMA)
        frame.coalesce(1).write.mode("append").parquet(self._path)
