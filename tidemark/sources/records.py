"""Reading stream records and publishing keyed messages.

The stream service is chosen by the `format` and `options` of Spark's own
source and sink API. A file folder stands in for it where no connector is
installed.
"""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import timing
from tidemark.operators.envelope import keyed_messages, unpack
from tidemark.schema import DELIVERY_SCHEMA, RECORD_SCHEMA

FILE_FORMATS = ("parquet", "json", "orc", "csv")

# What a source may admit to one batch where the caller sets no bound, so that a backlog is caught up with in many.
ADMISSION = {"files": {"maxBytesPerTrigger": str(4 << 30)}, "kafka": {"maxOffsetsPerTrigger": "10000000"}}
_BOUNDS = {"maxfilespertrigger", "maxbytespertrigger", "maxoffsetspertrigger"}

# Record columns from what a message connector delivers.
MESSAGE_COLUMNS = {
    "sequence_number": "concat_ws('-', topic, cast(partition as string), lpad(cast(offset as string), 20, '0'))",
    "partition_key": "cast(key as string)",
    "data": "value",
    "arrival_ts": "timestamp",
    "shard_id": "cast(partition as string)",
}


def _as_records(df: DataFrame, columns) -> DataFrame:
    """The record columns; `data` keeps its type, since messages come as bytes."""
    if columns:
        return df.select(*[F.expr(columns[name]).alias(name) for name in RECORD_SCHEMA.fieldNames()])
    return df.select(*RECORD_SCHEMA.fieldNames())


def _columns_for(fmt: str, columns):
    if columns is None and fmt not in FILE_FORMATS:
        return MESSAGE_COLUMNS
    return columns


def stream_records(
    spark: SparkSession, path=None, fmt: str = "parquet", options=None, columns=None, since=None
) -> DataFrame:
    """Records as a stream.

    `since` skips records that arrived earlier: pass the moment of the first
    start to begin at the newest record, leave it out to begin at the oldest
    retained one. It has to stay the same across restarts of one checkpoint.
    A batch is bounded by the source's own option, `ADMISSION` where none is given.
    """
    options = dict(options or {})
    if not _BOUNDS & {name.lower() for name in options}:
        options |= ADMISSION.get("files" if fmt in FILE_FORMATS else fmt, {})
    reader = spark.readStream.format(fmt).options(**options)
    if fmt in FILE_FORMATS:
        reader = reader.schema(RECORD_SCHEMA)
    records = _as_records(reader.load(path) if path else reader.load(), _columns_for(fmt, columns))
    if since is not None:
        records = records.where(F.col("arrival_ts") >= timing.as_of_column(since))
    return records


def read_records(spark: SparkSession, path=None, fmt: str = "parquet", options=None, columns=None) -> DataFrame:
    """All retained records, from the oldest on, as a bounded frame."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if fmt in FILE_FORMATS:
        reader = reader.schema(RECORD_SCHEMA)
    return _as_records(reader.load(path) if path else reader.load(), _columns_for(fmt, columns))


def read_deliveries(spark: SparkSession, path: str) -> DataFrame:
    """Records from JSON files of delivered batches (`{"Records": [...]}`)."""
    return unpack(spark.read.schema(DELIVERY_SCHEMA).json(path, multiLine=True))


def publish(
    events: DataFrame, path=None, fmt: str = "json", options=None, key: str = "user_id", order_by: str = "timestamp"
) -> dict:
    """Write events as keyed messages, in order within each key.

    A message service takes a key's messages in order only from one writer, so
    each key goes to one task, sorted. Files are ordered by their names, so
    there a key with very many events is split over several tasks by time.

    Returns `{sent, failed}`. A Spark write is all or nothing: a failed task is
    retried, and when the write fails as a whole every event counts as failed.
    """
    if fmt in FILE_FORMATS:
        placed = events.repartitionByRange(key, order_by)
    else:
        placed = events.repartition(key)
    messages = keyed_messages(placed.sortWithinPartitions(key, order_by), key)
    return send(messages, path, fmt, options)


def send(messages: DataFrame, path=None, fmt: str = "json", options=None) -> dict:
    """Write `key`, `value` messages to a sink; returns `{sent, failed}`."""
    counted = Observation()
    # Counted in the writing stage itself: stages before a shuffle may run twice.
    observed = messages.select("key", "value").observe(counted, F.count(F.lit(1)).alias("sent"))
    writer = observed.write.format(fmt).mode("append").options(**(options or {}))
    try:
        writer.save(path) if path else writer.save()
    except Exception as problem:
        raise PublishError(messages.count()) from problem
    return {"sent": counted.get["sent"], "failed": 0}


class PublishError(RuntimeError):
    """A publish call that failed as a whole; `result` holds its counts."""

    def __init__(self, failed: int):
        super().__init__(f"publish failed for {failed} events")
        self.result = {"sent": 0, "failed": failed}
