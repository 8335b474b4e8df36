"""Events to keyed messages and stream records, and back."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from tidemark.functions import json_text
from tidemark.schema import PAYLOAD_SCHEMA


def keyed_messages(events: DataFrame, key: str = "user_id", drop_null_fields: bool = False) -> DataFrame:
    """`key`, `value` (the whole row as JSON): the form message sinks take."""
    options = {"ignoreNullFields": str(drop_null_fields).lower()}
    return events.select(
        F.col(key).alias("key"), F.to_json(F.struct(*events.columns), options).alias("value")
    )


def as_records(messages: DataFrame, sequence, arrival_ts, shard_id=None, extra=()) -> DataFrame:
    """Stream records from `key`, `value` messages, as a stream service would make them."""
    return messages.select(
        sequence.cast("string").alias("sequence_number"),
        F.col("key").alias("partition_key"),
        # Spark breaks long base64 text into lines; records hold one line.
        F.translate(F.base64(F.col("value").cast("binary")), "\r\n", "").alias("data"),
        arrival_ts.alias("arrival_ts"),
        (F.lit(None) if shard_id is None else shard_id).cast("string").alias("shard_id"),
        *extra,
    )


def unpack(deliveries: DataFrame) -> DataFrame:
    """Stream records from delivered batches: rows with an array `Records`."""
    one = deliveries.select(F.explode("Records").alias("record")).select("record.kinesis")
    return one.select(
        F.col("kinesis.sequenceNumber").alias("sequence_number"),
        F.col("kinesis.partitionKey").alias("partition_key"),
        F.col("kinesis.data").alias("data"),
        F.timestamp_micros((F.col("kinesis.approximateArrivalTimestamp") * 1_000_000).cast("long")).alias("arrival_ts"),
        F.lit(None).cast("string").alias("shard_id"),
    )


def decode(records: DataFrame) -> DataFrame:
    """Add `raw`: the record's JSON text, NULL for bad base64 or UTF-8.

    `data` is base64 text, or the bytes themselves where a connector gives them.
    """
    as_bytes = isinstance(records.schema["data"].dataType, BinaryType)
    decoder = json_text.decode_bytes if as_bytes else json_text.decode_data
    return records.withColumn("raw", decoder(F.col("data")))


def with_payload(decoded: DataFrame) -> DataFrame:
    """Add `payload`, the typed form of `raw`; unknown fields stay in `raw`."""
    return decoded.withColumn("payload", F.from_json("raw", PAYLOAD_SCHEMA))


def find_by_field(decoded: DataFrame, path: str, value: str) -> DataFrame:
    """Decoded records whose payload holds a value at a JSON path."""
    return decoded.where(json_text.path_equals(F.col("raw"), path, value))
