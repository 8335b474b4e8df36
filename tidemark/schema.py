"""Fixed values and schemas of the event data model.

The names, widths, lists and patterns below are part of the data contract:
records, landed files and the fact table are exchanged with other systems, so
these values have to stay exactly as they are.
"""

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------

REQUIRED_FIELDS = ("event_id", "event_type", "timestamp", "user_id")

VALID_EVENT_TYPES = (
    "page_view",
    "click",
    "purchase",
    "signup",
    "error",
    "api_call",
    "session_start",
    "session_end",
    "search",
    "add_to_cart",
    "checkout",
)

# Only the start of the text is checked, so month 13 passes here and is caught
# when the load parses the timestamp.
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}"

PROCESSOR = "lambda-transformer-v1"
META_VERSION = "1.0"

KEY_MEMORY_SECONDS = 86_400
REJECT_RETENTION_DAYS = 14
EVENT_RETENTION_DAYS = 365

SANITIZED_LENGTH = 255
PREVIEW_ROWS = 5
PREVIEW_CHARS = 200

# Declared character widths of the fact table's text columns.
COLUMN_WIDTHS = {
    "event_id": 36,
    "event_type": 64,
    "user_id": 64,
    "session_id": 36,
    "page": 255,
    "producer_ver": 16,
    "aws_region": 32,
    "kinesis_seq": 128,
    "processed_by": 64,
}

# Rows are matched and users counted by these: never cut, but rejected when over-long.
KEY_COLUMNS = ("event_id", "user_id")

SHARD_RECORDS_PER_SECOND = 1_000
BAND_YELLOW_PCT = 60
BAND_RED_PCT = 85

# metric, threshold, period in seconds, consecutive periods
ALARM_RULES = (
    ("records_per_second_per_shard", 900.0, 60, 1),
    ("errors", 10.0, 60, 2),
    ("reject_backlog", 100.0, 300, 1),
    ("delivery_freshness_seconds", 120.0, 60, 1),
)

# Outcome of a good record, and the reject kinds in the order they are tested.
VALID = "valid"
BAD_ENCODING = "bad_encoding"
BAD_JSON = "bad_json"
NOT_OBJECT = "not_object"
MISSING_FIELDS = "missing_fields"
INVALID_FIELDS = "invalid_fields"
REJECT_KINDS = (BAD_ENCODING, BAD_JSON, NOT_OBJECT, MISSING_FIELDS, INVALID_FIELDS)
# Lines that landed but do not fit the fact table.
LOAD_ERROR = "load_error"

# --- schemas ----------------------------------------------------------------

RECORD_SCHEMA = T.StructType(
    [
        T.StructField("sequence_number", T.StringType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("data", T.StringType()),
        T.StructField("arrival_ts", T.TimestampType()),
        T.StructField("shard_id", T.StringType()),
    ]
)

# A delivered batch of records, as JSON.
DELIVERY_SCHEMA = (
    "Records array<struct<kinesis: struct<sequenceNumber: string, partitionKey: string, data: string, "
    "approximateArrivalTimestamp: double>, eventSource: string, awsRegion: string>>"
)

PROPERTIES_SCHEMA = T.StructType(
    [
        T.StructField("page", T.StringType()),
        T.StructField("duration_ms", T.IntegerType()),
        T.StructField("value", T.DecimalType(12, 2)),
    ]
)

METADATA_SCHEMA = T.StructType(
    [
        T.StructField("producer_version", T.StringType()),
        T.StructField("region", T.StringType()),
    ]
)

META_SCHEMA = T.StructType(
    [
        T.StructField("kinesis_sequence", T.StringType()),
        T.StructField("kinesis_shard_id", T.StringType()),
        T.StructField("processed_at", T.StringType()),
        T.StructField("processed_by", T.StringType()),
        T.StructField("schema_version", T.StringType()),
    ]
)

PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("properties", PROPERTIES_SCHEMA),
        T.StructField("metadata", METADATA_SCHEMA),
        T.StructField("_meta", META_SCHEMA),
    ]
)

FACT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_ts", T.TimestampType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("session_id", T.StringType()),
        T.StructField("page", T.StringType()),
        T.StructField("duration_ms", T.IntegerType()),
        T.StructField("value", T.DecimalType(12, 2)),
        T.StructField("producer_ver", T.StringType()),
        T.StructField("aws_region", T.StringType()),
        T.StructField("kinesis_seq", T.StringType()),
        T.StructField("processed_by", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)
FACT_COLUMNS = FACT_SCHEMA.fieldNames()
FACT_NOT_NULL = ("event_id", "event_type", "event_ts", "user_id")

REJECT_SCHEMA = T.StructType(
    [
        T.StructField("reject_id", T.StringType()),
        T.StructField("sequence_number", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("rejected_at", T.TimestampType()),
    ]
)

BATCH_LOG_SCHEMA = T.StructType(
    [
        T.StructField("batch_id", T.LongType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("duration_ms", T.LongType()),
        T.StructField("received", T.LongType()),
        T.StructField("processed", T.LongType()),
        T.StructField("skipped", T.LongType()),
        T.StructField("errors", T.LongType()),
        T.StructField("failed", T.IntegerType()),
    ]
)

LOAD_AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("load_id", T.LongType()),
        T.StructField("file", T.StringType()),
        T.StructField("lines_scanned", T.LongType()),
        T.StructField("lines_loaded", T.LongType()),
        T.StructField("lines_failed", T.LongType()),
        T.StructField("completed_at", T.TimestampType()),
    ]
)

SEEN_KEY_SCHEMA = T.StructType(
    [
        T.StructField("sequence_number", T.StringType()),
        T.StructField("processed_at", T.LongType()),
        T.StructField("ttl", T.LongType()),
    ]
)
