"""The fixtures of `checks.fixtures` once more, in SQL."""

from tidemark.schema import VALID_EVENT_TYPES

AS_OF = "TIMESTAMP '2024-01-31 00:00:00'"
RECENT = f"event_ts >= {AS_OF} - INTERVAL 30 DAY"

SRC = "src AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"

FACT = (
    SRC
    + """,
fact AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, ts AS event_ts,
         'user_' || user_id AS user_id,
         's-' || user_id || strftime(ts, '-%Y%m%d%H') AS session_id,
         nullif('/p' || (k % 5), '/p4') AS page,
         k * 30 AS duration_ms,
         CAST(value AS DECIMAL(12,2)) AS value,
         '1.0.0' AS producer_ver, 'us-east-1' AS aws_region,
         lpad(CAST(event_id AS VARCHAR), 20, '0') AS kinesis_seq,
         'lambda-transformer-v1' AS processed_by,
         ts + to_microseconds(((event_id * 7919) % 90000) * 1000) AS loaded_at,
         k
  FROM src)"""
)

# One row per record: first deliveries, and what is delivered twice or sent again.
RECORDS = (
    FACT
    + """,
first_records AS (
  SELECT *, kinesis_seq AS sequence_number, event_ts + INTERVAL 1 SECOND AS arrival_ts,
         CAST(('0x' || substring(md5(user_id), 1, 8)) AS BIGINT) % 10 AS shard,
         CASE WHEN k = 7 THEN 'bad_json' WHEN k = 13 THEN 'missing_fields' WHEN k = 21 THEN 'not_object'
              WHEN k IN (29, 37) THEN 'bad_encoding' END AS error_type
  FROM fact),
redelivered AS (
  SELECT * REPLACE (event_ts + INTERVAL 61 SECOND AS arrival_ts) FROM first_records WHERE event_type = 'error'),
resent AS (
  SELECT * REPLACE (event_ts + INTERVAL 120 SECOND AS arrival_ts, 'r' || sequence_number AS sequence_number)
  FROM first_records WHERE event_type = 'signup'),
twice AS (SELECT * FROM first_records UNION ALL SELECT * FROM redelivered),
all_records AS (SELECT * FROM twice UNION ALL SELECT * FROM resent)"""
)

PAYLOAD = (
    """'{"event_id":"' || event_id || '","event_type":"' || event_type || '","timestamp":"'
 || strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z","user_id":"' || user_id || '","session_id":"' || session_id
 || '","properties":{"page":' || coalesce('"' || page || '"', 'null') || ',"duration_ms":' || duration_ms
 || ',"value":' || CAST(value AS VARCHAR) || '},"metadata":{"producer_version":"1.0.0","region":"us-east-1"}}'"""
)

ALLOWED = "[''" + "'', ''".join(sorted(VALID_EVENT_TYPES)) + "'']"

FACT_COLUMNS = (
    "event_id, event_type, event_ts, user_id, session_id, page, duration_ms, value, producer_ver, "
    "aws_region, kinesis_seq, processed_by"
)


def half_up(total: str, count: str, digits: int) -> str:
    """total / count rounded half up with whole numbers; `total` is not negative."""
    scale = 10**digits
    return f"CAST((2 * {scale} * CAST({total} AS HUGEINT) + {count}) // (2 * {count}) AS DOUBLE) / {scale}"


def percent(part: str, whole: str, digits: int = 2) -> str:
    return half_up(f"100 * ({part})", f"nullif({whole}, 0)", digits)


def cents(column: str = "value") -> str:
    """Sum of a two-digit amount as whole cents."""
    return f"sum(CAST(round({column} * 100) AS BIGINT))"


def mean_amount(column: str = "value") -> str:
    n = f"count({column})"
    return f"CAST((2 * {cents(column)} + {n}) // (2 * {n}) AS DOUBLE) / 100"
