"""Records: encode, decode, check, enrich, flatten, deduplicate."""

from pyspark.sql import functions as F

from checks.registry import query
from checks.tables import ALLOWED, FACT_COLUMNS, PAYLOAD, RECORDS
from checks import fixtures as fx
from tidemark.functions import text, timing
from tidemark.operators import dedupe, enrich, envelope, validate
from tidemark.schema import FACT_COLUMNS as FACT_NAMES

LOADED = [c for c in FACT_NAMES if c != "loaded_at"]


def _good(spark, sf_dir, **repeats):
    return validate.good(validate.check(fx.records(spark, sf_dir, **repeats)))


@query(
    f"""WITH {RECORDS}
SELECT sequence_number, CASE WHEN error_type IS DISTINCT FROM 'bad_encoding' THEN true ELSE false END AS decoded
FROM first_records"""
)
def decode_records(spark, sf_dir):
    decoded = envelope.decode(fx.records(spark, sf_dir))
    return decoded.select("sequence_number", F.col("raw").isNotNull().alias("decoded"))


@query(f"WITH {RECORDS} SELECT {FACT_COLUMNS} FROM first_records")
def envelope_roundtrip(spark, sf_dir):
    checked = validate.check(fx.clean_records(spark, sf_dir))
    return enrich.flatten(enrich.enrich(validate.good(checked)).select("line")).select(*LOADED)


@query(
    f"""WITH {RECORDS}
SELECT sequence_number, error_type,
       CASE error_type WHEN 'missing_fields' THEN 'missing required fields: [''user_id'']' END AS missing
FROM first_records"""
)
def required_fields(spark, sf_dir):
    checked = validate.check(fx.records(spark, sf_dir))
    missing = F.when(F.col("error_type") == "missing_fields", F.col("error"))
    return checked.select("sequence_number", "error_type", missing.alias("missing"))


_FULL = f"""full_check AS (
  SELECT sequence_number, error_type AS required_type,
         concat_ws('; ',
           CASE WHEN k = 13 THEN 'missing required fields: [''user_id'']' END,
           CASE WHEN k = 43 THEN 'event_id must be a non-empty string' END,
           CASE WHEN event_type = 'view'
                THEN 'unknown event_type ''view''; expected one of {ALLOWED}' END,
           CASE WHEN k = 53 THEN 'timestamp ''soon'' does not match ISO 8601 format' END) AS found
  FROM first_records),
judged AS (
  SELECT sequence_number,
         CASE WHEN required_type IS NOT NULL THEN required_type WHEN found <> '' THEN 'invalid_fields' END AS error_type,
         CASE WHEN required_type IS NULL OR required_type = 'missing_fields' THEN nullif(found, '') END AS problems
  FROM full_check)"""


@query(f"WITH {RECORDS}, {_FULL} SELECT * FROM judged")
def validate_events(spark, sf_dir):
    checked = validate.check(fx.records(spark, sf_dir), "full")
    fields = F.col("error_type").isin("missing_fields", "invalid_fields")
    return checked.select("sequence_number", "error_type", F.when(fields, F.col("error")).alias("problems"))


@query(
    f"""WITH {RECORDS}, {_FULL}, outcomes AS (
  SELECT coalesce(error_type, 'valid') AS outcome, count(*) AS records FROM judged GROUP BY 1)
SELECT outcome, records,
       CAST((20000 * CAST(records AS HUGEINT) + sum(records) OVER ()) // (2 * sum(records) OVER ()) AS DOUBLE) / 100
         AS share_pct
FROM outcomes"""
)
def validation_summary(spark, sf_dir):
    return validate.summary(validate.check(fx.records(spark, sf_dir), "full"))


_LINE = PAYLOAD[:-3] + """},"_meta":{"kinesis_sequence":"' || sequence_number || '","processed_by":"lambda-transformer-v1"}}'"""


@query(f"WITH {RECORDS} SELECT sequence_number, {PAYLOAD} AS payload FROM first_records")
def encode_payload(spark, sf_dir):
    decoded = envelope.decode(fx.clean_records(spark, sf_dir))
    return decoded.select("sequence_number", F.col("raw").alias("payload"))


@query(f"WITH {RECORDS} SELECT sequence_number, {_LINE} AS line FROM first_records")
def enrich_short(spark, sf_dir):
    checked = validate.check(fx.clean_records(spark, sf_dir))
    return enrich.enrich(validate.good(checked)).select("sequence_number", "line")


@query(
    f"""WITH {RECORDS}
SELECT sequence_number, sequence_number AS kinesis_sequence, CAST(shard AS VARCHAR) AS kinesis_shard_id,
       strftime(arrival_ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS processed_at,
       'lambda-transformer-v1' AS processed_by, '1.0' AS schema_version
FROM first_records WHERE error_type IS NULL"""
)
def enrich_full(spark, sf_dir):
    lines = enrich.enrich(_good(spark, sf_dir), "full", processed_at=F.col("arrival_ts"))
    names = ("kinesis_sequence", "kinesis_shard_id", "processed_at", "processed_by", "schema_version")
    meta = F.from_json("line", "_meta struct<" + ", ".join(f"{n}: string" for n in names) + ">")["_meta"]
    return lines.select("sequence_number", meta.alias("m")).select("sequence_number", "m.*")


@query(
    f"""WITH {RECORDS}
SELECT CASE WHEN k <> 43 THEN event_id END AS event_id, event_type, CASE WHEN k <> 53 THEN event_ts END AS event_ts,
       user_id, session_id, page, duration_ms, value, producer_ver, aws_region,
       sequence_number AS kinesis_seq, processed_by
FROM all_records WHERE error_type IS NULL"""
)
def enrich_flatten(spark, sf_dir):
    lines = enrich.enrich(_good(spark, sf_dir, redelivered=True, resent=True))
    return enrich.flatten(lines.select("line")).select(*LOADED)


@query(
    f"""WITH {RECORDS}
SELECT CASE WHEN k <> 43 THEN event_id END AS event_id, event_type, CASE WHEN k <> 53 THEN event_ts END AS event_ts,
       user_id, page, duration_ms, value, kinesis_seq
FROM first_records WHERE error_type IS NULL"""
)
def flatten_exact_case(spark, sf_dir):
    lines = enrich.enrich(_good(spark, sf_dir))
    return enrich.flatten(lines.select("line"), ignore_case=False).select(
        "event_id", "event_type", "event_ts", "user_id", "page", "duration_ms", "value", "kinesis_seq"
    )


@query(f"WITH {RECORDS} SELECT {FACT_COLUMNS} FROM first_records")
def json_ignore_case(spark, sf_dir):
    """Names of every level written in capitals, values untouched."""
    lines = enrich.enrich(validate.good(validate.check(fx.clean_records(spark, sf_dir)))).select("line")
    names = (
        "event_id event_type timestamp user_id session_id properties page duration_ms value metadata "
        "producer_version region _meta kinesis_sequence processed_by"
    ).split()
    loud = F.col("line")
    for name in names:
        loud = F.replace(loud, F.lit(f'"{name}":'), F.lit(f'"{name.upper()}":'))
    return enrich.flatten(lines.select(loud.alias("line"))).select(*LOADED)


@query(
    """SELECT doc_id, length(s) AS n, md5(s) AS digest FROM (
  SELECT doc_id, left(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), 255) AS s FROM documents)"""
)
def sanitize(spark, sf_dir):
    """Whole texts between white space of several kinds."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    padded = F.concat(F.lit("\t  "), F.col("text"), F.lit(" \n "))
    clean = text.sanitize(padded)
    return documents.select("doc_id", F.length(clean).cast("long").alias("n"), F.md5(clean).alias("digest"))


@query(
    """SELECT doc_id, md5(left(text, 255)) AS page, md5(left(text, 36)) AS session_id FROM documents"""
)
def truncate_columns(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    cut = text.clip_columns(documents.select("doc_id", F.col("text").alias("page"), F.col("text").alias("session_id")))
    return cut.select("doc_id", F.md5("page").alias("page"), F.md5("session_id").alias("session_id"))


@query(
    """SELECT event_id, CASE event_type WHEN 'view' THEN ts WHEN 'click' THEN ts WHEN 'error' THEN ts
       WHEN 'purchase' THEN date_trunc('second', ts) END AS parsed FROM events"""
)
def timestamp_auto(spark, sf_dir):
    """One text form per event type: offset, zulu, space, slashes, and no time at all."""
    events = fx.source_events(spark, sf_dir)
    kind, ts = F.col("event_type"), F.col("ts")
    shown = (
        F.when(kind == "view", F.date_format(ts + F.expr("interval 2 hours"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+02:00'"))
        .when(kind == "click", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))
        .when(kind == "error", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        .when(kind == "purchase", F.date_format(ts, "yyyy/MM/dd HH:mm:ss"))
        .otherwise(F.lit("2024-13-45T99:99:99"))
    )
    return events.select("event_id", timing.parse_timestamp(shown).alias("parsed"))


@query(
    f"""WITH {RECORDS}
SELECT sequence_number FROM first_records
WHERE page = '/p2' AND (error_type IS NULL OR error_type = 'missing_fields')"""
)
def find_by_field(spark, sf_dir):
    decoded = envelope.decode(fx.records(spark, sf_dir))
    return envelope.find_by_field(decoded, "$.properties.page", "/p2").select("sequence_number")


@query(
    f"""WITH {RECORDS}
SELECT count(*) AS received, count(DISTINCT CASE WHEN error_type IS NULL THEN sequence_number END) AS processed,
       count(error_type) AS errors,
       count(*) - count(error_type) - count(DISTINCT CASE WHEN error_type IS NULL THEN sequence_number END) AS skipped
FROM all_records"""
)
def batch_counters(spark, sf_dir):
    return dedupe.batch_counters(validate.check(fx.records(spark, sf_dir, redelivered=True, resent=True)))


@query(
    f"""WITH {RECORDS}
SELECT sequence_number, min(arrival_ts) AS arrival_ts FROM all_records WHERE error_type IS NULL GROUP BY 1"""
)
def dedupe_sequence(spark, sf_dir):
    good = _good(spark, sf_dir, redelivered=True, resent=True)
    return dedupe.first_delivery(good).select("sequence_number", "arrival_ts")


_SEEN = "CAST(floor(epoch(min(arrival_ts))) AS BIGINT)"


@query(
    f"""WITH {RECORDS}, keys AS (
  SELECT sequence_number, {_SEEN} AS processed_at, {_SEEN} + 86400 AS ttl
  FROM all_records WHERE error_type IS NULL GROUP BY 1)
SELECT * FROM keys"""
)
def seen_keys(spark, sf_dir):
    good = _good(spark, sf_dir, redelivered=True, resent=True)
    return dedupe.seen_keys(good, F.col("arrival_ts"))


@query(
    f"""WITH {RECORDS}, keys AS (
  SELECT sequence_number, {_SEEN} + 86400 AS ttl FROM first_records WHERE error_type IS NULL GROUP BY 1)
SELECT sequence_number, min(arrival_ts) AS arrival_ts FROM all_records
WHERE error_type IS NULL AND sequence_number NOT IN (
  SELECT sequence_number FROM keys WHERE ttl > epoch(TIMESTAMP '2024-01-16 00:00:00')) GROUP BY 1"""
)
def seen_key_lookup(spark, sf_dir):
    """Keys of the first deliveries, half of them expired, against all deliveries."""
    keys = dedupe.seen_keys(_good(spark, sf_dir), F.col("arrival_ts"))
    again = _good(spark, sf_dir, redelivered=True, resent=True)
    return dedupe.drop_seen(again, keys, "2024-01-16 00:00:00").select("sequence_number", "arrival_ts")


@query(
    f"""WITH {RECORDS}, old AS (
  SELECT sequence_number, {_SEEN} AS processed_at FROM first_records WHERE error_type IS NULL GROUP BY 1),
new AS (
  SELECT sequence_number, {_SEEN} AS processed_at FROM all_records WHERE error_type IS NULL GROUP BY 1),
both_sets AS (
  SELECT * FROM old WHERE processed_at + 86400 > epoch(TIMESTAMP '2024-01-16 00:00:00')
  UNION ALL SELECT sequence_number, processed_at + 7 FROM new)
SELECT sequence_number, min(processed_at) AS processed_at, min(processed_at) + 86400 AS ttl
FROM both_sets GROUP BY 1"""
)
def remember_keys(spark, sf_dir):
    old = dedupe.seen_keys(_good(spark, sf_dir), F.col("arrival_ts"))
    later = F.col("arrival_ts") + F.expr("interval 7 seconds")
    new = dedupe.seen_keys(_good(spark, sf_dir, redelivered=True, resent=True), later)
    return dedupe.remember(old, new, "2024-01-16 00:00:00")


def without_numbers(records):
    """All records delivered twice over, those of the redelivered type without a sequence number."""
    kind = F.get_json_object(F.try_to_binary("data", F.lit("base64")).cast("string"), "$.event_type")
    number = F.when(F.coalesce(kind != fx.REDELIVERED_TYPE, F.lit(True)), F.col("sequence_number"))
    made = records.withColumn("sequence_number", number)
    return made.unionByName(made)


# Records of that type arrive at two times, so without a number they are two records.
TOLD_APART = f"""{RECORDS}, told AS (
  SELECT *, CASE WHEN event_type = 'error' THEN event_id || '@' || arrival_ts ELSE sequence_number END AS record
  FROM all_records)"""


@query(f"WITH {TOLD_APART} SELECT event_type, count(DISTINCT record) AS records FROM told WHERE error_type IS NULL GROUP BY 1")
def dedupe_null_sequence(spark, sf_dir):
    """Good records without a number are told apart by what they hold and where they stood."""
    made = without_numbers(fx.records(spark, sf_dir, redelivered=True, resent=True))
    first = dedupe.first_delivery(validate.good(validate.check(made)))
    return first.groupBy(F.get_json_object("raw", "$.event_type").alias("event_type")).agg(F.count(F.lit(1)).alias("records"))


@query(
    f"""WITH {TOLD_APART}
SELECT 2 * count(*) AS received, count(DISTINCT record) FILTER (error_type IS NULL) AS processed,
       2 * count(*) FILTER (error_type IS NULL) - count(DISTINCT record) FILTER (error_type IS NULL) AS skipped,
       2 * count(error_type) AS errors
FROM told"""
)
def records_conserved(spark, sf_dir):
    """Received records are processed, skipped or in error, with and without numbers."""
    made = without_numbers(fx.records(spark, sf_dir, redelivered=True, resent=True))
    return dedupe.batch_counters(validate.check(made))
