"""The driver's tables in the shape of the pipeline's inputs.

Missing columns are derived from the row itself, in a way any SQL engine can
repeat. Whole tables go in; bad and repeated records are picked by content.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.enrich import short_meta
from tidemark.operators.envelope import as_records
from tidemark.plans.health import shard_of
from tidemark.schema import FACT_COLUMNS

AS_OF = "2024-01-31 00:00:00"
LOOK_BACK_DAYS = 30
LOOK_BACK_HOURS = 24 * LOOK_BACK_DAYS
FUNNEL_STEPS = ("view", "click", "purchase")
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")
SHARDS = 10

# Values of the `k` property whose records are made bad, and how.
K_NOT_JSON = 7
K_NO_USER = 13
K_ARRAY = 21
K_BAD_BASE64 = 29
K_BAD_BYTES = 37
K_NULL_ID = 43
K_BAD_TIME = 53
# This type's records are delivered twice, that type's sent again under a new number.
REDELIVERED_TYPE = "error"
RESENT_TYPE = "signup"

_EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def source_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """The events table and `k` of its properties, parsed once; `ts` is read as UTC so that time filters reach the files."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # A stream reads folders, so the table is named by a pattern.
    at = f"{sf_dir}/events.parque[t]" if stream else f"{sf_dir}/events.parquet"
    events = (spark.readStream if stream else spark.read).schema(_EVENTS).parquet(at)
    return events.withColumn("k", F.get_json_object("props", "$.k").cast("int"))


def _k():
    return F.col("k")


def _columns() -> dict:
    user = F.concat(F.lit("user_"), F.col("user_id").cast("string"))
    late_ms = (F.col("event_id") * 7919) % 90000
    return {
        "event_id": F.col("event_id").cast("string"),
        "event_type": F.col("event_type"),
        "event_ts": F.col("ts"),
        "user_id": user,
        "session_id": F.concat(F.lit("s-"), F.col("user_id").cast("string"), F.date_format("ts", "-yyyyMMddHH")),
        "page": F.nullif(F.concat(F.lit("/p"), (_k() % 5).cast("string")), F.lit("/p4")),
        "duration_ms": _k() * 30,
        "value": F.col("value").cast("decimal(12,2)"),
        "producer_ver": F.lit("1.0.0"),
        "aws_region": F.lit("us-east-1"),
        "kinesis_seq": F.lpad(F.col("event_id").cast("string"), 20, "0"),
        "processed_by": short_meta(F.lit(""))["processed_by"],
        "loaded_at": F.timestamp_micros(F.unix_micros("ts") + late_ms * 1000),
    }


def fact(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    """Events as fact rows."""
    columns = _columns()
    return source_events(spark, sf_dir, stream).select(*[columns[n].alias(n) for n in FACT_COLUMNS])


def _payload(columns, with_user: bool = True):
    fields = [
        columns["event_id"].alias("event_id"),
        columns["event_type"].alias("event_type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp"),
        *([columns["user_id"].alias("user_id")] if with_user else []),
        columns["session_id"].alias("session_id"),
        F.struct(*[columns[n].alias(n) for n in ("page", "duration_ms", "value")]).alias("properties"),
        F.struct(
            columns["producer_ver"].alias("producer_version"), columns["aws_region"].alias("region")
        ).alias("metadata"),
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as producers send them: `payload` JSON beside the source columns."""
    return source_events(spark, sf_dir).withColumn("payload", _payload(_columns()))


def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One good stream record per event."""
    return _records(payloads(spark, sf_dir), F.col("payload"))


def records(
    spark: SparkSession, sf_dir: str, redelivered: bool = False, resent: bool = False, stream: bool = False
) -> DataFrame:
    """Stream records with bad ones among them, optionally with repeats."""
    columns = _columns()
    k = _k()
    source = source_events(spark, sf_dir, stream)
    text = (
        F.when(k == K_NOT_JSON, F.lit("not-json"))
        .when(k == K_NO_USER, _payload(columns, with_user=False))
        .when(k == K_ARRAY, F.lit("[1]"))
        .when(k == K_NULL_ID, F.regexp_replace(_payload(columns), '"event_id":"[0-9]+"', '"event_id":null'))
        .when(k == K_BAD_TIME, F.regexp_replace(_payload(columns), '"timestamp":"[^"]+"', '"timestamp":"soon"'))
        .otherwise(_payload(columns))
    )
    first = _records(source, text, k)
    out = first
    if redelivered:
        again = _records(source.where(F.col("event_type") == REDELIVERED_TYPE), text, k, delay_seconds=61)
        out = out.unionByName(again)
    if resent:
        again = _records(source.where(F.col("event_type") == RESENT_TYPE), text, k, delay_seconds=120, prefix="r")
        out = out.unionByName(again)
    return out


def _records(source: DataFrame, text, k=None, delay_seconds: int = 1, prefix: str = "") -> DataFrame:
    columns = _columns()
    keyed = source.select(
        columns["user_id"].alias("key"),
        text.alias("value"),
        F.concat(F.lit(prefix), columns["kinesis_seq"]).alias("_sequence"),
        F.timestamp_micros(F.unix_micros("ts") + F.lit(delay_seconds * 1_000_000)).alias("_arrival"),
        shard_of(columns["user_id"], SHARDS).cast("string").alias("_shard"),
        (F.lit(None).cast("int") if k is None else k).alias("_k"),
    )
    bad = F.when(F.col("_k") == K_BAD_BASE64, F.lit("@@@")).when(F.col("_k") == K_BAD_BYTES, F.lit("/w=="))
    made = as_records(keyed, F.col("_sequence"), F.col("_arrival"), F.col("_shard"), extra=[bad.alias("_bad")])
    return made.withColumn("data", F.coalesce("_bad", "data")).drop("_bad")
