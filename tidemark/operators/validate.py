"""Record checks as columns: a bad record becomes an error value, not a failure."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import json_text, measures
from tidemark.operators.envelope import decode
from tidemark.schema import (
    BAD_ENCODING,
    BAD_JSON,
    INVALID_FIELDS,
    MISSING_FIELDS,
    NOT_OBJECT,
    REJECT_KINDS,
    REQUIRED_FIELDS,
    TIMESTAMP_PATTERN,
    VALID,
    VALID_EVENT_TYPES,
)


def _quoted_list(names) -> Column:
    """['a', 'b'] from an array of names."""
    return F.concat(F.lit("['"), F.array_join(names, "', '"), F.lit("']"))


def missing_fields(probed_object) -> Column:
    """Names of required fields whose key is absent; a null value is present."""
    names = [F.when(probed_object[n].isNull(), F.lit(n)) for n in sorted(REQUIRED_FIELDS)]
    return F.array_compact(F.array(*names))


def _missing_message(probed_object) -> Column:
    missing = missing_fields(probed_object)
    return F.when(F.size(missing) > 0, F.concat(F.lit("missing required fields: "), _quoted_list(missing)))


def _is_text(value) -> Column:
    return json_text.variant_type(value) == "STRING"


def _shown(value) -> Column:
    """A field value inside a message; null reads None, as in the messages' format."""
    kind = json_text.variant_type(value)
    text = json_text.variant_text(value)
    return (
        F.when(kind == "VOID", F.lit("None"))
        .when(kind == "BOOLEAN", F.initcap(text))
        .otherwise(text)
    )


def _text_problem(value, name: str) -> Column:
    good = _is_text(value) & (F.length(json_text.variant_text(value)) > 0)
    return F.when(value.isNotNull() & ~F.coalesce(good, F.lit(False)),
                  F.lit(f"{name} must be a non-empty string"))


def _type_problem(value, event_types) -> Column:
    known = _is_text(value) & json_text.variant_text(value).isin(*event_types)
    allowed = "['" + "', '".join(sorted(event_types)) + "']"
    message = F.concat(F.lit("unknown event_type '"), _shown(value), F.lit(f"'; expected one of {allowed}"))
    return F.when(value.isNotNull() & ~F.coalesce(known, F.lit(False)), message)


def _time_problem(value) -> Column:
    good = _is_text(value) & json_text.variant_text(value).rlike(TIMESTAMP_PATTERN)
    message = F.concat(F.lit("timestamp '"), _shown(value), F.lit("' does not match ISO 8601 format"))
    return F.when(value.isNotNull() & ~F.coalesce(good, F.lit(False)), message)


def problems(probed_object, event_types=VALID_EVENT_TYPES) -> Column:
    """Every problem of a payload joined with '; '; empty text when valid."""
    return F.concat_ws(
        "; ",
        _missing_message(probed_object),
        _text_problem(probed_object["event_id"], "event_id"),
        _type_problem(probed_object["event_type"], event_types),
        _time_problem(probed_object["timestamp"]),
        _text_problem(probed_object["user_id"], "user_id"),
    )


def check(
    records: DataFrame, strictness: str = "required", event_types=VALID_EVENT_TYPES, with_event_id: bool = False
) -> DataFrame:
    """Decode records and add `raw`, `error_type` and `error` (NULL when good).

    `with_event_id` adds `checked_event_id`, the text of the payload's event id as the checks have parsed it.

    `data` stays only where it could not be decoded; elsewhere `raw` says the
    same, and later shuffles need not carry both.

    `required` asks only that the required keys are there; `full` applies every
    field check and reports all problems at once.
    """
    if strictness not in ("required", "full"):
        raise ValueError(f"strictness must be 'required' or 'full', not {strictness!r}")
    probed = decode(records).withColumn("_probe", json_text.probe(F.col("raw")))
    first = F.get("_probe", F.lit(0))
    if strictness == "full":
        found = F.nullif(problems(first, event_types), F.lit(""))
        other = INVALID_FIELDS
    else:
        found = _missing_message(first)
        other = MISSING_FIELDS
    judged = probed.withColumn(
        "_verdict",
        F.when(F.col("raw").isNull(), _verdict(BAD_ENCODING, F.lit("data is not base64 of UTF-8 text")))
        .when(
            ~json_text.probe_is_object(F.col("_probe"), F.col("raw")),
            F.when(
                ~json_text.starts_object(F.col("raw")) & json_text.is_json_value(F.col("raw")),
                _verdict(NOT_OBJECT, F.lit("payload is JSON but not an object")),
            ).otherwise(_verdict(BAD_JSON, F.lit("payload is not JSON"))),
        )
        .otherwise(
            F.when(
                found.isNotNull(),
                F.struct(
                    F.when(found.startswith("missing required fields"), F.lit(MISSING_FIELDS))
                    .otherwise(F.lit(other))
                    .alias("error_type"),
                    found.alias("error"),
                ),
            )
        ),
    )
    # A filter on the verdict would be pushed below the projection and repeat
    # the parse there; one row generated per record keeps it where it is.
    event_id = [json_text.variant_text(first["event_id"]).alias("checked_event_id")] if with_event_id else []
    outcome = F.struct(
        F.when(F.col("raw").isNull(), F.col("data")).alias("data"), "raw", "_verdict.error_type", "_verdict.error", *event_id
    )
    kept = [c for c in records.columns if c != "data"]
    return judged.select(*kept, F.inline(F.array(outcome)))


def _verdict(kind: str, message: Column) -> Column:
    return F.struct(F.lit(kind).alias("error_type"), message.alias("error"))


def good(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error_type").isNull()).drop("error_type", "error")


def bad(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error_type").isNotNull())


def summary(checked: DataFrame) -> DataFrame:
    """Records per outcome with their share of all records, from one aggregate."""
    outcome = F.coalesce("error_type", F.lit(VALID))
    kinds = (VALID, *REJECT_KINDS)
    counts = checked.agg(
        F.count(F.lit(1)).alias("_all"), *[F.count_if(outcome == kind).alias(kind) for kind in kinds]
    )
    listed = F.array(*[F.struct(F.lit(k).alias("outcome"), F.col(k).alias("records")) for k in kinds])
    return (
        counts.select("_all", F.inline(listed))
        .where("records > 0")
        .select("outcome", "records", measures.percent(F.col("records"), F.col("_all")).alias("share_pct"))
    )
