"""Processing metadata, and the flat form the fact table holds."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import json_text, text, timing
from tidemark.schema import COLUMN_WIDTHS, FACT_COLUMNS, FACT_NOT_NULL, KEY_COLUMNS, META_VERSION, PROCESSOR


def short_meta(sequence, processor: str = PROCESSOR) -> Column:
    return F.struct(
        sequence.alias("kinesis_sequence"),
        F.lit(processor).alias("processed_by"),
    )


def full_meta(sequence, shard, processed_at=None, processor: str = PROCESSOR) -> Column:
    at = F.current_timestamp() if processed_at is None else processed_at
    return F.struct(
        sequence.alias("kinesis_sequence"),
        F.coalesce(shard, F.lit("")).alias("kinesis_shard_id"),
        timing.iso_text(at).alias("processed_at"),
        F.lit(processor).alias("processed_by"),
        F.lit(META_VERSION).alias("schema_version"),
    )


def enrich(good: DataFrame, form: str = "short", processed_at=None, processor: str = PROCESSOR) -> DataFrame:
    """Add `line`: the payload text with `_meta` added, everything else untouched."""
    if form == "short":
        meta = short_meta(F.col("sequence_number"), processor)
    elif form == "full":
        meta = full_meta(F.col("sequence_number"), F.col("shard_id"), processed_at, processor)
    else:
        raise ValueError(f"form must be 'short' or 'full', not {form!r}")
    return good.withColumn("line", json_text.add_member(F.col("raw"), "_meta", meta))


_LINE_SCHEMA = (
    "event_id string, event_type string, timestamp string, user_id string, session_id string, "
    "properties struct<page: string, duration_ms: string, value: string>, "
    "metadata struct<producer_version: string, region: string>, "
    "_meta struct<kinesis_sequence: string, processed_by: string>"
)

# Fact column → where its value stands in a line: level and member name.
_PLACES = {
    "event_id": ("top", "event_id"),
    "event_type": ("top", "event_type"),
    "event_ts": ("top", "timestamp"),
    "user_id": ("top", "user_id"),
    "session_id": ("top", "session_id"),
    "page": ("properties", "page"),
    "duration_ms": ("properties", "duration_ms"),
    "value": ("properties", "value"),
    "producer_ver": ("metadata", "producer_version"),
    "aws_region": ("metadata", "region"),
    "kinesis_seq": ("_meta", "kinesis_sequence"),
    "processed_by": ("_meta", "processed_by"),
}
_INNER = ("properties", "metadata", "_meta")


def flatten(
    lines: DataFrame,
    line: str = "line",
    loaded_at=None,
    ignore_case: bool = True,
    widths: dict[str, int] = COLUMN_WIDTHS,
    problem: str | None = None,
) -> DataFrame:
    """JSON lines to the fact columns; other columns of the frame are kept.

    With `ignore_case` a member name also matches in any other case, where its
    own spelling is absent or null; the last such member counts. Only lines
    that lack a value are parsed again for that, into maps of names and text,
    so complete lines cost one typed parse.

    Text is cut to `widths`, but never a key: rows are matched and counted on
    whole keys. `problem` names a column that says why a line must not be
    loaded: a required value that is absent, one that is there but has no
    usable form, or a key longer than its width. NULL means none.
    """
    kept = [c for c in lines.columns if c not in FACT_COLUMNS]
    cut = {c: w for c, w in widths.items() if c not in KEY_COLUMNS}
    parsed = lines.withColumn("_p", F.from_json(line, _LINE_SCHEMA, {"allowSingleQuotes": "false"}))
    texts = {
        column: F.col(f"_p.{name}" if level == "top" else f"_p.{level}.{name}")
        for column, (level, name) in _PLACES.items()
    }
    if ignore_case:
        parsed = _with_any_case(parsed, line, texts)
        texts = {
            column: F.coalesce(texts[column], json_text.member_value(*_arrays(level), name))
            for column, (level, name) in _PLACES.items()
        }
    at = F.current_timestamp() if loaded_at is None else loaded_at
    fields = _typed(texts, at)
    shown = {name: text.clip(fields[name], cut[name]) if name in cut else fields[name] for name in FACT_COLUMNS}
    found = [] if problem is None else [_problem(texts, fields, widths).alias(problem)]
    return parsed.select(*kept, *[value.alias(name) for name, value in shown.items()], *found)


def _arrays(level: str):
    return F.col(f"_{level}_names"), F.col(f"_{level}_values")


def _with_any_case(parsed: DataFrame, line: str, texts: dict) -> DataFrame:
    """Add the lower-case names and the values of every level for incomplete lines."""
    lacking = reduce(lambda a, b: a | b, [value.isNull() for value in texts.values()])
    top = parsed.withColumn("_level_top", F.when(lacking, json_text.members(F.col(line))))
    top = _by_lower_name(top, ["top"])
    inner = {f"_level_{n}": json_text.members(json_text.member_value(*_arrays("top"), n)) for n in _INNER}
    return _by_lower_name(top.withColumns(inner), _INNER)


def _by_lower_name(df: DataFrame, levels) -> DataFrame:
    found = {}
    for level in levels:
        found[f"_{level}_names"] = json_text.lower_names(F.col(f"_level_{level}"))
        found[f"_{level}_values"] = json_text.values_backwards(F.col(f"_level_{level}"))
    return df.withColumns(found)


def _typed(texts: dict, loaded_at) -> dict[str, Column]:
    fields = dict(texts, loaded_at=loaded_at)
    fields["event_ts"] = timing.parse_timestamp(texts["event_ts"])
    fields["duration_ms"] = texts["duration_ms"].try_cast("int")
    fields["value"] = texts["value"].try_cast("decimal(12,2)")
    return fields


def _problem(texts: dict, fields: dict, widths: dict) -> Column:
    lacking = [F.when(fields[c].isNull(), F.lit(c)) for c in FACT_NOT_NULL]
    spoilt = [F.when(texts[c].isNotNull() & fields[c].isNull(), F.lit(c)) for c in ("duration_ms", "value")]
    unusable = F.concat_ws(", ", *lacking, *spoilt)
    too_long = F.concat_ws(", ", *[F.when(F.length(fields[c]) > widths[c], F.lit(c)) for c in KEY_COLUMNS if c in widths])
    said = F.concat_ws(
        "; ",
        F.when(unusable != "", F.concat(F.lit("no usable value for: "), unusable)),
        F.when(too_long != "", F.concat(F.lit("too long: "), too_long)),
    )
    return F.nullif(said, F.lit(""))
