"""Decode, check, enrich and flatten, on edge rows."""

import json
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import encoded, payload, plan, records, rows
from tidemark.functions import text, timing
from tidemark.operators import enrich, envelope, validate
from tidemark.schema import TIMESTAMP_PATTERN, VALID_EVENT_TYPES


def verdicts(spark, bodies, strictness="required", already_encoded=False):
    checked = validate.check(records(spark, list(enumerate_seq(bodies)), already_encoded), strictness)
    return {r["sequence_number"]: (r["error_type"], r["error"]) for r in checked.collect()}


def enumerate_seq(bodies):
    return ((str(i), b) for i, b in enumerate(bodies))


def test_decodes_a_record(spark):
    decoded = envelope.with_payload(envelope.decode(records(spark, [("seq-001", payload())])))
    assert decoded.first()["payload"]["event_id"] == "evt-001"


@pytest.mark.parametrize("data", ["@@@", "a", "/w=="])
def test_undecodable_data_is_an_error_value(spark, data):
    assert verdicts(spark, [data], already_encoded=True)["0"][0] == "bad_encoding"


def test_data_without_padding_is_rejected(spark):
    assert verdicts(spark, ["abc"], already_encoded=True)["0"][0] is not None


def test_required_check(spark):
    found = verdicts(
        spark,
        [
            payload(),
            "not-json",
            {"event_id": "x"},
            [1],
            payload(event_id=None),
            payload(event_id=7, event_type="zzz", timestamp="nope", user_id=""),
            payload(timestamp="2024-13-45T99:99:99"),
            json.dumps(payload())[:-1] + ',"event_id":"evt-002"}',
            payload(_test_tag="t"),
            "",
            "null",
            "{}",
        ],
    )
    kinds = [found[str(i)][0] for i in range(len(found))]
    assert kinds == [
        None, "bad_json", "missing_fields", "not_object", None, None, None, None, None,
        "bad_json", "not_object", "missing_fields",
    ]
    assert found["2"][1] == "missing required fields: ['event_type', 'timestamp', 'user_id']"
    assert found["11"][1] == "missing required fields: ['event_id', 'event_type', 'timestamp', 'user_id']"


JSON_TEXTS = [
    '{"event_id":"a"} x',
    '{"event_id":"a"}{"event_id":"b"}',
    '{"event_id":"a"}}',
    '{"event_id":"a"',
    "{'event_id':'a'}",
    '{"event_id":"a"},"y":{"b":1}',
    '{"event_id":"a"},{"event_id":"b"}',
    '{"event_id":"a"}],[1',
    '{"event_id":"a"},{"__end":true}]garbage',
    '{"event_id":"a"},{"__end":true}],[{"x":1}',
    '{"event_id":"a"},{"__end":"end"}]garbage',
    '{"event_id":"a"},{"\\u005f_end":"end"}],[{"x":1}',
    '{"event_id":"a","__end":true}',
    '{"event_id":01}',
    '{"event_id":"a\nb"}',
    ' {"event_id":"a"} \n',
    '{"event_id":"a","properties":{"value":NaN}}',
    '{"event_id":"a","properties":{"a":1,"a":2}}',
    '{"event_id":"a","event_id":"b"}',
    "5",
    '"text"',
    "[1,2",
    '{"a":{"b":[1,{"c":null}]}}',
]


def test_json_is_judged_as_a_json_parser_does(spark):
    found = verdicts(spark, JSON_TEXTS)
    for i, body in enumerate(JSON_TEXTS):
        try:
            value = json.loads(body)
            expected = "missing_fields" if isinstance(value, dict) else "not_object"
        except json.JSONDecodeError:
            expected = "bad_json"
        assert found[str(i)][0] == expected, body


def test_full_check_collects_every_problem(spark):
    found = verdicts(
        spark,
        [
            payload(),
            payload(event_id=7, event_type="zzz", timestamp="nope", user_id=""),
            payload(event_id=None),
            payload(event_id="", user_id=...),
            payload(timestamp="2024-05-27 14:00:00"),
            payload(timestamp=None),
            payload(event_type=True),
        ],
        "full",
    )
    allowed = sorted(VALID_EVENT_TYPES)
    assert found["0"] == (None, None)
    assert found["1"] == (
        "invalid_fields",
        "event_id must be a non-empty string; "
        f"unknown event_type 'zzz'; expected one of {allowed}; "
        "timestamp 'nope' does not match ISO 8601 format; "
        "user_id must be a non-empty string",
    )
    assert found["2"][1] == "event_id must be a non-empty string"
    assert found["3"] == (
        "missing_fields", "missing required fields: ['user_id']; event_id must be a non-empty string"
    )
    assert found["4"] == (None, None)
    assert found["5"][1] == "timestamp 'None' does not match ISO 8601 format"
    assert found["6"][1].startswith("unknown event_type 'True'")


def model_verdict(body, strictness):
    """The two checks once more, in plain Python."""
    try:
        value = json.loads(body)
    except json.JSONDecodeError:
        return "bad_json", None
    if not isinstance(value, dict):
        return "not_object", None
    required = ("event_id", "event_type", "timestamp", "user_id")
    missing = sorted(n for n in required if n not in value)
    found = [f"missing required fields: {missing}"] if missing else []
    if strictness == "full":
        def text(name):
            return isinstance(value[name], str) and value[name] != ""

        if "event_id" in value and not text("event_id"):
            found.append("event_id must be a non-empty string")
        if "event_type" in value and value["event_type"] not in VALID_EVENT_TYPES:
            found.append(f"unknown event_type '{value['event_type']}'; expected one of {sorted(VALID_EVENT_TYPES)}")
        if "timestamp" in value:
            shown = value["timestamp"]
            if not isinstance(shown, str) or not re.match(TIMESTAMP_PATTERN, shown):
                found.append(f"timestamp '{shown}' does not match ISO 8601 format")
        if "user_id" in value and not text("user_id"):
            found.append("user_id must be a non-empty string")
    if not found:
        return None, None
    return ("missing_fields" if missing else "invalid_fields"), "; ".join(found)


@pytest.mark.parametrize("strictness", ["required", "full"])
def test_random_payloads_against_a_plain_model(spark, strictness):
    draw = random.Random(29)
    odd = [None, 0, 7, -3, True, False, "", " ", "x", "click", "2024-05-27T14:00:00Z", "2024-05-27 14:00", "é \"\\"]
    bodies = []
    for _ in range(400):
        made = payload(f"e{draw.randrange(9)}", properties={"page": draw.choice([None, "/a", 5]), "value": 1.5})
        for name in ("event_id", "event_type", "timestamp", "user_id", "session_id"):
            if draw.random() < 0.25:
                made[name] = draw.choice(odd)
            elif draw.random() < 0.1:
                made.pop(name, None)
        text_of = json.dumps(made, ensure_ascii=draw.random() < 0.5, indent=draw.choice([None, 1]))
        if draw.random() < 0.25:
            cut = draw.randrange(len(text_of))
            text_of = draw.choice([text_of[:cut], text_of[:cut] + draw.choice('{}[],:"') + text_of[cut:], text_of + "}"])
        bodies.append(text_of)
    found = verdicts(spark, bodies, strictness)
    for i, body in enumerate(bodies):
        kind, message = model_verdict(body, strictness)
        assert found[str(i)][0] == kind, body
        if message:
            assert found[str(i)][1] == message


def test_strictness_is_checked(spark):
    with pytest.raises(ValueError):
        validate.check(records(spark, [("1", payload())]), "some")


def test_each_record_is_parsed_once(spark):
    """A filter on the verdict stays above the parse instead of repeating it."""
    good = validate.good(validate.check(records(spark, [("1", payload())])))
    assert plan(enrich.enrich(good).select("line")).count("from_json") == 1


def test_enrich_keeps_the_payload(spark):
    body = payload(_test_tag="t", properties={"page": "/home", "n": 1.50})
    line = enrich.enrich(validate.good(validate.check(records(spark, [("seq-001", body)])))).first()["line"]
    enriched = json.loads(line)
    assert enriched.pop("_meta") == {"kinesis_sequence": "seq-001", "processed_by": "lambda-transformer-v1"}
    assert enriched == body


def test_enrich_replaces_an_older_meta_and_joins_lines(spark):
    body = json.dumps(payload(_meta={"kinesis_sequence": "old"}), indent=2) + "\r\n"
    line = enrich.enrich(validate.good(validate.check(records(spark, [("new", body)])))).first()["line"]
    assert "\n" not in line and "\r" not in line
    assert json.loads(line)["_meta"]["kinesis_sequence"] == "new"


def test_full_meta(spark, utc):
    good = validate.good(validate.check(records(spark, [("s", payload())])))
    good = good.withColumn("shard_id", F.lit(None).cast("string"))
    line = enrich.enrich(good, "full", processed_at=F.lit(utc("2024-05-27T14:00:01"))).first()["line"]
    assert json.loads(line)["_meta"] == {
        "kinesis_sequence": "s",
        "kinesis_shard_id": "",
        "processed_at": "2024-05-27T14:00:01.000000+00:00",
        "processed_by": "lambda-transformer-v1",
        "schema_version": "1.0",
    }


def test_flatten(spark):
    line = json.dumps(
        {
            "Event_ID": "x" * 50,
            "EVENT_TYPE": "purchase",
            "Timestamp": "2024-05-27T16:00:00+02:00",
            "user_id": 7,
            "Properties": {"PAGE": "/cart", "duration_ms": "300", "Value": 12.345},
            "METADATA": {"Producer_Version": "1.0.0", "region": "eu"},
            "_META": {"kinesis_sequence": "9", "processed_by": "p"},
        }
    )
    more = ['{"EVENT_ID":"a","Event_Id":"b"}', '{"event_id":"a","EVENT_ID":"b"}', '{"event_id":null,"EVENT_ID":"b"}']
    lines = spark.createDataFrame([(x,) for x in [line, *more]], "line string")
    first, second, *others = enrich.flatten(lines).collect()
    assert first["event_id"] == "x" * 50  # a key is never cut
    assert str(first["event_ts"]) == "2024-05-27 14:00:00"
    assert (first["user_id"], first["page"], first["duration_ms"]) == ("7", "/cart", 300)
    assert first["value"] == Decimal("12.35")
    assert (first["producer_ver"], first["aws_region"], first["kinesis_seq"]) == ("1.0.0", "eu", "9")
    assert second["event_id"] == "b" and second["event_ts"] is None
    # A name in its own spelling comes before other spellings, unless it is null.
    assert [r["event_id"] for r in others] == ["a", "b"]


def test_flatten_bad_values_become_null(spark):
    body = '{"event_id":"a","timestamp":"2024-13-45T99:99:99","properties":{"duration_ms":"abc","value":[1]}}'
    lines = spark.createDataFrame([(body,)], "line string")
    for ignore_case in (True, False):
        row = enrich.flatten(lines, ignore_case=ignore_case).first()
        assert (row["event_id"], row["event_ts"], row["duration_ms"], row["value"]) == ("a", None, None, None)


def test_sanitize(spark):
    values = ["\t /home \n", "x" * 300, "\xa0  a b \u2003", "\x1c\x1fa\x0b", "", "\u200ba\u200b"]
    # Every character that Python strips, at both ends and inside.
    values += [f"{c}a{c}b{c}" for c in map(chr, range(1, 0x3100)) if c.isspace()]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(text.sanitize(F.col("v"))).collect()]
    assert got == [v.strip()[:255] for v in values]


@pytest.mark.parametrize(
    "shown",
    ["2024-05-27T14:00:00Z", "2024-05-27T16:00:00+02:00", "2024-05-27 14:00:00", "2024/05/27 14:00:00",
     "05/27/2024 14:00:00", "2024-05-27T14:00:00.000000", "27-May-2024 14:00:00"],
)
def test_timestamp_forms(spark, shown):
    df = spark.createDataFrame([(shown,)], "s string")
    assert str(df.select(timing.parse_timestamp(F.col("s"))).first()[0]) == "2024-05-27 14:00:00"


def test_find_by_field(spark):
    made = records(spark, [("1", payload(_test_tag="here")), ("2", payload())])
    found = envelope.find_by_field(envelope.decode(made), "$._test_tag", "here")
    assert rows(found, "sequence_number") == [("1",)]


def test_keyed_messages_keep_null_fields(spark):
    df = spark.createDataFrame([("u1", None)], "user_id string, page string")
    row = envelope.keyed_messages(df).first()
    assert (row["key"], json.loads(row["value"])) == ("u1", {"user_id": "u1", "page": None})


def test_records_hold_base64_on_one_line(spark):
    df = spark.createDataFrame([("u", "x" * 500)], "key string, value string")
    made = envelope.as_records(df, F.lit("1"), F.current_timestamp())
    assert made.first()["data"] == encoded("x" * 500)
