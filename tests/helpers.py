"""Small inputs and plan reading for the tests."""

import base64
import datetime as dt
import json

from tidemark.schema import FACT_COLUMNS, FACT_SCHEMA, RECORD_SCHEMA

START = dt.datetime(2024, 5, 27, 14, 0, 0)


def payload(event_id="evt-001", **fields):
    base = {
        "event_id": event_id,
        "event_type": "page_view",
        "timestamp": "2024-05-27T14:00:00Z",
        "user_id": "user_001",
        "session_id": "sess-001",
    }
    base.update(fields)
    return {k: v for k, v in base.items() if v is not ...}


def encoded(body):
    if isinstance(body, (dict, list)):
        body = json.dumps(body)
    if isinstance(body, str):
        body = body.encode()
    return base64.b64encode(body).decode()


def records(spark, bodies, already_encoded=False, start=START):
    """One record per (sequence, body)."""
    rows = [
        (seq, "user_001", body if already_encoded else encoded(body), start + dt.timedelta(seconds=i), "shard-0")
        for i, (seq, body) in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, RECORD_SCHEMA)


def facts(spark, rows):
    """Fact rows from dicts; missing columns are NULL or plain defaults."""
    filled = []
    for i, row in enumerate(rows):
        base = {
            "event_id": f"e{i}",
            "event_type": "page_view",
            "event_ts": START,
            "user_id": "u",
            "kinesis_seq": f"{i:04d}",
            "loaded_at": START,
        }
        base.update(row)
        filled.append(tuple(base.get(c) for c in FACT_COLUMNS))
    return spark.createDataFrame(filled, FACT_SCHEMA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
