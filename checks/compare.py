"""Run registered queries on Spark and their SQL on DuckDB and compare the rows.

    python -m checks.compare [sf_dir] [name ...]
"""

import datetime as dt
import decimal
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value.normalize())
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns, rows):
    """Rows with columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows) if rows and all(
        all(v is not None for v in r) for r in rows
    ) else sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def connect(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def difference(spark, connection, name, function, sql, sf_dir):
    """None when both sides agree, else a short text. Also returns the row count."""
    frame = function(spark, sf_dir)
    ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sql is None:
        return None, len(ours)
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} against {sorted(names)}", len(ours)
    if ours != theirs:
        mine = [r for r in ours if r not in set(theirs)][:2] if len(ours) < 50_000 else ours[:2]
        other = [r for r in theirs if r not in set(ours)][:2] if len(ours) < 50_000 else theirs[:2]
        return f"{len(ours)} rows against {len(theirs)}: {mine} against {other}", len(ours)
    return None, len(ours)


def main():
    from checks import all_checks
    from tidemark.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    chosen = sys.argv[2:]
    spark = build_session(
        "local[8]",
        shuffle_partitions=8,
        **{"spark.ui.enabled": "false", "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name, function in all_checks.QUERIES.items():
        if chosen and name not in chosen:
            continue
        started = time.time()
        try:
            problem, rows = difference(spark, connection, name, function, all_checks.SQL.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            problem, rows = f"{type(error).__name__}: {str(error)[:1500]}", 0
        bad += problem is not None
        kind = "sql" if name in all_checks.SQL else "rows only"
        print(f"{'ok ' if problem is None else 'BAD'} {name} rows={rows} {time.time() - started:.1f}s {kind} {problem or ''}", flush=True)
    print(f"{bad} differ")
    spark.stop()


if __name__ == "__main__":
    main()
