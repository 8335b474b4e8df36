"""Collects the queries and their SQL."""

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) → DataFrame under its own name."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add
