"""Queries of this folder by name; importing `queries` fills them."""

QUERIES = {}
SQL = {}


def query(sql: str | None = None):
    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add
