"""Registered queries, each beside the SQL that must give the same rows."""

from fitledger.catalog import layout, lines, models, runs, streams, text

_PARTS = (text, layout, runs, lines, streams, models)


def all_queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.SQL.items()}
