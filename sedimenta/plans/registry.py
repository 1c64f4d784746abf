"""How query modules register their queries and SQL."""

from __future__ import annotations


def registry():
    """(queries, sql, decorator): the decorator registers a query under its function's name, with its SQL if it has one."""
    queries, statements = {}, {}

    def query(sql: str | None = None):
        def add(f):
            queries[f.__name__] = f
            if sql:
                statements[f.__name__] = sql
            return f

        return add

    return queries, statements, query
