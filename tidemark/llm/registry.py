"""Collects the queries of this subpackage."""

from __future__ import annotations

from functools import wraps

from tidemark.queries.registry import Tables
from tidemark.session import configure

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``, with its SQL where there is one."""

    def register(fn):
        @wraps(fn)
        def run(spark, folder):
            configure(spark)
            return fn(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return register
