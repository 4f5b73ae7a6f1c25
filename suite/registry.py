"""Registration of queries and their SQL."""

from __future__ import annotations

QUERIES = {}
ORACLES = {}


def query(name, sql=None):
    def add(function):
        assert name not in QUERIES, name
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return add
