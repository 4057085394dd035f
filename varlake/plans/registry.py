"""Where queries register themselves."""

from __future__ import annotations

from varlake.plans.views import oracle

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
#: The key of a variant x transcript row.
KEY = ["row_key"]


def query(name: str, sql: str | None = None):
    """Registers a query (spark, sf_dir) and its DuckDB SQL, in which names in braces are views."""
    def add(f):
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = oracle(sql)
        return f

    return add
