"""All queries of the library, by name, and their SQL."""

from varlake.plans import q_aggregates, q_builds, q_joins, q_rows, q_sources, q_status, q_tables, q_utr  # noqa: F401  they register themselves
from varlake.plans.registry import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
