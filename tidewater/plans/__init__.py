"""Registered queries over the driver tables and their DuckDB oracle SQL."""

from tidewater.plans.oracle import ORACLE_SQL
from tidewater.plans.queries import QUERIES, load

__all__ = ["QUERIES", "ORACLE_SQL", "load"]
