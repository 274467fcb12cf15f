"""Queries on the test tables, each with the SQL that checks it.

``QUERIES`` maps a name to ``(spark, folder) -> DataFrame``; ``ORACLES`` maps the
same name to a SQL text over the same tables, where SQL can say it.
"""

from gridcast.queries import calendar, grid, hourly, learned, longterm, scoring, storage  # noqa: F401
from gridcast.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
