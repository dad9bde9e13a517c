"""The operators applied to the given tables, each with the SQL that must agree."""

from rillmark.plans import records, stateful, streamed, windowed  # noqa: F401
from rillmark.plans.catalog import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
