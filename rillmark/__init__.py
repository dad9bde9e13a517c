"""Event analytics on Spark DataFrames: windows, ordered state, joins, patterns, late data."""

from rillmark.session import build_session, use_utc

__all__ = ["build_session", "use_utc"]
