"""Structured Streaming: event time, stateful processors, late data, progress."""
