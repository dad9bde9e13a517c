"""Readers: text, delimited records, CSV tables, literal rows, Kafka and socket streams."""
