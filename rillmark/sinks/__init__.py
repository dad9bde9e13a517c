"""Writers: console, text and CSV files, Kafka, JDBC, buffered and idempotent sinks."""
