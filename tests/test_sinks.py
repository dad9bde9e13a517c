"""Sinks and connectors that need no running service."""

from pyspark.sql import functions as F

from rillmark.operators.project import map_with_lifecycle
from rillmark.session import shared_folder
from rillmark.sinks import writers
from rillmark.sources.readers import kafka_options, kafka_values, text_lines


def test_buffered_sink_flushes_full_groups_and_the_rest(spark):
    folder = shared_folder(spark, "flushed")

    for batch in (0, 0, 1):
        flushed = writers.write_buffered(spark.range(0, 25, numPartitions=1), writers.flush_files(folder), 10, batch)
        assert sorted(r["rows"] for r in flushed.collect()) == [5, 10, 10]
    # the replayed batch has replaced itself
    assert sorted(r["id"] for r in spark.read.parquet(folder).collect()) == sorted([*range(25), *range(25)])


def test_lifecycle_opens_and_closes_once_per_task(spark):
    folder = shared_folder(spark, "lifecycle")

    def mark(kind: str, task: int) -> str:
        import os
        import uuid

        os.makedirs(folder, exist_ok=True)
        open(f"{folder}/{kind}-{task}-{uuid.uuid4().hex}", "w").close()
        return kind

    doubled = map_with_lifecycle(
        spark.range(0, 100, numPartitions=2), "id bigint", lambda r, task, b: b * 2,
        open_task=lambda task: mark("open", task), close_task=lambda r, task: mark("close", task),
    )
    assert sorted(r["id"] for r in doubled.collect()) == [i * 2 for i in range(100)]
    import os

    names = sorted(n.rsplit("-", 1)[0] for n in os.listdir(folder))
    assert names == ["close-0", "close-1", "open-0", "open-1"]


def test_kafka_rows_keep_their_text(spark):
    df = spark.createDataFrame([("k", "a,b,1")], "key string, line string")
    records = writers.kafka_records(df, "line", "key")
    assert records.columns == ["key", "value"]
    wire = records.select(F.col("value").cast("binary").alias("value"))
    assert [r["value"] for r in kafka_values(wire).collect()] == ["a,b,1"]
    assert kafka_options("h:9092", "clicks")["subscribe"] == "clicks"


def test_csv_columns_are_written_by_name(spark):
    path = shared_folder(spark, "csv")
    writers.to_csv_table(spark.createDataFrame([("u", "v")], "b string, a string"), path, ["a", "b"])
    assert [tuple(r) for r in spark.read.schema("a string, b string").csv(path).collect()] == [("v", "u")]


def test_text_round_trip(spark):
    path = shared_folder(spark, "text")
    writers.to_text_files(spark.createDataFrame([("a b",), ("",)], "value string"), path)
    assert sorted(r["value"] for r in text_lines(spark, path).collect()) == ["", "a b"]


def test_jdbc_writer_picks_columns(spark):
    df = spark.createDataFrame([("u", "v", 1)], "user string, url string, ms bigint")
    writer = writers.to_jdbc(df, "jdbc:none", "clicks", ["user", "url"])
    assert writer._df.columns == ["user", "url"]


def test_console_rows_are_mapped_by_name(spark, capsys):
    writers.to_console(spark.createDataFrame([("u", 1, "x")], "b string, a int, c string"), "out", columns=["a", "b"])
    shown = [line.replace(" ", "") for line in capsys.readouterr().out.splitlines()]
    assert "|label|a|b|" in shown and "|out|1|u|" in shown
