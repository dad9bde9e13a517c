"""Batch and streaming readers. Schemas are always declared, never inferred."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.columns import Names, names
from rillmark.functions.text import parse_long, split_text
from rillmark.functions.time import event_time

CLICK = T.StructType(
    [
        T.StructField("username", T.StringType()),
        T.StructField("url", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)


def text_lines(spark: SparkSession, path: str, *, stream: bool = False, **options: str) -> DataFrame:
    """One row per line, as ``value``."""
    reader = spark.readStream if stream else spark.read
    return reader.options(**options).text(path)


def literal_rows(spark: SparkSession, rows: list[tuple[Any, ...]], schema: str | T.StructType) -> DataFrame:
    """Rows given in the program."""
    return spark.createDataFrame(rows, schema)


def kafka_options(servers: str, topic: str, **more: str) -> dict[str, str]:
    """Options of a Kafka source; keep ``maxOffsetsPerTrigger`` set so batches stay bounded."""
    return {"kafka.bootstrap.servers": servers, "subscribe": topic, "maxOffsetsPerTrigger": "50000000"} | more


def kafka_values(records: DataFrame) -> DataFrame:
    """The text of Kafka records, as ``value``."""
    return records.select(F.col("value").cast("string").alias("value"))


def kafka_lines(spark: SparkSession, servers: str, topic: str, **more: str) -> DataFrame:
    """A topic as a stream of text lines."""
    return kafka_values(spark.readStream.format("kafka").options(**kafka_options(servers, topic, **more)).load())


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines from a socket. For trials only: a lost executor loses them for good."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def parse_records(
    lines: DataFrame,
    schema: T.StructType = CLICK,
    *,
    separator: str = ",",
    value: str = "value",
) -> DataFrame:
    """Split delimited lines into the declared fields; text is trimmed.

    ``reject`` holds the line where the number of fields is wrong or a number is unreadable,
    and is null for good records.
    """
    parts = split_text(value, separator)

    def field(i: int, f: T.StructField) -> F.Column:
        raw = F.get(F.col("_parts"), F.lit(i))
        return (parse_long(raw) if isinstance(f.dataType, T.LongType) else F.trim(raw).cast(f.dataType)).alias(f.name)

    fields = [field(i, f) for i, f in enumerate(schema)]
    numbers = [f.name for f in schema if isinstance(f.dataType, T.LongType)]
    split = lines.select(F.col(value).alias("_line"), parts.alias("_parts")).select("_line", "_parts", *fields)
    bad = F.size("_parts") != len(schema)
    for name in numbers:
        bad = bad | F.col(name).isNull()
    return split.withColumn("reject", F.when(bad, F.col("_line"))).drop("_line", "_parts")


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject").isNull()).drop("reject")


def rejected(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reject").isNotNull()).select("reject")


def csv_table(spark: SparkSession, path: str, schema: str | T.StructType, *, view: str | None = None) -> DataFrame:
    """CSV files with a declared schema, also under a SQL name if one is given."""
    df = spark.read.schema(schema).csv(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def declare_csv(spark: SparkSession, view: str, columns: str, path: str) -> None:
    """The same through SQL DDL."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {view} ({columns}) USING csv OPTIONS (path '{path}')")


def as_table(
    df: DataFrame,
    columns: Names | None = None,
    *,
    rename: dict[str, str] | None = None,
    rowtime: tuple[str, str] | None = None,
    delay: str | None = None,
    proctime: str | None = None,
    view: str | None = None,
) -> DataFrame:
    """A stream or table with chosen and renamed columns and time attributes.

    ``rowtime`` is (epoch millisecond column, new timestamp column), watermarked if a
    ``delay`` is given; ``proctime`` names a processing-time column.
    """
    picked = [F.col(c).alias((rename or {}).get(c, c)) for c in names(columns) or df.columns]
    if rowtime:
        picked.append(event_time(rowtime[0]).alias(rowtime[1]))
    if proctime:
        picked.append(F.current_timestamp().alias(proctime))
    table = df.select(*picked)
    if rowtime and delay:
        table = table.withWatermark(rowtime[1], delay)
    if view:
        table.createOrReplaceTempView(view)
    return table


def schema_text(df: DataFrame) -> str:
    """The schema as text, one column per line."""
    return "\n".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)
