"""Sources, projections, functions and distribution over the given tables."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions import text as tx
from rillmark.functions import time as tm
from rillmark.functions.aggregate import integer_avg, weighted_avg
from rillmark.operators import distribute, joins, project
from rillmark.plans.catalog import MS, Tables, bucket, query
from rillmark.sinks import writers
from rillmark.sources import readers

LINE = f"CAST(user_id AS VARCHAR) || ',' || event_type || ',' || CAST({MS} AS VARCHAR)"
SHOWN = "regexp_replace(strftime({}, '%Y-%m-%d %H:%M:%S.%g'), '(\\.\\d+?)0*$', '\\1')"
TRIMMED = "regexp_replace(text, '( )+$', '')"
WORDS = (
    f"SELECT unnest(string_split({TRIMMED}, ' ')) AS word FROM documents "
    f"WHERE NOT (text <> '' AND {TRIMMED} = '')"
)


def lines(t: Tables, pad: str = "") -> DataFrame:
    """Events as delimited text lines."""
    c = t.clicks()
    return c.select(F.concat_ws(f"{pad},{pad}", "username", "url", F.col("timestamp").cast("string")).alias("value"))


# Sources and sinks. Files are written by Spark from the given tables and read back.


@query("s1_text_lines", f"SELECT {LINE} AS value FROM events")
def s1(t: Tables) -> DataFrame:
    path = t.scratch("text-lines")
    lines(t).write.text(path)
    return readers.text_lines(t.spark, path)


@query("s5_parse_records", f"SELECT CAST(user_id AS VARCHAR) AS username, event_type AS url, {MS} AS timestamp FROM events")
def s5(t: Tables) -> DataFrame:
    return readers.accepted(readers.parse_records(lines(t, pad=" ")))


@query(
    "s5_parse_rejects",
    f"SELECT CASE WHEN event_id % 10 = 0 THEN event_type ELSE {LINE} || 'x' END AS reject FROM events WHERE event_id % 5 = 0",
)
def s5_rejects(t: Tables) -> DataFrame:
    good = F.concat_ws(",", F.col("user_id").cast("string"), "event_type", tm.epoch_ms("ts").cast("string"))
    line = (
        F.when(F.col("event_id") % 10 == 0, F.col("event_type"))
        .when(F.col("event_id") % 5 == 0, F.concat(good, F.lit("x")))
        .otherwise(good)
    )
    return readers.rejected(readers.parse_records(t.events.select(line.alias("value"))))


@query("s6_csv_table", "SELECT user_id, event_type, event_id FROM events WHERE event_type = 'purchase'")
def s6(t: Tables) -> DataFrame:
    path = t.scratch("csv-table")
    writers.to_csv_table(t.events, path, ["user_id", "event_type", "event_id"])
    readers.declare_csv(t.spark, "event_csv", "user_id BIGINT, event_type STRING, event_id BIGINT", path)
    return t.spark.sql("SELECT user_id, event_type, event_id FROM event_csv WHERE event_type = 'purchase'")


@query("s7_stream_as_table", f"SELECT CAST(user_id AS VARCHAR) AS username, event_type AS url, {MS} AS timestamp FROM events")
def s7(t: Tables) -> DataFrame:
    return readers.as_table(t.clicks())


@query(
    "s8_table_attributes",
    f"SELECT CAST(user_id AS VARCHAR) AS username, event_type AS url, {MS} AS ts, make_timestamp({MS} * 1000) AS et FROM events",
)
def s8(t: Tables) -> DataFrame:
    table = readers.as_table(
        t.clicks(), ["username", "url", "timestamp"], rename={"timestamp": "ts"}, rowtime=("timestamp", "et")
    )
    return table.withColumn("et", F.col("et").cast("timestamp_ntz"))


@query("s9_computed_time_column", f"SELECT event_id, make_timestamp({MS} // 1000 * 1000000) AS et FROM events")
def s9(t: Tables) -> DataFrame:
    t.register("events")
    return t.spark.sql("""
        SELECT event_id,
               CAST(to_timestamp(from_unixtime(unix_millis(CAST(ts AS TIMESTAMP)) DIV 1000)) AS TIMESTAMP_NTZ) AS et
        FROM events""")


@query("s10_proctime_column", "SELECT event_id, TRUE AS after_event FROM events")
def s10(t: Tables) -> DataFrame:
    table = readers.as_table(t.events, ["event_id", "ts"], proctime="pt")
    return table.select("event_id", (F.col("pt") > F.col("ts").cast("timestamp")).alias("after_event"))


@query("s11_named_view", "SELECT user_id, event_type FROM events WHERE value > 50")
def s11(t: Tables) -> DataFrame:
    return t.spark.sql("SELECT user_id, event_type FROM {t} WHERE value > 50", t=t.events)


@query("k2_text_file_sink", f"""
    SELECT 'Event{{username=''' || CAST(user_id AS VARCHAR) || ''', url=''' || event_type || ''', timestamp='
           || {SHOWN.format('ts')} || '}}' AS value FROM events""")
def k2(t: Tables) -> DataFrame:
    path = t.scratch("text-sink")
    writers.to_text_files(t.clicks().select(tx.event_text("username", "url", "timestamp").alias("value")), path)
    return t.spark.read.text(path)


@query("k3_csv_table_sink", "SELECT event_id, event_type FROM events")
def k3(t: Tables) -> DataFrame:
    path = t.scratch("csv-sink")
    writers.to_csv_table(t.events, path, ["event_id", "event_type"])
    return readers.csv_table(t.spark, path, "event_id BIGINT, event_type STRING")


@query("k5_kafka_records", f"SELECT CAST(user_id AS VARCHAR) AS username, event_type AS url, {MS} AS timestamp FROM events")
def k5(t: Tables) -> DataFrame:
    record = writers.kafka_records(lines(t), "value")
    wire = record.select(F.col("value").cast("binary").alias("value"))
    return readers.accepted(readers.parse_records(readers.kafka_values(wire)))


@query("k7_buffered_sink", "SELECT event_id, TRUE AS within_buffer FROM events")
def k7(t: Tables) -> DataFrame:
    """Flushed in groups and read back from where they were flushed to; run twice, as a lost task would be."""
    folder = t.scratch("buffered")
    for _ in range(2):
        flushed = writers.write_buffered(t.events.select("event_id"), writers.flush_files(folder), 1000)
        largest = flushed.agg(F.max("rows")).first()[0]
    return t.spark.read.parquet(folder).select("event_id", F.lit(largest <= 1000).alias("within_buffer"))


# Projections and filters.


@query("p1_map_field", "SELECT user_id FROM events")
def p1(t: Tables) -> DataFrame:
    return project.project(t.events, "user_id")


@query("p2_filter_map", "SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10'")
def p2(t: Tables) -> DataFrame:
    return project.project(t.events, "user_id", F.col("ts") >= F.expr("timestamp_ntz'2024-01-10'"))


@query("p3_flatmap_cond", "SELECT event_type FROM events WHERE length(event_type) >= 6")
def p3(t: Tables) -> DataFrame:
    return project.project(t.events, "event_type", F.length("event_type") >= 6)


@query("p4_tokenize", f"SELECT CAST(length(word) AS BIGINT) AS word_length, count(*) AS n FROM ({WORDS}) GROUP BY 1")
def p4(t: Tables) -> DataFrame:
    words = project.tokenize(t.table("documents"), "text")
    return words.groupBy(F.length("word").cast("bigint").alias("word_length")).agg(F.count(F.lit(1)).alias("n"))


@query("p5_pairs", "SELECT event_type, CAST(1 AS BIGINT) AS n FROM events")
def p5(t: Tables) -> DataFrame:
    return project.pairs(t.events, "event_type")


@query("p6_task_lifecycle", "SELECT event_id, length(event_type) AS size, TRUE AS opened FROM events")
def p6(t: Tables) -> DataFrame:
    def run(resource: dict, task: int, batch: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(
            {
                "event_id": batch["event_id"],
                "size": batch["event_type"].str.len(),
                "opened": resource["task"] == task,
            }
        )

    return project.map_with_lifecycle(
        t.events.select("event_id", "event_type"),
        "event_id bigint, size bigint, opened boolean",
        run,
        open_task=lambda task: {"task": task},
        close_task=lambda resource, task: resource.clear(),
    )


@query("p7_branch_emit", """
    SELECT event_id, event_type AS out FROM events WHERE event_type IN ('click', 'purchase')
    UNION ALL
    SELECT event_id, CAST(user_id AS VARCHAR) FROM events WHERE event_type = 'purchase'""")
def p7(t: Tables) -> DataFrame:
    click, buy = F.col("event_type") == "click", F.col("event_type") == "purchase"
    branches = [(click | buy, F.col("event_type")), (buy, F.col("user_id").cast("string"))]
    return project.emit(t.events, branches, keep="event_id")


@query("p8_sql_projection", "SELECT user_id, event_type, ts FROM events")
def p8(t: Tables) -> DataFrame:
    return t.register("events").sql("SELECT user_id, event_type, ts FROM events")


@query("p9_sql_filter", "SELECT user_id, event_type FROM events WHERE user_id = 7")
def p9(t: Tables) -> DataFrame:
    return t.register("events").sql("SELECT user_id, event_type FROM events WHERE user_id = 7")


@query("p10_dsl_filter", "SELECT user_id, event_type FROM events WHERE event_type = 'click'")
def p10(t: Tables) -> DataFrame:
    return t.events.select("user_id", "event_type").where(F.col("event_type") == "click")


@query("p11_event_text", f"""
    SELECT event_id, 'Event{{username=''' || CAST(user_id AS VARCHAR) || ''', url=''' || event_type
           || ''', timestamp=' || {SHOWN.format('ts')} || '}}' AS event_text FROM events""")
def p11(t: Tables) -> DataFrame:
    return t.events.select("event_id", tx.event_text("user_id", "event_type", tm.epoch_ms("ts")).alias("event_text"))


# Scalar functions.


@query("f1_unixtime_text", "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS shown FROM events")
def f1(t: Tables) -> DataFrame:
    return t.events.select("event_id", tm.unixtime_text(tm.epoch_ms("ts")).alias("shown"))


@query("f2_parse_timestamp", "SELECT event_id, date_trunc('second', ts) AS parsed FROM events")
def f2(t: Tables) -> DataFrame:
    parsed = tm.parse_timestamp(tm.unixtime_text(tm.epoch_ms("ts")))
    return t.events.select("event_id", parsed.cast("timestamp_ntz").alias("parsed"))


@query("f3_processing_time", "SELECT count(*) AS n, TRUE AS one_clock FROM events")
def f3(t: Tables) -> DataFrame:
    clock = t.events.select(tm.processing_time().alias("pt"))
    return clock.agg(F.count("pt").alias("n"), (F.min("pt") == F.max("pt")).alias("one_clock"))


@query("f4_interval_minus", "SELECT event_id, ts - INTERVAL '1 second' AS earlier FROM events")
def f4(t: Tables) -> DataFrame:
    return t.events.select("event_id", tm.minus("ts", "1 second").alias("earlier"))


@query("f5_tumble_end", f"SELECT event_id, {bucket('10 hours')} + INTERVAL '10 hours' AS tumble_end FROM events")
def f5(t: Tables) -> DataFrame:
    windowed = t.events.select("event_id", F.window("ts", "10 hours").alias("window"))
    return windowed.select("event_id", tm.window_end().alias("tumble_end"))


@query("f6_timestamp_text", f"SELECT event_id, {SHOWN.format('ts')} AS shown FROM events")
def f6(t: Tables) -> DataFrame:
    return t.events.select("event_id", tm.timestamp_text(tm.epoch_ms("ts")).alias("shown"))


@query("f7_split_text", """
    SELECT page_id, CAST(len(string_split(rtrim(url, '/'), '/')) AS BIGINT) AS segments, string_split(url, '?')[1] AS head FROM pages""")
def f7(t: Tables) -> DataFrame:
    return t.table("pages").select(
        "page_id",
        F.size(tx.split_text("url", "/")).cast("bigint").alias("segments"),
        F.get(tx.split_text("url", "?"), F.lit(0)).alias("head"),
    )


@query("f8_trim_parse", f"SELECT event_id, {MS} AS ms, TRUE AS unreadable FROM events")
def f8(t: Tables) -> DataFrame:
    padded = F.concat(F.lit("  "), tm.epoch_ms("ts").cast("string"), F.lit("L "))
    return t.events.select("event_id", tx.parse_long(padded).alias("ms"), tx.parse_long("event_type").isNull().alias("unreadable"))


@query("f9_length", "SELECT event_id, CAST(length(event_type) AS BIGINT) AS n FROM events")
def f9(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.length("event_type").cast("bigint").alias("n"))


@query("f11_window_start_ms", f"SELECT event_id, {MS} // 36000000 * 36000000 AS start_ms FROM events")
def f11(t: Tables) -> DataFrame:
    return t.events.select("event_id", tm.window_start_ms(tm.epoch_ms("ts"), 36_000_000).alias("start_ms"))


@query("f12_compare_branch", """
    SELECT event_id, CASE WHEN value >= 75 THEN 'high' WHEN value <= 25 THEN 'low' ELSE 'mid' END AS level FROM events""")
def f12(t: Tables) -> DataFrame:
    level = F.when(F.col("value") >= 75, "high").when(F.col("value") <= 25, "low").otherwise("mid")
    return t.events.select("event_id", level.alias("level"))


@query("f13_count_avg", f"""
    SELECT event_type, count(*) AS n, count(1) AS n1, CAST(sum({MS}) // count(*) AS BIGINT) AS avg_ms FROM events GROUP BY 1""")
def f13(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count(F.lit(1)).alias("n1"), integer_avg(tm.epoch_ms("ts")).alias("avg_ms")
    )


# User-defined functions.


HASH_ORACLE = """
    SELECT event_type, CAST(list_reduce(
        list_prepend(CAST(0 AS BIGINT), list_transform(string_split(event_type, ''), lambda c: CAST(ord(c) AS BIGINT))),
        lambda h, c: (((h * 31 + c + 2147483648) % 4294967296 + 4294967296) % 4294967296) - 2147483648) AS INTEGER) AS hash,
        count(*) AS n
    FROM events GROUP BY event_type"""


def hashed(df: DataFrame, hash_column: T.DataType | object) -> DataFrame:
    counted = df.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.select("event_type", hash_column.alias("hash"), "n")


@query("u1_string_hash", HASH_ORACLE)
def u1(t: Tables) -> DataFrame:
    return hashed(t.events, tx.string_hash("event_type"))


@query("u1_string_hash_sql", HASH_ORACLE)
def u1_sql(t: Tables) -> DataFrame:
    return t.register("events").sql(
        "SELECT event_type, string_hash(event_type) AS hash, count(*) AS n FROM events GROUP BY event_type"
    )


# Every third address is made to end in the separator.
ENDED = "CASE WHEN page_id % 3 = 0 THEN url || '?' ELSE url END"
PARTS = f"""
    SELECT url, word, CAST(length(word) AS {{}}) AS length
    FROM (SELECT url, unnest(string_split(rtrim(url, '?'), '?')) AS word FROM (SELECT {ENDED} AS url FROM pages))"""


@query("u2_table_function", PARTS.format("INTEGER"))
def u2(t: Tables) -> DataFrame:
    return t.register("pages").sql(
        f"SELECT url, T.word, T.length FROM (SELECT {ENDED} AS url FROM pages), LATERAL split_lengths(url) AS T"
    )


@query("j8_lateral_split", PARTS.format("BIGINT"))
def j8(t: Tables) -> DataFrame:
    return joins.lateral_split(t.table("pages").select(F.expr(ENDED).alias("url")), "url")


@query("u3_weighted_avg", f"""
    SELECT user_id, CAST(sum({MS} * (event_id % 3 + 1)) // sum(event_id % 3 + 1) AS BIGINT) AS avg_ms
    FROM events GROUP BY user_id""")
def u3(t: Tables) -> DataFrame:
    avg = weighted_avg(tm.epoch_ms("ts"), F.col("event_id") % 3 + 1)
    return t.events.groupBy("user_id").agg(avg.alias("avg_ms"))


# Distribution.


def parts_per_key(df: DataFrame, key: str) -> DataFrame:
    placed = df.select(key, F.spark_partition_id().alias("part"))
    return placed.groupBy(key).agg(F.count_distinct("part").alias("parts"), F.count(F.lit(1)).alias("n"))


def kept(df: DataFrame) -> DataFrame:
    """Rows and their sum, tasks that hold rows, and whether no task holds over half as many again as its share."""
    per_task = df.groupBy(F.spark_partition_id().alias("part")).agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("s"))
    even = F.max("n") * F.count(F.lit(1)) <= 1.5 * F.sum("n") + F.count(F.lit(1))
    return per_task.agg(F.sum("n").alias("n"), F.sum("s").alias("id_sum"), F.count(F.lit(1)).alias("tasks"), even.alias("even"))


def spread_over(tasks: int) -> str:
    return (
        "SELECT count(*) AS n, CAST(sum(event_id) AS BIGINT) AS id_sum, "
        f"CAST({tasks} AS BIGINT) AS tasks, TRUE AS even FROM events"
    )


@query("r1_by_key", "SELECT user_id, CAST(1 AS BIGINT) AS parts, count(*) AS n FROM events GROUP BY user_id")
def r1(t: Tables) -> DataFrame:
    return parts_per_key(distribute.by_key(t.events, "user_id"), "user_id")


@query("r2_at_random", spread_over(8))
def r2(t: Tables) -> DataFrame:
    return kept(distribute.at_random(t.events, 8, seed=7))


@query("r3_round_robin", spread_over(8))
def r3(t: Tables) -> DataFrame:
    return kept(distribute.round_robin(t.events, 8))


@query("r4_rescale", spread_over(4))
def r4(t: Tables) -> DataFrame:
    return kept(distribute.rescale(distribute.round_robin(t.events, 8), 4, 8))


@query("r7_by_rule", "SELECT event_id, CAST(event_id % 2 AS INTEGER) AS part FROM events")
def r7(t: Tables) -> DataFrame:
    placed = distribute.by_rule(t.events.select("event_id"), 4, F.col("event_id") % 2)
    return placed.select("event_id", F.spark_partition_id().alias("part"))
