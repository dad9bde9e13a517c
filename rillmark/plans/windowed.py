"""Aggregates, windows and ranking over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.functions.aggregate import Mergeable
from rillmark.functions.text import tokens, window_text
from rillmark.functions.time import epoch_ms, event_time, window_start_ms
from rillmark.operators import aggregates, project, ranking, windows
from rillmark.plans.catalog import MS, Tables, bucket, query
from rillmark.plans.records import TRIMMED, WORDS, lines
from rillmark.sinks.writers import kafka_records
from rillmark.sources import readers


def tumbled(key: str, size: str, cnt: str = "cnt") -> str:
    b = bucket(size)
    head = f"{key}, " if key else ""
    return (
        f"SELECT {head}{b} AS window_start, {b} + INTERVAL '{size}' AS window_end, count(*) AS {cnt} "
        f"FROM events GROUP BY ALL"
    )


def hopped(key: str, size: int, slide: int) -> str:
    b = bucket(f"{slide} hours")
    return f"""
        SELECT {key}, s AS window_start, s + INTERVAL '{size} hours' AS window_end, count(*) AS cnt
        FROM (SELECT {key}, {b} - to_hours({slide} * k) AS s FROM events, range({size // slide}) r(k))
        GROUP BY ALL"""


# Aggregates without windows.


@query("a1_word_count", f"SELECT word, count(*) AS n FROM ({WORDS}) GROUP BY word")
def a1(t: Tables) -> DataFrame:
    return aggregates.count_by(project.tokenize(t.table("documents"), "text"), "word", "n")


def running(key: str) -> str:
    return f"SELECT event_id, {key}, count(*) OVER (PARTITION BY {key} ORDER BY event_id) AS cnt FROM events"


@query("a2_running_sum", running("event_type"))
def a2(t: Tables) -> DataFrame:
    return aggregates.running_count(t.events.select("event_id", "event_type"), key="event_type", order="event_id")


@query("a2_running_word_count", f"""
    SELECT doc_id, place, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, place) AS cnt FROM (
        SELECT doc_id, unnest(parts) AS word, unnest(range(len(parts))) AS place FROM (
            SELECT doc_id, string_split({TRIMMED}, ' ') AS parts FROM documents WHERE NOT (text <> '' AND {TRIMMED} = '')))""")
def a2_words(t: Tables) -> DataFrame:
    """After each word of the documents, in their order, how often it has come so far."""
    words = t.table("documents").select("doc_id", F.posexplode(tokens("text")).alias("place", "word"))
    words = words.withColumn("place", F.col("place").cast("bigint"))
    return aggregates.running_count(words, key="word", order=["doc_id", "place"])


@query("a4_running_reduce", running("user_id"))
def a4(t: Tables) -> DataFrame:
    return aggregates.running_count(t.events.select("event_id", "user_id"), key="user_id", order="event_id")


@query("a5_running_leader", """
    SELECT event_id, user_id, top.leader AS leader, top.cnt AS leader_cnt FROM (
        SELECT event_id, user_id,
               max({'cnt': cnt, 'at': event_id, 'leader': user_id}) OVER (ORDER BY event_id) AS top
        FROM (SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS cnt FROM events))""")
def a5(t: Tables) -> DataFrame:
    return aggregates.running_leader(t.events.select("event_id", "user_id"), key="user_id", order="event_id")


@query("a6_rolling_max", """
    SELECT event_id, user_id, value, event_type,
           max(value) OVER w AS max_value, first_value(event_type) OVER w AS first_event_type
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def a6(t: Tables) -> DataFrame:
    narrow = t.events.select("event_id", "user_id", "value", "event_type")
    return aggregates.rolling_max(narrow, key="user_id", order="event_id", value="value", keep="event_type")


@query("a7_rolling_max_by", """
    SELECT event_id, user_id, -b.o AS best_id, b.v AS best_value FROM (
        SELECT event_id, user_id,
               max({'v': value, 'o': -event_id}) OVER (PARTITION BY user_id ORDER BY event_id) AS b
        FROM events)""")
def a7(t: Tables) -> DataFrame:
    narrow = t.events.select("event_id", "user_id", "value")
    led = aggregates.rolling_max_by(narrow, key="user_id", order="event_id", value="value")
    return led.select(
        "event_id", "user_id", F.col("best.event_id").alias("best_id"), F.col("best.value").alias("best_value")
    )


@query("a8_group_count", "SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id")
def a8(t: Tables) -> DataFrame:
    return t.register("events").sql("SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id")


@query("a9_nested_count", """
    SELECT cnt, count(*) AS users FROM (SELECT user_id, count(1) AS cnt FROM events GROUP BY user_id) GROUP BY cnt""")
def a9(t: Tables) -> DataFrame:
    return aggregates.count_by(aggregates.count_by(t.events, "user_id"), "cnt", "users")


@query("a10_count_trigger_avg", f"""
    SELECT user_id, round, CAST(sum(ms) FILTER (slot < 5) // 5 AS BIGINT) AS avg_value FROM (
        SELECT user_id, {MS} AS ms, (rn - 1) // 6 AS round, (rn - 1) % 6 AS slot
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events))
    GROUP BY ALL HAVING count(*) = 6""")
def a10(t: Tables) -> DataFrame:
    narrow = t.events.select("user_id", "event_id", "ts")
    return aggregates.every_nth_avg(narrow, key="user_id", order="event_id", value=epoch_ms("ts"))


@query("a11_cumulative_total", f"""
    SELECT user_id, reported_at, n, CAST(sum(n) OVER (PARTITION BY user_id ORDER BY reported_at) AS BIGINT) AS total
    FROM (SELECT user_id, {bucket('3 hours')} + INTERVAL '3 hours' AS reported_at, count(*) AS n FROM events GROUP BY ALL)""")
def a11(t: Tables) -> DataFrame:
    return aggregates.cumulative_count(t.events, key="user_id", ts="ts", every="3 hours")


REPORTS = """
    WITH RECURSIVE e AS (SELECT user_id, epoch_us(ts) AS us FROM events),
    r AS (SELECT user_id, min(us) + 10800000000 AS reported_us FROM e GROUP BY user_id
          UNION ALL
          SELECT r.user_id, min(e.us) + 10800000000 FROM r JOIN e ON e.user_id = r.user_id AND e.us > r.reported_us
          GROUP BY r.user_id, r.reported_us)
    SELECT r.user_id, r.reported_us, count(*) AS total FROM r JOIN e ON e.user_id = r.user_id AND e.us <= r.reported_us
    GROUP BY ALL"""


@query("a11_report_totals", REPORTS)
def a11_reports(t: Tables) -> DataFrame:
    found = aggregates.report_totals(t.events, key="user_id", ts="ts", seq="event_id", wait="3 hours")
    return found.select("user_id", F.unix_micros(F.col("reported_at").cast("timestamp")).alias("reported_us"), "total")


# Time and count windows.


@query("w1_tumble_reduce", tumbled("user_id", "10 hours"))
def w1(t: Tables) -> DataFrame:
    return windows.tumble(t.events, ts="ts", size="10 hours", key="user_id")


@query("w2_tumble_offset", """
    SELECT b AS window_start, b + INTERVAL '1 day' AS window_end, count(*) AS cnt
    FROM (SELECT time_bucket(INTERVAL '1 day', ts, TIMESTAMP '1970-01-01 16:00:00') AS b FROM events) GROUP BY ALL""")
def w2(t: Tables) -> DataFrame:
    return windows.tumble(t.events, ts="ts", size="1 day", offset="16 hours")


@query("w3_hop_user_count", hopped("user_id", 10, 2))
def w3(t: Tables) -> DataFrame:
    return windows.hop(t.events, ts="ts", size="10 hours", slide="2 hours", key="user_id", panes=False)


@query("w4_session_user", """
    SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL '6 hours' AS window_end, count(*) AS cnt FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session_no FROM (
            SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL '6 hours'
                                     THEN 0 ELSE 1 END AS fresh FROM events))
    GROUP BY user_id, session_no""")
def w4(t: Tables) -> DataFrame:
    return windows.session(t.events, ts="ts", gap="6 hours", key="user_id")


POSITIONED = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events"


@query("w5_count_window", f"""
    SELECT user_id, (rn - 1) // 10 AS window_no, min(event_id) AS first_id, max(event_id) AS last_id
    FROM ({POSITIONED}) GROUP BY ALL HAVING count(*) = 10""")
def w5(t: Tables) -> DataFrame:
    return windows.count_window(
        t.events.select("user_id", "event_id"),
        key="user_id",
        order="event_id",
        size=10,
        aggs=[F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id")],
    )


@query("w5_count_window_sliding", f"""
    SELECT user_id, position, n, CAST(id_sum AS BIGINT) AS id_sum FROM (
        SELECT user_id, row_number() OVER w AS position, count(*) OVER f AS n, sum(event_id) OVER f AS id_sum
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id),
                           f AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
    WHERE position % 2 = 0""")
def w5_sliding(t: Tables) -> DataFrame:
    return windows.count_window_sliding(
        t.events.select("user_id", "event_id"),
        key="user_id",
        order="event_id",
        size=10,
        slide=2,
        aggs={"n": F.count(F.lit(1)), "id_sum": F.sum("event_id")},
    )


@query("w6_window_avg_time", f"""
    SELECT user_id, {bucket('1 day')} AS window_start, {bucket('1 day')} + INTERVAL '1 day' AS window_end,
           CAST(sum({MS}) // count(*) AS BIGINT) AS avg_ms FROM events GROUP BY ALL""")
def w6(t: Tables) -> DataFrame:
    return windows.avg_event_time(t.events, key="user_id", ts="ts", size="1 day")


@query("w7_window_pv_uv", f"""
    SELECT {bucket('12 hours')} AS window_start, {bucket('12 hours')} + INTERVAL '12 hours' AS window_end,
           count(*) AS pv, count(DISTINCT user_id) AS uv, count(*)::DOUBLE / count(DISTINCT user_id) AS pv_per_uv
    FROM events GROUP BY ALL""")
def w7(t: Tables) -> DataFrame:
    return windows.pv_uv(t.events, ts="ts", size="12 hours", user="user_id")


@query("w8_window_pv", tumbled("", "12 hours", "pv"))
def w8(t: Tables) -> DataFrame:
    return windows.tumble(t.events, ts="ts", size="12 hours", aggs=[F.count(F.lit(1)).alias("pv")])


DISTINCT_USERS = f"""
    SELECT {bucket('12 hours')} AS window_start, {bucket('12 hours')} + INTERVAL '12 hours' AS window_end,
           count(DISTINCT user_id) AS uv"""


@query("w9_window_uv", f"{DISTINCT_USERS} FROM events GROUP BY ALL")
def w9(t: Tables) -> DataFrame:
    return windows.tumble(t.events, ts="ts", size="12 hours", aggs=[F.count_distinct("user_id").alias("uv")])


@query("w10_full_window", f"""
    {DISTINCT_USERS}, min(event_id) AS first_id, max(event_id) AS last_id, max(value) AS top_value
    FROM events GROUP BY ALL""")
def w10(t: Tables) -> DataFrame:
    return windows.tumble(
        t.events,
        ts="ts",
        size="12 hours",
        aggs=[
            F.count_distinct("user_id").alias("uv"),
            F.min("event_id").alias("first_id"),
            F.max("event_id").alias("last_id"),
            F.max("value").alias("top_value"),
        ],
    )


@query("w11_tumble_type_count", tumbled("event_type", "1 hour"))
def w11(t: Tables) -> DataFrame:
    return windows.tumble(t.events, ts="ts", size="1 hour", key="event_type")


def as_text(inner: str, label: str) -> str:
    return f"""
        SELECT {label} || ': ' || CAST(cnt AS VARCHAR) || ' in [' || strftime(window_start, '%Y-%m-%d %H:%M:%S')
               || ', ' || strftime(window_end, '%Y-%m-%d %H:%M:%S') || ')' AS line FROM ({inner})"""


@query("w12_window_text", as_text(tumbled("event_type", "1 hour"), "event_type"))
def w12(t: Tables) -> DataFrame:
    counted = windows.tumble(t.events, ts="ts", size="1 hour", key="event_type")
    return counted.select(window_text("event_type", "cnt", "window_start", "window_end").alias("line"))


def ranked(inner: str, by: str, n: int) -> str:
    return f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY window_start, window_end ORDER BY {by}) AS rank
                       FROM ({inner})) WHERE rank <= {n}"""


@query("w13_window_topn", ranked(hopped("event_type", 10, 5), "cnt DESC, event_type", 2))
def w13(t: Tables) -> DataFrame:
    counts = windows.hop(t.events, ts="ts", size="10 hours", slide="5 hours", key="event_type")
    return ranking.rank_within(counts, group=["window_start", "window_end"], by="cnt", tie="event_type", n=2)


@query("w14_window_topn_users", ranked(hopped("user_id", 10, 5), "cnt DESC, user_id", 2))
def w14(t: Tables) -> DataFrame:
    counts = windows.hop(t.events, ts="ts", size="10 hours", slide="5 hours", key="user_id", panes=False)
    return ranking.rank_within(counts, group=["window_start", "window_end"], by="cnt", tie="user_id", n=2)


@query("w15_sql_tumble_end", f"""
    SELECT user_id, {bucket('10 hours')} + INTERVAL '10 hours' AS tumble_end, count(*) AS cnt FROM events GROUP BY ALL""")
def w15(t: Tables) -> DataFrame:
    return t.register("events").sql("""
        SELECT user_id, window.end AS tumble_end, cnt
        FROM (SELECT user_id, window(ts, '10 hours') AS window, count(*) AS cnt
              FROM events GROUP BY user_id, window(ts, '10 hours'))""")


@query("w16_tumble_rows", f"""
    SELECT event_id, {bucket('1 hour')} AS window_start, {bucket('1 hour')} + INTERVAL '1 hour' AS window_end FROM events""")
def w16(t: Tables) -> DataFrame:
    return windows.with_window(t.events.select("event_id", "ts"), "ts", "1 hour").drop("ts")


@query("w17_hop_rows", f"""
    SELECT event_id, s AS window_start, s + INTERVAL '10 hours' AS window_end
    FROM (SELECT event_id, {bucket('2 hours')} - to_hours(2 * k) AS s FROM events, range(5) r(k))""")
def w17(t: Tables) -> DataFrame:
    return windows.with_window(t.events.select("event_id", "ts"), "ts", "10 hours", "2 hours").drop("ts")


def cumulated(key: str) -> str:
    return f"""
        SELECT {key}, s AS window_start, s + to_hours(2 * k) AS window_end, count(*) AS cnt, max(value) AS top_value
        FROM (SELECT {key}, ts, value, {bucket('10 hours')} AS s FROM events), range(1, 6) r(k)
        WHERE s + to_hours(2 * k) > ts GROUP BY ALL"""


@query("w18_cumulate_type_count", cumulated("event_type"))
def w18(t: Tables) -> DataFrame:
    measures = {"cnt": Mergeable("count", F.lit(1)), "top_value": Mergeable("max", F.col("value"))}
    return windows.cumulate(t.events, ts="ts", size="10 hours", step="2 hours", key="event_type", measures=measures)


@query("w19_window_by_arithmetic", f"""
    SELECT event_type, {MS} // 36000000 * 36000000 AS start_ms, count(*) AS cnt FROM events GROUP BY ALL""")
def w19(t: Tables) -> DataFrame:
    placed = t.events.withColumn("start_ms", window_start_ms(epoch_ms("ts"), 36_000_000))
    return aggregates.count_by(placed, ["event_type", "start_ms"])


@query("w21_record_window_record", f"""
    SELECT '(' || event_type || ',' || CAST(count(*) AS VARCHAR) || ')' AS value FROM events
    GROUP BY event_type, {bucket('10 hours')}""")
def w21(t: Tables) -> DataFrame:
    clicks = readers.accepted(readers.parse_records(lines(t)))
    timed = clicks.withColumn("ts", event_time("timestamp"))
    counted = windows.tumble(timed, ts="ts", size="10 hours", key="url")
    return kafka_records(counted.select(F.format_string("(%s,%d)", "url", "cnt").alias("value")), "value")


# Ranking and OVER windows.


@query("o1_over_avg_rows", f"""
    SELECT event_id, user_id, CAST(sum({MS}) OVER w // count(*) OVER w AS BIGINT) AS recent_avg FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""")
def o1(t: Tables) -> DataFrame:
    narrow = t.events.select("event_id", "user_id", "ts")
    found = aggregates.recent_avg(narrow, key="user_id", order="event_id", value=epoch_ms("ts"))
    return found.drop("ts")


@query("o2_global_top2", """
    SELECT * FROM (SELECT user_id, cnt, row_number() OVER (ORDER BY cnt DESC, user_id) AS rank
                   FROM (SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id)) WHERE rank <= 2""")
def o2(t: Tables) -> DataFrame:
    return ranking.top_overall(aggregates.count_by(t.events, "user_id"), by="cnt", tie="user_id", n=2)


@query("o3_window_topn_asc", ranked(tumbled("user_id", "1 day"), "cnt, user_id", 2))
def o3(t: Tables) -> DataFrame:
    counts = windows.tumble(t.events, ts="ts", size="1 day", key="user_id")
    return ranking.rank_within(
        counts, group=["window_start", "window_end"], by="cnt", tie="user_id", n=2, descending=False
    )


@query("o4_window_sorted", ranked(tumbled("user_id", "12 hours"), "cnt DESC, user_id", 5))
def o4(t: Tables) -> DataFrame:
    counts = windows.tumble(t.events, ts="ts", size="12 hours", key="user_id")
    return ranking.rank_within(counts, group=["window_start", "window_end"], by="cnt", tie="user_id", n=5)


@query("u4_table_agg_top2", f"""
    SELECT window_end, event_type, cnt AS value, rank
    FROM ({ranked(tumbled('event_type', '1 day'), 'cnt DESC, event_type', 2)})""")
def u4(t: Tables) -> DataFrame:
    counts = windows.tumble(t.events, ts="ts", size="1 day", key="event_type")
    top = ranking.rank_within(counts, group="window_end", by="cnt", tie="event_type", n=2)
    return top.select("window_end", "event_type", F.col("cnt").alias("value"), "rank")
