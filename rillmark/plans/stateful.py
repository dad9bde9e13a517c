"""Joins, late data, state and patterns over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.functions.text import window_text
from rillmark.operators import joins, late, patterns, state
from rillmark.plans.catalog import Tables, bucket, query
from rillmark.plans.windowed import as_text

# Joins and routing.

UNION = "SELECT user_id, ts, event_id FROM events WHERE event_type IN ('click', 'view')"


@query("j1_union_all", UNION)
def j1(t: Tables) -> DataFrame:
    return joins.union_all(t.event("click"), t.event("view"))


@query("o5_union_duplicates", f"{UNION} UNION ALL {UNION}")
def o5(t: Tables) -> DataFrame:
    return joins.union_all(t.event("click", "view"), t.event("view"), t.event("click"))


@query("j2_split_channels", """
    SELECT event_id, user_id, CASE event_type WHEN 'click' THEN 'click' WHEN 'view' THEN 'view' ELSE 'other' END AS channel
    FROM events""")
def j2(t: Tables) -> DataFrame:
    tags = [(c, F.col("event_type") == c) for c in ("click", "view")]
    routed = joins.route(t.events, tags).select("event_id", "user_id", "channel")
    names = ("click", "view", "other")
    return joins.union_all(*[joins.channel(routed, n).withColumn("channel", F.lit(n)) for n in names])


@query("j3_bill_check", """
    SELECT coalesce(a.id, b.id) AS id, a.ts AS app_ts, b.ts AS third_ts,
           CASE WHEN b.id IS NULL THEN 'third_missing' WHEN a.id IS NULL THEN 'app_missing' ELSE 'match' END AS status
    FROM (SELECT o_orderkey AS id, o_orderdate AS ts FROM orders) a
    FULL JOIN (SELECT l_orderkey AS id, min(l_shipdate) AS ts FROM lineitem GROUP BY 1) b
    ON a.id = b.id AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL '30 days'""")
def j3(t: Tables) -> DataFrame:
    app = t.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts"))
    shipped = t.table("lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.min("l_shipdate").alias("ts"))
    return joins.reconcile(app, shipped, key="id", ts="ts", wait="30 days")


def typed(kind: str) -> str:
    return f"(SELECT user_id, ts, event_id, {bucket('1 day')} AS w FROM events WHERE event_type = '{kind}')"


@query("j4_window_join", f"""
    SELECT user_id, w AS window_start, w + INTERVAL '1 day' AS window_end,
           l.ts AS left_ts, l.event_id AS left_event_id, r.ts AS right_ts, r.event_id AS right_event_id
    FROM {typed('click')} l JOIN {typed('purchase')} r USING (user_id, w)""")
def j4(t: Tables) -> DataFrame:
    return joins.window_join(t.event("click"), t.event("purchase"), key="user_id", ts="ts", size="1 day")


def listed(kind: str) -> str:
    ids = f"list(event_id ORDER BY ts, event_id) FILTER (event_type = '{kind}')"
    return f"coalesce(array_to_string({ids}, ','), '')"


@query("j5_window_cogroup", f"""
    SELECT user_id, {bucket('1 day')} AS window_start, {bucket('1 day')} + INTERVAL '1 day' AS window_end,
           {listed('click')} AS left_ids, {listed('purchase')} AS right_ids, CAST(0 AS BIGINT) AS piece
    FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL""")
def j5(t: Tables) -> DataFrame:
    found = joins.window_cogroup(
        t.event("click"), t.event("purchase"), key="user_id", ts="ts", size="1 day", value="event_id"
    )
    return found.select(
        "user_id",
        "window_start",
        "window_end",
        F.concat_ws(",", F.col("left_list").cast("array<string>")).alias("left_ids"),
        F.concat_ws(",", F.col("right_list").cast("array<string>")).alias("right_ids"),
        "piece",
    )


@query("j5_window_cogroup_counts", f"""
    SELECT user_id, {bucket('1 day')} AS window_start, {bucket('1 day')} + INTERVAL '1 day' AS window_end,
           count(*) FILTER (event_type = 'click') AS left_n, count(*) FILTER (event_type = 'purchase') AS right_n
    FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL""")
def j5_counts(t: Tables) -> DataFrame:
    counts = [F.count_if(F.col("side") == s).alias(f"{s}_n") for s in ("left", "right")]
    return joins.window_aggregate(
        t.event("click"), t.event("purchase"), key="user_id", ts="ts", size="1 day", aggs=counts
    )


@query("j6_interval_join", """
    SELECT l.user_id, l.ts AS left_ts, l.event_id AS left_event_id, r.ts AS right_ts, r.event_id AS right_event_id
    FROM (SELECT * FROM events WHERE event_type = 'purchase') l
    JOIN (SELECT * FROM events WHERE event_type = 'click') r
    ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL '2 hours' AND l.ts + INTERVAL '3 hours'""")
def j6(t: Tables) -> DataFrame:
    return joins.interval_join(
        t.event("purchase"), t.event("click"), key="user_id", ts="ts", lower_ms=-7_200_000, upper_ms=10_800_000
    )


RULES = [(1, "error", "click"), (2, "click", "purchase")]


def matched(rules: str) -> str:
    return f"""
        SELECT event_id, user_id, event_type, action1, action2 FROM (
            SELECT event_id, user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous
            FROM events) e
        JOIN (VALUES {rules}) r(action1, action2) ON previous = action1 AND event_type = action2"""


def rules_of(t: Tables) -> DataFrame:
    return t.spark.createDataFrame(RULES, "arrival int, action1 string, action2 string")


def rule_matches(t: Tables, rules: DataFrame) -> DataFrame:
    actions = t.events.select("event_id", "user_id", "event_type")
    return joins.match_rules(actions, rules, key="user_id", order="event_id", action="event_type")


@query("j7_rule_match_latest", matched("('click', 'purchase')"))
def j7(t: Tables) -> DataFrame:
    return rule_matches(t, joins.latest_rule(rules_of(t), "arrival"))


@query("j7_rule_match_all", matched("('error', 'click'), ('click', 'purchase')"))
def j7_all(t: Tables) -> DataFrame:
    return rule_matches(t, rules_of(t))


# Late data, timers. Arrival is disordered by a rule, as the table itself is in order.

ARRIVED = "SELECT *, event_id + (event_id % 7) * 8 AS arrival FROM events"
CLASSIFIED = f"""
    SELECT *, w AS window_start, w + INTERVAL '1 hour' AS window_end,
           CASE WHEN wm IS NULL OR w + INTERVAL '1 hour' > wm THEN 'on_time'
                WHEN w + INTERVAL '2 hours' > wm THEN 'refire' ELSE 'late' END AS arrival_class
    FROM (SELECT *, {bucket('1 hour')} AS w,
                 max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
                 - INTERVAL '2 hours' AS wm FROM ({ARRIVED}))"""


def arrived(t: Tables) -> DataFrame:
    at = F.col("event_id") + (F.col("event_id") % 7) * 8
    return t.events.select("event_id", "user_id", "event_type", "ts", at.alias("arrival"))


def classified(t: Tables) -> DataFrame:
    return late.classify_late(
        arrived(t), ts="ts", arrival=["arrival", "event_id"], delay="2 hours", size="1 hour", lateness="1 hour"
    )


# Every signup brings a rule: after a view, an even one waits for a click and an odd one for a purchase.
RULED = """
    WITH paired AS (SELECT event_id, user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id) AS previous FROM events),
    rules AS (SELECT event_id AS came, 'view' AS action1, CASE WHEN event_id % 2 = 0 THEN 'click' ELSE 'purchase' END AS action2
              FROM events WHERE event_type = 'signup')
    SELECT p.user_id, p.event_id, p.event_type, r.action1, r.action2 FROM paired p ASOF JOIN rules r ON p.event_id >= r.came
    WHERE p.previous = r.action1 AND p.event_type = r.action2"""


@query("j7_rule_in_force", RULED)
def j7_in_force(t: Tables) -> DataFrame:
    waits = F.when(F.col("event_id") % 2 == 0, "click").otherwise("purchase")
    rules = t.event("signup").select("event_id", F.lit("view").alias("action1"), waits.alias("action2"))
    return joins.match_rules_in_force(t.events, rules, key="user_id", order="event_id", action="event_type")


@query("t1_event_time", "SELECT event_id, make_timestamp(epoch_us(ts) // 1000 * 1000) AS ts FROM events")
def t1(t: Tables) -> DataFrame:
    from rillmark.functions.time import epoch_ms
    from rillmark.streaming.eventtime import with_event_time

    raw = t.events.select("event_id", epoch_ms("ts").alias("ms"))
    timed = with_event_time(raw, ms="ms", delay="2 seconds")
    return timed.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("t4_late_replay", f"SELECT event_id, window_start, window_end, arrival_class FROM ({CLASSIFIED})")
def t4(t: Tables) -> DataFrame:
    return classified(t).select("event_id", "window_start", "window_end", "arrival_class")


@query("t4_late_counts", f"""
    SELECT event_type, window_start, window_end, count(*) AS cnt,
           count(*) FILTER (arrival_class = 'on_time') AS first_cnt, count(*) FILTER (arrival_class = 'refire') AS updates
    FROM ({CLASSIFIED}) WHERE arrival_class <> 'late' GROUP BY ALL""")
def t4_counts(t: Tables) -> DataFrame:
    return late.late_window_counts(classified(t), key="event_type")


@query("t5_late_side", f"SELECT event_id, user_id, ts FROM ({CLASSIFIED}) WHERE arrival_class = 'late'")
def t5(t: Tables) -> DataFrame:
    return late.late_rows(classified(t)).select("event_id", "user_id", "ts")


@query("t6_late_window_text", as_text(f"""
    SELECT user_id, window_start, window_end, count(*) AS cnt FROM ({CLASSIFIED})
    WHERE arrival_class <> 'late' GROUP BY ALL""", "CAST(user_id AS VARCHAR)"))
def t6(t: Tables) -> DataFrame:
    counts = late.late_window_counts(classified(t), key="user_id")
    label = F.col("user_id").cast("string")
    return counts.select(window_text(label, "cnt", "window_start", "window_end").alias("line"))


@query("t7_timer_firings", "SELECT DISTINCT user_id, ts + INTERVAL '10 hours' AS fires_at FROM events")
def t7(t: Tables) -> DataFrame:
    return late.timer_firings(t.events, key="user_id", ts="ts", after="10 hours")


# Per-key state.


@query("st1_prev_event", """
    SELECT event_id, user_id, event_type, coalesce(lag(event_id) OVER w, -1) AS prev_event_id, lag(event_type) OVER w AS prev_event_type
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def st1(t: Tables) -> DataFrame:
    narrow = t.events.select("event_id", "user_id", "event_type")
    seen = state.previous_event(narrow, key="user_id", order="event_id", keep=["event_id", "event_type"])
    return seen.fillna({"prev_event_id": -1})


@query("st2_history_len", """
    SELECT event_id, user_id, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS history_len FROM events""")
def st2(t: Tables) -> DataFrame:
    return state.history_length(t.events.select("event_id", "user_id"), key="user_id", order="event_id")


@query("st2_recent_history", """
    SELECT event_id, user_id, array_to_string(list(event_type) OVER (
        PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), ',') AS history FROM events""")
def st2_recent(t: Tables) -> DataFrame:
    narrow = t.events.select("event_id", "user_id", "event_type")
    found = state.recent_history(narrow, key="user_id", order="event_id", value="event_type", length=5)
    return found.select("event_id", "user_id", F.concat_ws(",", "history").alias("history"))


@query("st5_prev_with_ttl", """
    SELECT event_id, user_id,
           CASE WHEN lag(ts) OVER w + INTERVAL '10 hours' > ts THEN lag(event_type) OVER w END AS prev_event_type
    FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)""")
def st5(t: Tables) -> DataFrame:
    narrow = t.events.select("event_id", "user_id", "ts", "event_type")
    seen = state.previous_with_ttl(
        narrow, key="user_id", order="event_id", ts="ts", value="event_type", ttl="10 hours"
    )
    return seen.select("event_id", "user_id", "prev_event_type")


# Patterns.


@query("c1_consecutive_next", """
    SELECT user_id, a AS first_id, b AS second_id, c AS third_id FROM (
        SELECT user_id, event_type AS x, lead(event_type) OVER w AS y, lead(event_type, 2) OVER w AS z,
               event_id AS a, lead(event_id) OVER w AS b, lead(event_id, 2) OVER w AS c
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    WHERE x = 'error' AND y = 'error' AND z = 'error'""")
def c1(t: Tables) -> DataFrame:
    fail = F.col("event_type") == "error"
    found = patterns.strict_sequence(
        t.events.select("user_id", "event_id", "event_type"),
        key="user_id",
        order="event_id",
        steps=[("first", fail), ("second", fail), ("third", fail)],
        keep=["event_id"],
    )
    return found.select("user_id", *[F.col(f"{s}.event_id").alias(f"{s}_id") for s in ("first", "second", "third")])


@query("c2_consecutive_times", """
    SELECT user_id, array_to_string(list_slice(ids, n - 2, n), ',') AS ids FROM (
        SELECT user_id, list(event_id) OVER g AS ids, row_number() OVER g AS n FROM (
            SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id)
                    - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS island FROM events)
        WHERE event_type = 'error'
        WINDOW g AS (PARTITION BY user_id, island ORDER BY event_id))
    WHERE n >= 3""")
def c2(t: Tables) -> DataFrame:
    found = patterns.consecutive_times(
        t.events.select("user_id", "event_id", "event_type"),
        key="user_id",
        order="event_id",
        condition=F.col("event_type") == "error",
        times=3,
        value="event_id",
    )
    return found.select("user_id", F.concat_ws(",", F.col("values").cast("array<string>")).alias("ids"))


FOLLOWED = """
    SELECT user_id, event_id, start_ts, CASE WHEN nxt < start_ts + INTERVAL '24 hours' THEN nxt END AS end_ts,
           CASE WHEN nxt < start_ts + INTERVAL '24 hours' THEN 'matched' ELSE 'timeout' END AS status
    FROM (SELECT user_id, event_id, event_type, ts AS start_ts,
                 min(CASE WHEN event_type = 'purchase' THEN ts END) OVER (
                     PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS nxt
          FROM events) WHERE event_type = 'signup'"""


def followed(t: Tables) -> DataFrame:
    return patterns.followed_by_within(
        t.events.select("user_id", "event_id", "event_type", "ts"),
        key="user_id",
        order="event_id",
        ts="ts",
        first=F.col("event_type") == "signup",
        second=F.col("event_type") == "purchase",
        within="24 hours",
        keep="event_id",
    )


@query("c3_followed_by_within", FOLLOWED)
def c3(t: Tables) -> DataFrame:
    return followed(t)


@query("c4_pattern_timeouts", f"SELECT user_id, event_id, start_ts FROM ({FOLLOWED}) WHERE status = 'timeout'")
def c4(t: Tables) -> DataFrame:
    return followed(t).filter(F.col("status") == "timeout").select("user_id", "event_id", "start_ts")
