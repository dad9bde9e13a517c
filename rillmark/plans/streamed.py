"""Streaming forms, fed with the given tables as files that arrive one after the other, and drained to their end.

Each table comes in five lots of arrival time, one per micro-batch, with events out of order by up to 72 minutes. So
watermarks, state and lateness pass from batch to batch. An append-mode stream sends a window once the watermark has
passed it. As input that ends closes everything still open, a closing record far in the future comes as the last lot:
it moves the watermark past every window, pair and timer, and is left out of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.columns import Names, names
from rillmark.functions.aggregate import Mergeable
from rillmark.operators import aggregates, joins, patterns, project, state, windows
from rillmark.operators.ordered import with_row_frames
from rillmark.plans.catalog import Tables, bucket, query
from rillmark.plans.records import WORDS, lines
from rillmark.plans.stateful import FOLLOWED, RULED, typed
from rillmark.plans.windowed import POSITIONED, REPORTS, cumulated, hopped, ranked, tumbled
from rillmark.sinks.writers import append_stream, fan_out, merge_batch, to_text_files
from rillmark.sources import readers
from rillmark.sources.lots import lots_stream, write_lots
from rillmark.streaming.alarms import AlarmSink
from rillmark.streaming.bills import BillCheck, both_sides
from rillmark.streaming.eventtime import with_event_time, with_watermark
from rillmark.streaming.late import LateSplitter
from rillmark.streaming.live import LiveCounts
from rillmark.streaming.leader import LeaderSink, TopOfWindows, counts_with_last, stream_top_overall
from rillmark.streaming.rules import RulesInForce, rules_and_actions
from rillmark.streaming.totals import TotalsInTurn
from rillmark.streaming.turns import InTurn, Step, Turn
from rillmark.streaming.run import drain, drain_added, drain_appended, drain_complete, drain_each, drain_updated

DELAY = "2 hours"
DELAY_MS = 7_200_000
DAY_MS = 86_400_000
#: Key of the closing record.
CLOSING = -1


#: Times of the tables that come as lots.
TIMES = {"events": "ts", "orders": "o_orderdate", "lineitem": "l_shipdate"}
#: Columns that their streams use, where those are few of many.
COLUMNS = {"orders": ["o_orderkey", "o_orderdate"], "lineitem": ["l_orderkey", "l_shipdate"]}
LOTS = 5
#: Rows of a lot that one file, and so one task, is to hold, and the most files of a lot.
FILE_ROWS, LOT_FILES = 100_000, 64
#: Folders of lots that are there already, by application, folder and table.
_WRITTEN: dict[tuple[str, str, str], tuple[str, int]] = {}


def disorder(name: str) -> Column:
    """How many microseconds after its time a record arrives."""
    return (F.col("event_id") % 7) * 720_000_000 if name == "events" else F.lit(0)


def lot_files(rows: int) -> int:
    """How many files each lot of a table is to have, so that its micro-batch is read in parallel."""
    return max(1, min(LOT_FILES, rows // (LOTS * FILE_ROWS)))


def bill_span(t: Tables) -> tuple[int, int]:
    """First and last time of orders and line items, which are to arrive side by side."""
    ends = [t.table(n).agg(F.min(c).alias("a"), F.max(c).alias("b")) for n, c in TIMES.items() if n != "events"]
    span = ends[0].unionByName(ends[1]).agg(F.min("a").alias("a"), F.max("b").alias("b"))
    row = span.select(*[F.unix_micros(F.col(c).cast("timestamp")).alias(c) for c in "ab"]).first()
    return row["a"] or 0, row["b"] or 0


def stream(t: Tables, name: str, close: bool = False) -> DataFrame:
    """A table as a stream of lots by its time, the closing record last; one without a time as a stream of its files."""
    table = t.table(name).select(*COLUMNS.get(name, ["*"]))
    if name not in TIMES:
        # as a pattern the path may name a single file as well as a folder of files; a plain path must be a folder
        files = -(-len(table.inputFiles()) // LOTS)
        return t.spark.readStream.schema(table.schema).option("maxFilesPerTrigger", max(1, files)).parquet(f"{t.folder}/{name}.parque[t]")
    key = (t.spark.sparkContext.applicationId, t.folder, name)
    if key not in _WRITTEN:
        folder, files = t.scratch(f"lots-{name}"), lot_files(table.count())
        span = None if name == "events" else bill_span(t)
        write_lots(table, folder, ts=TIMES[name], lots=LOTS, delay=disorder(name), width_us=span, files=files)
        end_of(t, name).select(*table.columns).write.mode("append").parquet(folder)
        _WRITTEN[key] = folder, files
    folder, files = _WRITTEN[key]
    lots = lots_stream(t.spark, folder, table.schema, files)
    return lots if close else lots.filter(~is_end(name))


def is_end(name: str) -> Column:
    return {"events": F.col("user_id") == CLOSING, "orders": F.col("o_orderkey").isNull(), "lineitem": F.col("l_orderkey").isNull()}[name]


def end_of(t: Tables, name: str) -> DataFrame:
    """The closing record, years after all others of the table; columns that don't tell it are null."""
    table, ts = t.table(name), TIMES[name]
    values = {"user_id": CLOSING, "event_type": "end", "event_id": 2**62} if name == "events" else {}
    end = table.agg((F.max(ts) + F.expr("interval 2000 days")).alias("end"))
    columns = [F.col("end") if f.name == ts else F.lit(values.get(f.name)) for f in table.schema]
    return end.select(*[c.cast(f.dataType).alias(f.name) for c, f in zip(columns, table.schema)])


def events(t: Tables, delay: str = DELAY, lateness: str | None = None) -> DataFrame:
    return with_watermark(stream(t, "events", close=True), ts="ts", delay=delay, **({"lateness": lateness} if lateness else {}))


def typed_stream(t: Tables, kind: str, close: bool = False) -> DataFrame:
    both = stream(t, "events", close=close)
    chosen = both.filter((F.col("event_type") == kind) | (F.col("user_id") == CLOSING))
    return with_watermark(chosen.select("user_id", "ts", "event_id"), ts="ts", delay=DELAY)


def local(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the SQL has them."""
    stamps = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in stamps})


@query("a3_stream_word_count", f"SELECT word, count(*) AS n FROM ({WORDS}) GROUP BY word")
def a3(t: Tables) -> DataFrame:
    words = project.tokenize(stream(t, "documents"), "text")
    return drain_added(words, lambda rows: aggregates.count_by(rows, "word", "n"), ["word"], ["n"], buckets=32)


@query("w11_stream_tumble", tumbled("event_type", "1 hour"))
def w11(t: Tables) -> DataFrame:
    return local(drain_appended(windows.tumble(events(t), ts="ts", size="1 hour", key="event_type")))


@query("w3_stream_hop", hopped("user_id", 10, 2))
def w3(t: Tables) -> DataFrame:
    return local(
        drain_appended(windows.hop(events(t), ts="ts", size="10 hours", slide="2 hours", key="user_id"))
    )


@query("w18_stream_cumulate", cumulated("event_type"))
def w18(t: Tables) -> DataFrame:
    measures = {"cnt": Mergeable("count", F.lit(1)), "top_value": Mergeable("max", F.col("value"))}
    found = windows.cumulate(
        events(t), ts="ts", size="10 hours", step="2 hours", key="event_type", measures=measures
    )
    return local(drain_appended(found))


@query("w4_stream_session", """
        SELECT user_id, min(ts) AS window_start, max(ts) + INTERVAL '6 hours' AS window_end, count(*) AS cnt FROM (
            SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session_no FROM (
                SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL '6 hours'
                                         THEN 0 ELSE 1 END AS fresh FROM events))
        GROUP BY user_id, session_no""")
def w4(t: Tables) -> DataFrame:
    return local(drain_appended(windows.session(events(t), ts="ts", gap="6 hours", key="user_id")))


@query("w7_stream_pv_uv", f"""
    SELECT {bucket('12 hours')} AS window_start, {bucket('12 hours')} + INTERVAL '12 hours' AS window_end,
           count(*) AS pv, count(DISTINCT user_id) AS uv, count(*)::DOUBLE / count(DISTINCT user_id) AS pv_per_uv
    FROM events GROUP BY ALL""")
def w7(t: Tables) -> DataFrame:
    return local(drain_appended(windows.pv_uv(events(t), ts="ts", size="12 hours", user="user_id")))


@query("w13_stream_topn", ranked(hopped("user_id", 10, 5), "cnt DESC, user_id", 2))
def w13(t: Tables) -> DataFrame:
    folder = t.scratch("window-top")
    top = TopOfWindows(f"{folder}/out", by="cnt", tie="user_id", n=2)
    counts = windows.hop(events(t), ts="ts", size="10 hours", slide="5 hours", key="user_id", panes=False)
    drain(append_stream(counts).foreachBatch(top), f"{folder}/checkpoint")
    return local(top.ranked(t.spark))


# Events arrive in three lots: nine of ten up to the middle, nine of ten after it, and at last every tenth.
LATE_LOTS = """
    SELECT *, CASE WHEN event_id % 10 = 0 THEN 2 WHEN ts < (SELECT min(ts) + (max(ts) - min(ts)) / 2 FROM events) THEN 0 ELSE 1 END AS lot
    FROM events"""
SIDES = f"""
    WITH lots AS ({LATE_LOTS}), marks AS (
        SELECT l.lot, (SELECT max(ts) - INTERVAL '2 hours' FROM lots e WHERE e.lot < l.lot) AS mark FROM (VALUES (0), (1), (2)) l(lot))
    SELECT event_id, user_id, lot, {bucket('1 hour')} AS window_start,
           CASE WHEN {bucket('1 hour')} + INTERVAL '2 hours' <= mark THEN 'late' ELSE 'in_time' END AS side
    FROM lots JOIN marks USING (lot)"""


def late_lots(t: Tables) -> DataFrame:
    """The stream of the three lots, of which the last comes late."""
    key = (t.spark.sparkContext.applicationId, t.folder, "late events")
    if key not in _WRITTEN:
        folder = t.scratch("late-lots")
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        span = t.events.agg(F.min(us).alias("first"), F.max(us).alias("last")).first()
        middle = (span["first"] + span["last"]) // 2 if span["first"] is not None else 0
        lots = t.events.withColumn("lot", F.when(F.col("event_id") % 10 == 0, 2).when(us < middle, 0).otherwise(1))
        for k in range(3):
            lots.filter(F.col("lot") == k).drop("lot").coalesce(1).write.mode("append").parquet(folder)
        _WRITTEN[key] = folder, 1
    return lots_stream(t.spark, _WRITTEN[key][0], t.events.schema)


@query("t5_stream_late_split", f"SELECT event_id, side FROM ({SIDES})")
def t5(t: Tables) -> DataFrame:
    """Hourly windows that take late rows for another hour; rows later than that go to a table of their own."""
    folder = t.scratch("late-split")
    close = F.window("ts", "1 hour")["end"] + F.expr("interval 1 hour")
    split = LateSplitter(folder, ts="ts", close=close, delay_ms=DELAY_MS)
    drain(late_lots(t).writeStream.foreachBatch(split), f"{folder}/checkpoint")
    in_time = split.in_time(t.spark).select("event_id", F.lit("in_time").alias("side"))
    return in_time.unionByName(split.late(t.spark).select("event_id", F.lit("late").alias("side")))


def live_counts(t: Tables) -> LiveCounts:
    folder = t.scratch("live-counts")
    counts = LiveCounts(
        t.spark, folder, t.events.schema, key="user_id", ts="ts", size="1 hour", delay_ms=DELAY_MS, lateness_ms=3_600_000
    )
    drain(late_lots(t).writeStream.foreachBatch(counts), f"{folder}/checkpoint")
    return counts


@query("t4_stream_lateness", f"""
    SELECT lot AS batch, user_id, window_start, CAST(sum(n) OVER (PARTITION BY user_id, window_start ORDER BY lot) AS BIGINT) AS cnt
    FROM (SELECT lot, user_id, window_start, count(*) AS n FROM ({SIDES}) WHERE side = 'in_time' GROUP BY ALL)""")
def t4(t: Tables) -> DataFrame:
    """Every update of a window's count, as it stood after the batch that brought it."""
    updates = live_counts(t).updates(t.spark)
    return local(updates.select("batch", "user_id", "window_start", "cnt"))


@query("t6_stream_late_counts", f"""
    SELECT user_id, window_start, count(*) FILTER (side = 'in_time') AS cnt, count(*) FILTER (side = 'late') AS late_cnt
    FROM ({SIDES}) GROUP BY user_id, window_start""")
def t6(t: Tables) -> DataFrame:
    """Counts that a running stream has updated, next to the number of rows that came too late for their window."""
    counts = live_counts(t)
    late = windows.tumble(counts.late(t.spark), ts="ts", size="1 hour", key="user_id").withColumnRenamed("cnt", "late_cnt")
    both = counts.counts.read().join(late, ["user_id", "window_start", "window_end"], "full")
    zero = F.lit(0).cast("bigint")
    return local(both.select("user_id", "window_start", F.coalesce("cnt", zero).alias("cnt"), F.coalesce("late_cnt", zero).alias("late_cnt")))


@query("j4_stream_window_join", f"""
    SELECT user_id, w AS window_start, w + INTERVAL '1 day' AS window_end,
           l.ts AS left_ts, l.event_id AS left_event_id, r.ts AS right_ts, r.event_id AS right_event_id
    FROM {typed('click')} l JOIN {typed('purchase')} r USING (user_id, w)""")
def j4(t: Tables) -> DataFrame:
    pairs = joins.window_join(
        typed_stream(t, "click"), typed_stream(t, "purchase"), key="user_id", ts="ts", size="1 day"
    )
    return local(drain_appended(pairs))


@query("j1_stream_union", f"""
    SELECT user_id, {bucket('1 hour')} AS window_start, {bucket('1 hour')} + INTERVAL '1 hour' AS window_end, count(*) AS cnt
    FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL""")
def j1(t: Tables) -> DataFrame:
    """Two streams of different bounds as one: the slower watermark rules, so a row within its side's bound is never late."""
    sides = [
        with_watermark(stream(t, "events", close=True).filter(F.col("event_type").isin(kind, "end")), ts="ts", delay=delay)
        for kind, delay in (("click", DELAY), ("view", "5 hours"))
    ]
    return local(drain_appended(windows.tumble(joins.union_all(*sides), ts="ts", size="1 hour", key="user_id")))


def bills(t: Tables, name: str, key: str, ts: str) -> DataFrame:
    return stream(t, name, close=True).select(F.col(key).alias("id"), F.col(ts).cast("timestamp").alias("ts"))


BILLS = """
    SELECT coalesce(o_orderkey, l_orderkey) AS id, o_orderdate AS app_ts, l_shipdate AS third_ts,
           CASE WHEN l_orderkey IS NULL THEN 'third_missing' WHEN o_orderkey IS NULL THEN 'app_missing' ELSE 'match' END AS status
    FROM orders FULL JOIN lineitem ON o_orderkey = l_orderkey
     AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL '30 days'"""


def checked_bills(t: Tables) -> DataFrame:
    """Bills without a partner follow as the watermark passes them; the closing records, without an id, are no bills."""
    app, third = bills(t, "orders", "o_orderkey", "o_orderdate"), bills(t, "lineitem", "l_orderkey", "l_shipdate")
    both = both_sides(app, third)
    folder = t.scratch("bills")
    check = BillCheck(folder, both.schema, key="id", ts="ts", wait="30 days", delay_ms=DAY_MS)
    drain(both.writeStream.foreachBatch(check), f"{folder}/checkpoint")
    return local(check.sent(t.spark)).filter("id IS NOT NULL")


@query("j3_stream_bill_check", BILLS)
def j3(t: Tables) -> DataFrame:
    return checked_bills(t)


@query("j2_stream_fan_out", """
    SELECT event_id, user_id, CASE event_type WHEN 'click' THEN 'click' WHEN 'view' THEN 'view' ELSE 'other' END AS channel
    FROM events""")
def j2(t: Tables) -> DataFrame:
    folder = t.scratch("channels")
    tags = [(c, F.col("event_type") == c) for c in ("click", "view")]
    routed = joins.route(stream(t, "events").select("event_id", "user_id", "event_type"), tags)
    channels = ("click", "view", "other")
    drain_each(routed, fan_out({c: merge_batch(f"{folder}/{c}") for c in channels}))
    read = [t.spark.read.parquet(f"{folder}/{c}").withColumn("channel", F.lit(c)) for c in channels]
    return joins.union_all(*read).select("event_id", "user_id", "channel")


@query("k2_stream_text_files", "SELECT event_type || ' ' || CAST(event_id AS VARCHAR) AS value FROM events")
def k2(t: Tables) -> DataFrame:
    path = t.scratch("text-stream")
    text = stream(t, "events").select(F.concat_ws(" ", "event_type", F.col("event_id").cast("string")).alias("value"))
    drain(to_text_files(text, f"{path}/out"), f"{path}/checkpoint")
    return t.spark.read.text(f"{path}/out")


@query("j5_stream_window_counts", f"""
    SELECT user_id, {bucket('1 day')} AS window_start, {bucket('1 day')} + INTERVAL '1 day' AS window_end,
           count(*) FILTER (event_type = 'click') AS left_n, count(*) FILTER (event_type = 'purchase') AS right_n
    FROM events WHERE event_type IN ('click', 'purchase') GROUP BY ALL""")
def j5(t: Tables) -> DataFrame:
    counts = [F.count_if(F.col("side") == s).alias(f"{s}_n") for s in ("left", "right")]
    found = joins.window_aggregate(
        typed_stream(t, "click", close=True),
        typed_stream(t, "purchase", close=True),
        key="user_id",
        ts="ts",
        size="1 day",
        aggs=counts,
    )
    return local(drain_appended(found))


@query("j6_stream_interval_join", """
    SELECT l.user_id, l.ts AS left_ts, l.event_id AS left_event_id, r.ts AS right_ts, r.event_id AS right_event_id
    FROM (SELECT * FROM events WHERE event_type = 'purchase') l
    JOIN (SELECT * FROM events WHERE event_type = 'click') r
    ON l.user_id = r.user_id AND r.ts BETWEEN l.ts - INTERVAL '2 hours' AND l.ts + INTERVAL '3 hours'""")
def j6(t: Tables) -> DataFrame:
    pairs = joins.interval_join(
        typed_stream(t, "purchase"),
        typed_stream(t, "click"),
        key="user_id",
        ts="ts",
        lower_ms=-7_200_000,
        upper_ms=10_800_000,
    )
    return local(drain_appended(pairs))


ORDER = ["ts", "event_id"]


def in_turn(t: Tables, step: Step, keep: Names = (), reach: int = 1, carry: Step | None = None) -> DataFrame:
    """What a step sends for the events of each user in turn, without the closing record."""
    events_of = stream(t, "events", close=True).select("user_id", "ts", "event_id", *names(keep))
    folder = t.scratch("turns")
    sink = InTurn(
        t.spark, folder, events_of.schema, key="user_id", ts="ts", seq="event_id", delay_ms=DELAY_MS, step=step, reach=reach, carry=carry
    )
    drain(events_of.writeStream.foreachBatch(sink), f"{folder}/checkpoint")
    return sink.sent(t.spark).filter(F.col("user_id") != CLOSING).drop("batch")


@query("st1_stream_prev", f"""
    SELECT user_id, event_id, event_type, coalesce(lag(event_type) OVER (PARTITION BY user_id ORDER BY event_id), '-') AS previous
    FROM events""")
def st1(t: Tables) -> DataFrame:
    def step(rows: DataFrame, turn: Turn) -> DataFrame:
        seen = state.previous_event(rows, key="user_id", order=ORDER, keep="event_type", slice_rows=turn.slice_rows).filter("_new")
        return seen.select("user_id", "event_id", "event_type", F.coalesce("prev_event_type", F.lit("-")).alias("previous"))

    return in_turn(t, step, "event_type")


@query("j7_stream_rule_match", RULED)
def j7(t: Tables) -> DataFrame:
    """Every signup brings a rule that governs all later actions; rules and actions come as one stream each."""
    folder = t.scratch("rules")
    waits = F.when(F.col("event_id") % 2 == 0, "click").otherwise("purchase")
    came = stream(t, "events").filter("event_type = 'signup'").select("event_id", "ts", F.lit("view").alias("action1"), waits.alias("action2"))
    actions = stream(t, "events", close=True).select("user_id", "ts", "event_id", "event_type")
    both = rules_and_actions(actions, came, key="user_id")
    sink = RulesInForce(t.spark, folder, both.schema, key="user_id", ts="ts", seq="event_id", action="event_type", delay_ms=DELAY_MS)
    drain(both.writeStream.foreachBatch(sink), f"{folder}/checkpoint")
    return sink.sent(t.spark).select("user_id", "event_id", "event_type", "action1", "action2")


@query("st2_stream_history", f"""
    SELECT event_id, user_id, array_to_string(list(event_type) OVER (
        PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 4 PRECEDING AND CURRENT ROW), ',') AS history FROM events""")
def st2(t: Tables) -> DataFrame:
    def step(rows: DataFrame, turn: Turn) -> DataFrame:
        seen = state.recent_history(
            rows, key="user_id", order=ORDER, value="event_type", length=5, slice_rows=turn.slice_rows
        ).filter("_new")
        return seen.select("event_id", "user_id", F.concat_ws(",", "history").alias("history"))

    return in_turn(t, step, "event_type", reach=4)


@query("c1_stream_consecutive", f"""
    SELECT user_id, array_to_string([a, b, c], ',') AS ids FROM (
        SELECT user_id, event_type AS x, lead(event_type) OVER w AS y, lead(event_type, 2) OVER w AS z,
               event_id AS a, lead(event_id) OVER w AS b, lead(event_id, 2) OVER w AS c
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id))
    WHERE x = 'error' AND y = 'error' AND z = 'error'""")
def c1(t: Tables) -> DataFrame:
    steps = [(name, F.col("event_type") == "error") for name in ("first", "second", "third")]

    def step(rows: DataFrame, turn: Turn) -> DataFrame:
        found = patterns.strict_sequence(
            rows, key="user_id", order=ORDER, steps=steps, keep=["event_id", "_new"], slice_rows=turn.slice_rows
        )
        ids = [F.col(f"{name}.event_id").cast("string") for name, _ in steps]
        return found.filter("third._new").select("user_id", F.concat_ws(",", *ids).alias("ids"))

    return in_turn(t, step, "event_type", reach=2)


@query("c3_stream_followed", f"""
    SELECT user_id, event_id, epoch_us(start_ts) AS start_us, coalesce(epoch_us(end_ts), -1) AS end_us, status
    FROM ({FOLLOWED})""")
def c3(t: Tables) -> DataFrame:
    """An open signup is carried from batch to batch until a purchase comes or the watermark ends its wait."""
    day_us = 24 * 3_600_000_000
    signup, purchase = F.col("event_type") == "signup", F.col("event_type") == "purchase"

    def decided(rows: DataFrame, turn: Turn) -> DataFrame:
        return patterns.followed_by_within(
            rows, key="user_id", order=ORDER, ts="ts", first=signup, second=purchase, within="24 hours",
            keep=["event_id", "position"], slice_rows=turn.slice_rows,
        )

    def over(watermark: int) -> Column:
        return F.unix_micros(F.col("start_ts").cast("timestamp")) + day_us <= F.lit(watermark)

    def step(rows: DataFrame, turn: Turn) -> DataFrame:
        found = decided(rows, turn).filter((F.col("status") == "matched") | over(turn.watermark))
        us = [F.unix_micros(F.col(f"{c}_ts").cast("timestamp")).alias(f"{c}_us") for c in ("start", "end")]
        return found.select("user_id", "event_id", us[0], F.coalesce(us[1], F.lit(-1).cast("bigint")).alias("end_us"), "status")

    def carry(rows: DataFrame, turn: Turn) -> DataFrame:
        still = decided(rows, turn).filter((F.col("status") == "timeout") & ~over(turn.watermark))
        return still.select("user_id", F.col("start_ts").alias("ts"), "event_id", F.lit("signup").alias("event_type"), "position")

    return in_turn(t, step, "event_type", carry=carry)


@query("a10_stream_count_trigger", f"""
    SELECT user_id, CAST(sum(us) FILTER (slot < 5) // 5 AS BIGINT) AS avg_value FROM (
        SELECT user_id, epoch_us(ts) AS us, (rn - 1) // 6 AS round, (rn - 1) % 6 AS slot
        FROM ({POSITIONED}))
    GROUP BY user_id, round HAVING count(*) = 6""")
def a10(t: Tables) -> DataFrame:
    def step(rows: DataFrame, turn: Turn) -> DataFrame:
        timed = rows.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
        return aggregates.nth_avg_at(timed, key="user_id", position="position", value="us", size=5).drop("round")

    return in_turn(t, step, reach=5)


@query("w5_stream_count_window", f"""
    SELECT user_id, (rn - 1) // 10 AS window_no, min(event_id) AS first_seq, max(event_id) AS last_seq,
           CAST(sum(epoch_us(ts)) AS BIGINT) AS total
    FROM ({POSITIONED}) GROUP BY ALL HAVING count(*) = 10""")
def w5(t: Tables) -> DataFrame:
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    aggs = [F.min("event_id").alias("first_seq"), F.max("event_id").alias("last_seq"), F.sum(us).alias("total")]
    return in_turn(t, lambda rows, _: windows.count_window_at(rows, key="user_id", position="position", size=10, aggs=aggs), reach=9)


@query("o1_stream_recent_avg", f"""
    SELECT user_id, event_id AS seq, CAST(sum(epoch_us(ts)) OVER w // count(*) OVER w AS BIGINT) AS recent_avg FROM events
    WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""")
def o1(t: Tables) -> DataFrame:
    def step(rows: DataFrame, turn: Turn) -> DataFrame:
        us = F.unix_micros(F.col("ts").cast("timestamp"))
        seen = aggregates.recent_avg(rows, key="user_id", order=ORDER, value=us, before=5, slice_rows=turn.slice_rows).filter("_new")
        return seen.select("user_id", F.col("event_id").alias("seq"), "recent_avg")

    return in_turn(t, step, reach=5)


@query("a11_stream_total", REPORTS)
def a11(t: Tables) -> DataFrame:
    events_of = stream(t, "events", close=True).select("user_id", "ts", "event_id")
    folder = t.scratch("totals")
    sink = TotalsInTurn(
        t.spark, folder, events_of.schema, key="user_id", ts="ts", seq="event_id", wait_us=3 * 3_600_000_000, delay_ms=DELAY_MS
    )
    drain(events_of.writeStream.foreachBatch(sink), f"{folder}/checkpoint")
    return sink.sent(t.spark).filter(F.col("user_id") != CLOSING).drop("batch")


@query("t7_stream_timers", f"""
    SELECT DISTINCT user_id, epoch_us(ts) // 1000 + 36000000 AS time_ms FROM events""")
def t7(t: Tables) -> DataFrame:
    folder = t.scratch("alarms")
    sink = AlarmSink(folder, key="user_id", ts="ts", wait_ms=36_000_000, delay_ms=DELAY_MS)
    drain(stream(t, "events", close=True).select("user_id", "ts").writeStream.foreachBatch(sink), f"{folder}/checkpoint")
    return sink.told(t.spark).filter(F.col("kind") == "rang").select("user_id", "time_ms")


@query("a4_stream_running_count", f"""
    SELECT user_id, event_id AS seq, count(*) OVER (PARTITION BY user_id ORDER BY event_id) AS cnt FROM events""")
def a4(t: Tables) -> DataFrame:
    return in_turn(t, lambda rows, _: rows.filter("_new").select("user_id", F.col("event_id").alias("seq"), F.col("position").alias("cnt")))


@query("w5_stream_count_sliding", f"""
    SELECT user_id, position, n, CAST(total AS BIGINT) AS total FROM (
        SELECT user_id, row_number() OVER w AS position, count(*) OVER f AS n, sum(epoch_us(ts)) OVER f AS total
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id),
                           f AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW))
    WHERE position % 2 = 0""")
def w5_sliding(t: Tables) -> DataFrame:
    def step(rows: DataFrame, turn: Turn) -> DataFrame:
        frame = {
            "n": lambda w: F.count(F.lit(1)).over(w.rowsBetween(-9, 0)),
            "total": lambda w: F.sum(F.unix_micros(F.col("ts").cast("timestamp"))).over(w.rowsBetween(-9, 0)),
        }
        seen = with_row_frames(rows, keys="user_id", order=ORDER, before=9, columns=frame, slice_rows=turn.slice_rows)
        return seen.filter(F.col("_new") & (F.col("position") % 2 == 0)).select("user_id", "position", "n", "total")

    return in_turn(t, step, reach=9)


@query("a5_stream_leader", """
    SELECT user_id AS leader, cnt FROM (SELECT user_id, count(*) AS cnt, max(event_id) AS last_id FROM events GROUP BY 1)
    ORDER BY cnt DESC, last_id DESC LIMIT 1""")
def a5(t: Tables) -> DataFrame:
    folder = t.scratch("leader")
    sink = LeaderSink(f"{folder}/out", "user_id")
    counts = counts_with_last(stream(t, "events"), key="user_id", order="event_id")
    drain(counts.writeStream.outputMode("update").foreachBatch(sink), f"{folder}/checkpoint")
    led = sink.leaders(t.spark)
    return led.agg(F.max_by(F.struct("leader", "cnt"), "batch").alias("last")).select("last.leader", "last.cnt")


@query("a7_stream_max_by", """
    SELECT user_id, arg_max(event_id, {'v': value, 'o': -event_id}) AS best_id, max(value) AS best_value
    FROM events GROUP BY user_id""")
def a7(t: Tables) -> DataFrame:
    narrow = stream(t, "events").select("user_id", "event_id", "value")
    led = drain_updated(aggregates.max_by_key(narrow, key="user_id", order="event_id", value="value"), ["user_id"])
    return led.select("user_id", F.col("best.event_id").alias("best_id"), F.col("best.value").alias("best_value"))


@query("o2_stream_top2", """
    SELECT user_id, count(*) AS cnt FROM events GROUP BY user_id ORDER BY cnt DESC, user_id LIMIT 2""")
def o2(t: Tables) -> DataFrame:
    counts = aggregates.count_by(stream(t, "events"), "user_id")
    return drain_complete(stream_top_overall(counts, by="cnt", tie="user_id", n=2))


@query("k11_stream_record_counts", f"""
    SELECT '(' || event_type || ',' || CAST(count(*) AS VARCHAR) || ')' AS value FROM events
    GROUP BY event_type, {bucket('10 hours')}""")
def k11(t: Tables) -> DataFrame:
    """Text records in, window counts out as text records, each in effect once."""
    path = t.scratch("records")
    lines(t).write.text(path)
    clicks = readers.accepted(readers.parse_records(readers.text_lines(t.spark, path, stream=True)))
    timed = with_event_time(clicks, ms="timestamp", delay="2 seconds")
    counted = windows.tumble(timed, ts="ts", size="10 hours", key="url")
    merged = drain_updated(counted, ["url", "window_start", "window_end"])
    return merged.select(F.format_string("(%s,%d)", "url", "cnt").alias("value"))
