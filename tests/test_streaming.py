"""Streaming forms over several micro-batches against hand-derived or batch results."""

import time

import pytest
from pyspark.sql import functions as F

from rillmark.functions.time import event_time
from rillmark.operators import aggregates, joins, patterns, ranking, windows
from rillmark.operators.ordered import with_position, with_row_frames
from rillmark.session import shared_folder
from rillmark.sinks import writers
from rillmark.sinks.keyed import KeyedTable, added, newest
from rillmark.sources.lots import lots_stream, write_lots
from rillmark.streaming import processors as proc
from rillmark.streaming.eventtime import WatermarkLog, current_watermark, with_event_time, with_watermark
from rillmark.streaming.late import LateSplitter
from rillmark.streaming.leader import LeaderSink, TopOfWindows, counts_with_last, stream_top_overall
from rillmark.streaming.live import LiveCounts
from rillmark.streaming.rules import RulesInForce, rules_and_actions
from rillmark.streaming.run import drain, drain_appended, drain_each, drain_updated
from rillmark.streaming.turns import InTurn, Turn

FAR = 10_000_000


def files(spark, batches, columns):
    """One file per micro-batch, read in order."""
    path = shared_folder(spark, "input")
    for i, data in enumerate(batches):
        spark.createDataFrame(data, columns).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.01 * (i >= 0))
    schema = spark.createDataFrame([], columns).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def timed(spark, batches, columns, delay="0 seconds"):
    return with_event_time(files(spark, batches, columns), ms="ms", delay=delay)


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


EVENTS = "user string, seq bigint, ms bigint, kind string"


def play(spark, delay="5 seconds"):
    """Two users, disordered within the delay, over three micro-batches and a closing row."""
    kinds = ["error", "error", "error", "error", "payment", "order", "view", "click", "order", "payment"]
    data = [(f"u{i % 2}", i, i * 1000 + (i % 3) * 700 + 1000, kinds[(i * i) % 10]) for i in range(40)]
    disordered = sorted(data, key=lambda r: r[2] + (r[1] % 4) * 1100)
    batches = [disordered[i : i + 14] for i in range(0, 40, 14)] + [[("end", 99, FAR, "end")]]
    return data, timed(spark, batches, EVENTS, delay)


@pytest.fixture(scope="module")
def table(spark):
    data, _ = play(spark)
    return spark.createDataFrame(data, EVENTS).withColumn("ts", event_time("ms"))


def in_turn(spark, step, reach=1, carry=None, slice_rows=None, delay_ms=5000, play=play):
    _, stream = play(spark, "0 seconds")
    sink = InTurn(
        spark, shared_folder(spark, "turns"), stream.schema, key="user", ts="ts", seq="seq", delay_ms=delay_ms, step=step, reach=reach,
        carry=carry, slice_rows=slice_rows,
    )
    drain_each(stream, sink)
    assert sink.late(spark).count() == 0
    return sink.sent(spark).filter("user != 'end' OR user IS NULL")


ORDER = ["ts", "seq"]


def hot_play(spark, delay="5 seconds"):
    """A third of the rows on one key, nulls in value and key, four lots."""
    data = [("hot" if i % 3 == 0 else None if i % 7 == 1 else f"u{i % 5}", i, 1000 + i * 400, None if i % 4 == 0 else "ab"[i % 2]) for i in range(72)]
    disordered = sorted(data, key=lambda r: r[2] + (r[1] % 4) * 1100)
    batches = [disordered[i : i + 18] for i in range(0, 72, 18)] + [[("end", 999, FAR, "end")]]
    return data, timed(spark, batches, EVENTS, delay)


@pytest.fixture(scope="module", params=[None, 6])
def slices(request):
    """Rows a task may sort: many, or so few that keys are cut."""
    return request.param


def table_of(spark, data):
    return spark.createDataFrame(data, EVENTS).withColumn("ts", event_time("ms"))


def test_carried_rows_equal_batch(spark, slices):
    """Previous value, history, sliding average and adjacent events over hot and null keys, in many batches."""
    data, _ = hot_play(spark)
    table = table_of(spark, data)

    def step(rows_of, turn):
        frame = lambda w: w.rowsBetween(-3, 0)
        seen = with_row_frames(
            rows_of, keys="user", order=ORDER, before=3, slice_rows=turn.slice_rows,
            columns={
                "previous": lambda w: F.lag("kind").over(w),
                "history": lambda w: F.collect_list("kind").over(frame(w)),
                "recent": lambda w: F.sum(F.when(F.col("kind") == "a", F.col("ms"))).over(frame(w)),
            },
        )
        return seen.filter("_new").select("user", "seq", "previous", "history", "recent", "position")

    got = in_turn(spark, step, reach=3, slice_rows=slices, play=hot_play)
    whole = with_position(table, keys="user", order=ORDER)
    want = step(whole.withColumn("_new", F.lit(True)), Turn(0, None))
    columns = [F.coalesce("user", F.lit("-")), "seq", F.coalesce("previous", F.lit("-")), "history", F.coalesce("recent", F.lit(-1)), "position"]
    assert rows(got, *columns) == rows(want, *columns)
    assert got.count() == 72


def test_count_windows_in_turn_equal_batch(spark, slices):
    data, _ = hot_play(spark)
    table = table_of(spark, data)
    aggs = [F.min("seq").alias("first"), F.sum("ms").alias("total")]
    user = F.coalesce("user", F.lit("-"))
    got = in_turn(spark, lambda r, _: windows.count_window_at(r, key="user", position="position", size=4, aggs=aggs), reach=3, slice_rows=slices, play=hot_play)
    want = windows.count_window(table, key="user", order=ORDER, size=4, aggs=aggs)
    assert rows(got, user, "window_no", "first", "total") == rows(want, user, "window_no", "first", "total")
    got = in_turn(spark, lambda r, _: aggregates.nth_avg_at(r, key="user", position="position", value="ms", size=5), reach=5, slice_rows=slices, play=hot_play)
    want = aggregates.every_nth_avg(table, key="user", order=ORDER, value=F.col("ms"), size=5)
    assert rows(got, user, "avg_value") == rows(want, user, "avg_value") != []


def test_open_patterns_are_carried(spark, table):
    def found(rows_of, turn):
        return patterns.followed_by_within(
            rows_of, key="user", order=ORDER, ts="ts", first=F.col("kind") == "order", second=F.col("kind") == "payment",
            within="3 seconds", keep=["seq", "position"], slice_rows=turn.slice_rows,
        )

    def over(turn):
        return F.unix_micros("start_ts") + 3_000_000 <= F.lit(turn.watermark)

    def step(rows_of, turn):
        return found(rows_of, turn).filter((F.col("status") == "matched") | over(turn))

    def carry(rows_of, turn):
        still = found(rows_of, turn).filter((F.col("status") != "matched") & ~over(turn))
        return still.select("user", "seq", F.unix_millis("start_ts").alias("ms"), F.lit("order").alias("kind"), F.col("start_ts").alias("ts"), "position")

    got = in_turn(spark, step, carry=carry)
    want = patterns.followed_by_within(
        table, key="user", order=["ms", "seq"], ts="ts", first=F.col("kind") == "order",
        second=F.col("kind") == "payment", within="3 seconds", keep="seq",
    )
    columns = ("user", "seq", "status", F.coalesce(F.unix_micros("end_ts"), F.lit(-1)))
    assert rows(got, *columns) == rows(want, *columns)
    assert {r[2] for r in rows(got, *columns)} == {"matched", "timeout"}


def test_a_replayed_turn_changes_nothing(spark):
    schema = spark.createDataFrame([], EVENTS).withColumn("ts", event_time("ms")).schema
    sink = InTurn(
        spark, shared_folder(spark, "replay"), schema, key="user", ts="ts", seq="seq", delay_ms=2000,
        step=lambda r, _: r.filter("_new").select("user", "seq", "position"),
    )
    lots = [[("a", 1, 1000, "x"), ("a", 3, 4500, "x")], [("a", 2, 3000, "x"), ("a", 5, 9000, "x")], [("a", 4, 2000, "x"), ("a", 6, 20_000, "x"), ("b", 7, 30_000, "x")]]
    for k in (0, 1, 1, 2, 2):
        sink(table_of(spark, lots[k]), k)
    assert rows(sink.sent(spark), "seq", "position") == [(1, 1), (2, 2), (3, 3), (5, 4), (6, 5)]
    assert rows(sink.late(spark), "seq") == [(4,)]


def test_rules_change_while_actions_stream(spark):
    acts = [[("a", 1, 1000, "view"), ("a", 3, 3000, "click")], [("a", 4, 4000, "view"), ("a", 6, 6000, "click"), ("a", 7, 7000, "view")], [("a", 9, 9000, "pay"), ("end", 99, FAR, "x")]]
    rules = [[(2, 2000, "view", "click")], [(5, 5000, "view", "pay")], []]
    actions = files(spark, acts, EVENTS).withColumn("ts", event_time("ms")).drop("ms")
    came = files(spark, rules, "seq bigint, ms bigint, action1 string, action2 string").withColumn("ts", event_time("ms")).drop("ms")
    both = rules_and_actions(actions, came, key="user")
    sink = RulesInForce(spark, shared_folder(spark, "rules"), both.schema, key="user", ts="ts", seq="seq", action="kind", delay_ms=2500)
    drain_each(both, sink)
    # the second rule comes before the second click, so only what was in force at each action counts
    assert rows(sink.sent(spark), "seq", "action2") == [(3, "click"), (9, "pay")]


def test_keyed_table_keeps_two_versions(spark):
    from pathlib import Path

    folder = shared_folder(spark, "keyed")
    schema = spark.createDataFrame([], "k string, n bigint").schema
    table = KeyedTable(spark, folder, schema, "k", buckets=4)
    sizes = []
    for batch in range(6):
        for _ in range(2):  # each batch is replayed
            new = spark.createDataFrame([(f"k{i % 5}", batch) for i in range(5)] + [(None, 1)], schema)
            table.merge(batch, new.distinct(), added("k", "n"))
        sizes.append(sum(1 for p in Path(folder.removeprefix("file://")).rglob("*.parquet")))
    assert rows(table.read(), F.coalesce("k", F.lit("-")), "n") == [("-", 6), *[(f"k{i}", 15) for i in range(5)]]
    assert sizes[-1] == sizes[2]
    assert table.last_batch() == 5 and table.last_batch(before=5) == 4
    # an untouched bucket stays where it is
    before = table.manifest(5)
    table.merge(6, spark.createDataFrame([("k0", 1)], schema), newest("k"))
    assert sum(before[b] != at for b, at in table.manifest(6).items()) == 1
    assert rows(table.read().filter("k = 'k0'"), "n") == [(1,)]


def test_live_counts_are_seen_at_once(spark):
    folder = shared_folder(spark, "live")
    schema = spark.createDataFrame([], EVENTS).withColumn("ts", event_time("ms")).schema
    live = LiveCounts(spark, folder, schema, key="user", ts="ts", size="10 seconds", delay_ms=2000, lateness_ms=5000)
    lots = [[("a", 1, 1000, "x"), ("b", 2, 12_000, "x")], [("a", 3, 9000, "x"), ("a", 4, 30_000, "x")], [("a", 5, 9500, "x"), ("b", 6, 21_000, "x")]]
    start = F.unix_millis("window_start")
    live(table_of(spark, lots[0]), 0)
    assert rows(live.updates(spark), "batch", "user", start, "cnt") == [(0, "a", 0, 1), (0, "b", 10_000, 1)]
    for k in (1, 1, 2):
        live(table_of(spark, lots[k]), k)
    assert rows(live.updates(spark).filter("batch > 0"), "batch", "user", start, "cnt") == [
        (1, "a", 0, 2), (1, "a", 30_000, 1), (2, "b", 20_000, 1)
    ]
    assert rows(live.late(spark), "seq") == [(5,)]
    assert rows(live.counts.read(), "user", start, "cnt") == [("a", 0, 2), ("a", 30_000, 1), ("b", 10_000, 1), ("b", 20_000, 1)]


def test_lots_arrive_in_order(spark):
    folder = shared_folder(spark, "lots")
    table = table_of(spark, [("a", i, i * 1000, "x") for i in range(50)] + [("a", 99, None, "x")])
    write_lots(table, folder, ts="ts", lots=5, delay=(F.col("seq") % 3) * 2_000_000)
    seen = []
    drain_each(lots_stream(spark, folder, table.schema), lambda df, k: seen.append((k, sorted(r["seq"] for r in df.collect()))))
    assert [k for k, _ in seen] == list(range(5))
    assert sorted(x for _, some in seen for x in some) == [*range(50), 99]
    assert any(max(a[1]) > min(b[1]) for a, b in zip(seen, seen[1:]))


def test_running_total_is_reported_after_the_wait(spark):
    data = [("a", i, ms, "x") for i, ms in enumerate((1000, 1500, 3999, 4001, 9000))]
    stream = timed(spark, [data[:2], data[2:], [("end", 99, FAR, "x")]], EVENTS)
    step = proc.running_total_step(3_000_000)
    got = drain_appended(proc.in_order(stream, key="user", ts="ts", seq="seq", keep=["kind"], step=step))
    found = rows(got.filter(F.col("user") == "a"), "reported_us", "total")
    assert found == [(4_000_000, 3), (7_001_000, 4), (12_000_000, 5)]


def test_event_time_alarms_ring_once_per_time(spark):
    stream = timed(spark, [[("a", 1, 1000, "x"), ("a", 2, 1000, "x"), ("b", 3, 2000, "x")], [("end", 9, FAR, "x")]], EVENTS)
    told = drain_appended(proc.alarms(stream, key="user", ts="ts", wait_ms=10_000))
    assert rows(told.filter("kind = 'rang'"), "user", "time_ms") == [("a", 11_000), ("b", 12_000)]


def run_clocked(df, name, ready, seconds=60):
    """Run on the machine's clock until the result is there, then stop."""
    folder = shared_folder(df.sparkSession, "clocked")
    query = (
        df.writeStream.format("memory").queryName(name).outputMode("append")
        .option("checkpointLocation", folder).trigger(processingTime="500 milliseconds").start()
    )
    try:
        end = time.time() + seconds
        while time.time() < end and not ready(df.sparkSession.table(name)):
            time.sleep(0.5)
        return df.sparkSession.table(name).collect()
    finally:
        query.stop()


def test_processing_time_alarm(spark):
    stream = files(spark, [[("a", 1, 1000, "x")]], EVENTS).withColumn("ts", event_time("ms"))
    told = proc.alarms(stream, key="user", ts="ts", wait_ms=1000, event_time=False)
    found = run_clocked(told, "alarms", lambda t: t.filter("kind = 'rang'").count() > 0)
    kinds = {r["kind"]: r for r in found}
    assert kinds["rang"]["time_ms"] - kinds["set"]["time_ms"] == 1000
    assert kinds["rang"]["clock_ms"] >= kinds["rang"]["time_ms"]


def test_last_seen_lives_for_its_time(spark):
    batches = [[("a", 1, 0, "x")], [("a", 2, 0, "y")]]
    seen = proc.last_seen_with_ttl(files(spark, batches, EVENTS), key="user", seq="seq", value="kind", ttl_ms=600_000)
    found = run_clocked(seen, "alive", lambda t: t.count() == 2)
    assert sorted((r["current"], r["previous"]) for r in found) == [("x", None), ("y", "x")]
    gone = proc.last_seen_with_ttl(files(spark, batches, EVENTS), key="user", seq="seq", value="kind", ttl_ms=1)
    found = run_clocked(gone, "expired", lambda t: t.count() == 2)
    assert sorted((r["current"], r["previous"]) for r in found) == [("x", None), ("y", None)]


def test_late_rows_go_to_their_own_table(spark):
    batches = [
        [("a", 1, 1000, "x"), ("a", 2, 12_000, "x")],
        [("a", 3, 11_000, "x"), ("a", 4, 9000, "x"), ("a", 5, 30_000, "x")],
        [("a", 6, 9500, "x"), ("a", 7, 21_000, "x")],
    ]
    stream = files(spark, batches, EVENTS).withColumn("ts", event_time("ms"))
    close = F.window("ts", "10 seconds")["end"] + F.expr("interval 5 seconds")
    split = LateSplitter(shared_folder(spark, "split"), ts="ts", close=close, delay_ms=2000)
    drain_each(stream, split)
    assert rows(split.late(spark), "seq") == [(6,)]
    assert rows(split.in_time(spark), "seq") == [(1,), (2,), (3,), (4,), (5,), (7,)]
    # A replayed batch sees the same watermark and replaces its own rows.
    again = split.late(spark).drop("batch").unionByName(split.in_time(spark).filter("batch = 2").drop("batch"))
    split(spark.createDataFrame(again.collect(), again.schema), 2)
    assert rows(split.late(spark), "seq") == [(6,)] and split.in_time(spark).count() == 6


def test_lateness_updates_windows_again(spark):
    batches = [[("a", 1, 1000, "x")], [("a", 2, 14_000, "x")], [("a", 3, 9000, "x")], [("a", 4, 90_000, "x")], [("a", 5, 99_000, "x")], [("a", 6, 8000, "x")]]
    raw = files(spark, batches, EVENTS).withColumn("ts", event_time("ms"))
    kept = with_watermark(raw, ts="ts", delay="2 seconds", lateness="1 minute")
    counts = windows.tumble(kept, ts="ts", size="10 seconds", key="user")
    found = drain_updated(counts, ["user", "window_start"])
    by_start = dict(rows(found, F.unix_millis("window_start"), "cnt"))
    assert by_start[0] == 2 and by_start[10_000] == 1


def test_bill_check_on_streams(spark):
    app = [[("order1", 1000), ("order3", 4000)], [("order4", 3000), ("order2", 2000)], [("end", FAR)]]
    third = [[("order1", 3000)], [("order3", 5000), ("order9", 9000)], [("end", FAR)]]
    a, b = (timed(spark, d, "key string, ms bigint", "10 seconds") for d in (app, third))
    checked = joins.reconcile(a, b, key="key", ts="ts", wait="5 seconds")
    found = drain_appended(checked).filter(F.col("key") != "end")
    assert rows(found, "key", "status") == [
        ("order1", "match"), ("order2", "third_missing"), ("order3", "match"), ("order4", "third_missing"), ("order9", "app_missing")
    ]


def test_cogroup_lists_on_streams(spark):
    left = timed(spark, [[("a", t) for t in (1000, 3000, 7000)], [("end", FAR)]], "key string, ms bigint")
    right = timed(spark, [[("a", 2000)], [("end", FAR)]], "key string, ms bigint")
    groups = drain_appended(
        joins.window_cogroup(left, right, key="key", ts="ts", size="10 seconds", value="ms", piece="5 seconds")
    ).filter(F.col("key") != "end")
    assert rows(groups, "piece", "left_list", "right_list") == [(0, [1000, 3000], [2000]), (1, [7000], [])]


def test_union_follows_the_slower_watermark(spark):
    fast = timed(spark, [[("a", 1, 1000, "x")], [("a", 2, 50_000, "x")]], EVENTS)
    slow = timed(spark, [[("b", 3, 1500, "x")], [("b", 4, 9000, "x")]], EVENTS)
    counts = windows.tumble(joins.union_all(fast, slow), ts="ts", size="5 seconds", key="user")
    found = drain_appended(counts)
    assert rows(found, "user", F.unix_millis("window_start")) == [("a", 0), ("b", 0)]


def test_channels_fan_out(spark):
    routed = joins.route(files(spark, [[("a", 1, 1, "click")], [("b", 2, 2, "view"), ("c", 3, 3, "buy")]], EVENTS),
                         [("click", F.col("kind") == "click"), ("view", F.col("kind") == "view")])
    folder = shared_folder(spark, "channels")
    drain_each(routed, writers.fan_out({c: writers.merge_batch(f"{folder}/{c}") for c in ("click", "view", "other")}))
    for name, user in (("click", "a"), ("view", "b"), ("other", "c")):
        assert rows(spark.read.parquet(f"{folder}/{name}"), "user") == [(user,)]


def test_a_replayed_batch_takes_effect_once(spark):
    path = shared_folder(spark, "once")
    sink = writers.merge_batch(path)
    first = spark.createDataFrame([("a", 1), ("b", 1)], "k string, n bigint")
    second = spark.createDataFrame([("a", 2)], "k string, n bigint")
    for df, batch in ((first, 0), (second, 1), (second, 1)):
        sink(df, batch)
    assert spark.read.parquet(path).count() == 3


def test_leader_and_top_of_a_stream(spark):
    batches = [[("a", 1, 1, "x"), ("b", 2, 2, "x")], [("c", 3, 3, "x")], [("a", 4, 4, "x"), ("c", 5, 5, "x"), ("d", 6, 6, "x")]]
    sink = LeaderSink(shared_folder(spark, "leader"), "user")
    folder = shared_folder(spark, "leader-checkpoint")
    counts = counts_with_last(files(spark, batches, EVENTS), key="user", order="seq")
    drain(counts.writeStream.outputMode("update").foreachBatch(sink), folder)
    assert rows(sink.leaders(spark), "batch", "leader", "cnt") == [(0, "b", 1), (1, "c", 1), (2, "c", 2)]
    top = stream_top_overall(aggregates.count_by(files(spark, batches, EVENTS), "user"), by="cnt", tie="user", n=2)
    path = shared_folder(spark, "top")
    drain(top.writeStream.outputMode("complete").foreachBatch(writers.merge_batch(path)), f"{path}-checkpoint")
    assert rows(spark.read.parquet(path).filter("batch = 2"), "user", "cnt") == [("a", 2), ("c", 2)]


def test_stream_top_per_window_equals_batch(spark, table):
    _, stream = play(spark)
    top = TopOfWindows(shared_folder(spark, "top"), by="cnt", tie="kind", n=2)
    drain_each(windows.tumble(stream, ts="ts", size="10 seconds", key="kind"), top)
    got = top.ranked(spark).filter(F.col("kind") != "end")
    batch = windows.tumble(table, ts="ts", size="10 seconds", key="kind")
    want = ranking.rank_within(batch, group=["window_start", "window_end"], by="cnt", tie="kind", n=2)
    columns = (F.unix_millis("window_start"), "kind", "cnt", "rank")
    assert rows(got, *columns) == rows(want, *columns)


def test_watermark_can_be_seen(spark):
    log = WatermarkLog()
    spark.streams.addListener(log)
    try:
        stream = timed(spark, [[("a", 1, 20_000, "x")], [("a", 2, 30_000, "x")], [("a", 3, 1000, "x")]], EVENTS, "5 seconds")
        counts = windows.tumble(stream, ts="ts", size="1 second", key="user")
        query = (
            counts.writeStream.outputMode("append").format("noop")
            .option("checkpointLocation", shared_folder(spark, "watermark")).trigger(availableNow=True).start()
        )
        assert query.awaitTermination(120)
        assert current_watermark(query) == "1970-01-01T00:00:25.000Z"
        deadline = time.time() + 20
        while time.time() < deadline and not any(s[3] for s in log.seen):
            time.sleep(0.2)
        assert sum(s[3] for s in log.seen) == 1
    finally:
        spark.streams.removeListener(log)


def test_text_files_and_console_on_a_stream(spark):
    lines = files(spark, [[("a",)], [("b",)]], "value string")
    path = shared_folder(spark, "lines")
    drain(writers.to_text_files(lines, path), f"{path}-checkpoint")
    assert rows(spark.read.text(path), "value") == [("a",), ("b",)]
    shown = writers.to_console(lines, "late")
    drain(shown, shared_folder(spark, "console"))
