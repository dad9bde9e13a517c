"""Sinks that keep waiting rows in tables: alarms, totals, bills, and lots of several files."""

import pytest

from rillmark.columns import micros
from rillmark.functions.time import event_time
from rillmark.operators import aggregates, joins
from rillmark.operators.ordered import KNOWN_SMALL, cut, may_be_large, with_position
from rillmark.session import shared_folder
from rillmark.sinks.keyed import AddingSink, KeyedTable, newest
from rillmark.sources.lots import lots_stream, write_lots
from rillmark.streaming.alarms import AlarmSink
from rillmark.streaming.bills import BillCheck
from rillmark.streaming.run import drain_each
from rillmark.streaming.totals import TotalsInTurn

EVENTS = "user string, seq bigint, ms bigint"
BILLS = "id bigint, ms bigint, is_app boolean"


def timed(spark, data, columns=EVENTS):
    return spark.createDataFrame(data, columns).withColumn("ts", event_time("ms"))


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: [(x is None, x or 0) for x in r])


def test_every_lot_has_the_same_number_of_files(spark):
    folder = shared_folder(spark, "lots")
    # the second lot has one row for three files
    table = timed(spark, [("a", i, 1000 * i) for i in range(40)] + [("a", 50, 50_000)] + [("a", i, 1000 * i) for i in range(81, 120)])
    write_lots(table, folder, ts="ts", lots=3, files=3)
    seen = []
    drain_each(lots_stream(spark, folder, table.schema, 3), lambda df, k: seen.append(sorted(r["seq"] for r in df.collect())))
    assert seen == [list(range(40)), [50], list(range(81, 120))]


def test_a_merge_computes_new_rows_once(spark):
    table = KeyedTable(spark, shared_folder(spark, "keyed"), timed(spark, []).schema, "user", buckets=2)
    seen = spark.sparkContext.accumulator(0)
    source = timed(spark, [("a", 1, 0), ("b", 2, 0)])

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    table.merge(0, source.mapInArrow(count, source.schema), newest("user"))
    assert seen.value == 2
    assert rows(table.read(), "user", "seq") == [("a", 1), ("b", 2)]


def test_sums_of_a_stream_are_added_once(spark):
    table = KeyedTable(spark, shared_folder(spark, "sums"), aggregates.count_by(timed(spark, []), "user", "n").schema, "user", buckets=4)
    sink = AddingSink(table, lambda df: aggregates.count_by(df, "user", "n"), "n")
    lots = [[("a", 1, 0), ("a", 2, 0), (None, 3, 0)], [("a", 4, 0), ("b", 5, 0)], [(None, 6, 0)]]
    for k in (0, 1, 1, 2):
        sink(timed(spark, lots[k]), k)
    assert rows(table.read(), "user", "n") == [("a", 3), ("b", 1), (None, 2)]


def test_alarms_tell_when_they_were_set_and_rang(spark):
    sink = AlarmSink(shared_folder(spark, "alarms"), key="user", ts="ts", wait_ms=10_000, delay_ms=2000)
    lots = [
        [("a", 1, 1000), ("a", 2, 1000), (None, 3, 2000)],
        # the first comes too late, as the watermark of the batch before is 0; the second again asks for a time that waits
        [("b", 4, 0), ("a", 5, 1000), ("b", 6, 13_000)],
        [("b", 7, 14_500), ("b", 8, 4_000_000)],
    ]
    for k in (0, 1, 1, 2):
        sink(timed(spark, lots[k]), k)
    told = sink.told(spark)
    assert rows(told.filter("kind = 'rang'"), "user", "time_ms", "clock_ms") == [
        ("a", 11_000, 11_000), ("b", 23_000, 3_998_000), ("b", 24_500, 3_998_000), (None, 12_000, 3_998_000)
    ]
    assert rows(told.filter("kind = 'set'"), "user", "time_ms", "clock_ms") == [
        ("a", 1000, 0), ("a", 1000, None), ("a", 1000, None), ("b", 13_000, 0),
        ("b", 14_500, 11_000), ("b", 4_000_000, 11_000), (None, 2000, None),
    ]
    assert rows(sink.late(spark), "user") == [("b",)]


def test_totals_are_reported_across_batches(spark):
    data = [("a", 1, 1000), ("b", 2, 1200), ("a", 3, 4000), ("a", 4, 4001), (None, 5, 4500), ("a", 6, 9000)]
    schema = timed(spark, data).select("user", "ts", "seq").schema
    sink = TotalsInTurn(spark, shared_folder(spark, "totals"), schema, key="user", ts="ts", seq="seq", wait_us=3_000_000, delay_ms=500)
    for k, lot in enumerate([data[2:3] + data[:2], data[3:5], data[3:5], data[5:], [("end", 9, 9_000_000)]]):
        # the second batch comes twice
        sink(timed(spark, lot), k - (k > 1))
    got = sink.sent(spark).filter("user IS NULL OR user <> 'end'")
    assert rows(got, "user", "reported_us", "total") == [
        ("a", 4_000_000, 2), ("a", 7_001_000, 3), ("a", 12_000_000, 4), ("b", 4_200_000, 1), (None, 7_500_000, 1)
    ]
    # b has no event later than its report, which the watermark alone brought about
    assert rows(got.filter("user = 'b'"), "batch") == [(2,)]


@pytest.mark.parametrize("size", [2, 3, 20])
def test_bills_are_told_as_in_batch(spark, size):
    data = []
    for i in range(20):
        data.append((i, 1000 * i, True))
        if i % 3:
            data.append((i, 1000 * i + (i % 5) * 1500, False))
        if i % 7 == 0:
            data.append((i, 1000 * i + 5000, False))
            data.append((100 + i, 1000 * i, False))
    data = sorted(data, key=lambda r: r[1] + (r[0] % 3) * 400) + [(None, 9_000_000, True), (None, 9_000_000, False)]
    table = timed(spark, data, BILLS)
    check = BillCheck(shared_folder(spark, "bills"), table.schema, key="id", ts="ts", wait="4 seconds", delay_ms=1000)
    step = -(-len(data) // size)
    for k in range(size):
        check(timed(spark, data[k * step : (k + 1) * step], BILLS), k)
    sides = [table.filter(c).select("id", "ts") for c in ("is_app", "NOT is_app")]
    want = joins.reconcile(*sides, key="id", ts="ts", wait="4 seconds").filter("id IS NOT NULL")
    columns = ["id", "app_ts", "third_ts", "status"]
    assert rows(check.sent(spark).filter("id IS NOT NULL"), *columns) == rows(want, *columns)


def test_bills_too_late_or_without_time(spark):
    schema = timed(spark, [], BILLS).schema
    check = BillCheck(shared_folder(spark, "bills"), schema, key="id", ts="ts", wait="4 seconds", delay_ms=1000)
    lots = [
        [(1, 1000, True), (2, None, True), (2, None, False), (3, 20_000, True)],
        [(1, 5000, False), (4, 30_000, False)],
        # the watermark is 19 s
        [(5, 18_000, False), (3, 23_000, False), (6, 60_000, True), (6, 60_000, False)],
    ]
    for k in (0, 1, 1, 2, 2):
        check(timed(spark, lots[k], BILLS), k)
    sent = check.sent(spark).withColumns({c: micros(check.sent(spark), c) / 1_000_000 for c in ("app_ts", "third_ts")})
    assert rows(sent, "id", "app_ts", "third_ts", "status") == [
        (1, 1.0, 5.0, "match"), (2, None, None, "app_missing"), (2, None, None, "third_missing"),
        (3, 20.0, 23.0, "match"), (4, None, 30.0, "app_missing"), (6, 60.0, 60.0, "match"),
    ]
    assert rows(check.late(spark), "id") == [(5,)]


def test_only_large_buckets_are_counted_by_key(spark):
    many = timed(spark, [(f"u{i % 50}", i, i) for i in range(200)] + [("hot", i, i) for i in range(200, 260)] + [(None, i, i) for i in range(300, 340)])
    assert may_be_large(many, "user", 60) is None
    where = may_be_large(many, "user", 30)
    assert {r["user"] for r in many.filter(where).select("user").distinct().collect()} == {"hot", None}
    sliced = cut(many, "user", "seq", 30)
    assert sliced.columns and sliced.df.filter(sliced.where).count() == 100
    got = with_position(many, keys="user", order="seq", slice_rows=30)
    assert rows(got, "user", "seq", "position") == rows(with_position(many, keys="user", order="seq", slice_rows=KNOWN_SMALL), "user", "seq", "position")
