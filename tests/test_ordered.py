"""Sliced plans must give exactly what one window per key gives."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillmark.operators import aggregates, ordered
from rillmark.operators.ordered import Running, cut, with_position, with_row_frames, with_running
from rillmark.session import shared_folder


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 'hot' holds over half of all rows, bunched in time; one instant holds many rows."""
    t = F.when(F.col("id") % 5 == 0, F.lit(1_000)).when(F.col("id") % 7 == 0, F.col("id") * 1_000_003)
    return spark.range(600).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).when(F.col("id") % 31 == 0, F.lit(None)).otherwise(
            F.concat(F.lit("k"), F.col("id") % 40)
        ).alias("key"),
        F.coalesce(t, F.col("id") % 97).alias("t"),
        F.col("id").alias("seq"),
        F.pmod(F.hash("id"), F.lit(50)).cast("bigint").alias("v"),
    )


def test_cut_bounds_every_slice(skewed):
    s = cut(skewed, "key", ["t", "seq"], 40)
    assert len(s.columns) >= 2
    assert s.df.groupBy("key", *s.columns).count().agg(F.max("count")).first()[0] <= 40
    assert s.df.count() == 600


def test_small_keys_keep_the_plain_plan(skewed):
    assert cut(skewed, "key", ["t", "seq"], 10_000).columns == []


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("limit", [40])
def test_frames(skewed, keys, limit):
    columns = {
        "prev2": lambda w: F.lag("v", 2).over(w),
        "next": lambda w: F.lead("seq").over(w),
        "near": lambda w: F.sum("v").over(w.rowsBetween(-2, 1)),
    }
    w = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("t", "seq")
    plain = skewed.withColumns({n: f(w) for n, f in columns.items()})
    got = with_row_frames(
        skewed, keys=keys, order=["t", "seq"], columns=columns, before=2, after=1, slice_rows=limit
    )
    assert rows(got) == rows(plain)


@pytest.mark.parametrize("keys", [["key"], []])
@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("exclusive", [False, True])
def test_running(skewed, keys, reverse, exclusive):
    value = F.when(F.col("v") % 3 > 0, F.col("v"))
    measures = {
        "n": Running("count", value),
        "s": Running("sum", value),
        "hi": Running("max", F.struct(value.alias("a"), "seq")),
        "lo": Running("min", value),
        "first": Running("first", value),
    }
    order = [F.col(c).desc() if reverse else F.col(c) for c in ("t", "seq")]
    w = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    )
    plain = skewed.withColumns({n: m.local().over(w) for n, m in measures.items()})
    got = with_running(
        skewed,
        keys=keys,
        order=["t", "seq"],
        measures=measures,
        reverse=reverse,
        exclusive=exclusive,
        slice_rows=25,
    )
    assert rows(got) == rows(plain)


def test_position(skewed):
    got = with_position(skewed, keys="key", order=["t", "seq"], slice_rows=20)
    w = Window.partitionBy("key").orderBy("t", "seq")
    plain = skewed.withColumn("position", F.row_number().over(w).cast("bigint"))
    assert rows(got) == rows(plain)


def test_side_tables_beyond_the_broadcast_bound(skewed, monkeypatch):
    monkeypatch.setattr(ordered, "BROADCAST_ROWS", 0)
    w = Window.partitionBy("key").orderBy("t", "seq")
    got = with_running(
        skewed, keys="key", order=["t", "seq"], measures={"s": Running("sum", F.col("v"))}, slice_rows=60
    )
    assert rows(got) == rows(skewed.withColumn("s", F.sum("v").over(w)))
    w = Window.partitionBy(F.lit(0)).orderBy("seq")
    got = with_running(
        skewed, keys=None, order="seq", measures={"s": Running("sum", F.col("v"))}, slice_rows=200
    )
    assert rows(got) == rows(skewed.withColumn("s", F.sum("v").over(w)))


def test_scratch_lies_in_the_shared_folder(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_hash_as_order_and_a_second_cut(skewed):
    hashed = skewed.withColumn("h", F.xxhash64("seq"))
    first = cut(hashed, "key", "h", 40)
    again = cut(first.df, None, ["t", "seq"], 40)
    assert set(first.columns).isdisjoint(again.columns)
    assert first.df.groupBy("key", *first.columns).count().agg(F.max("count")).first()[0] <= 40
    got = with_position(hashed, keys="key", order="h", slice_rows=40)
    w = Window.partitionBy("key").orderBy("h")
    assert rows(got) == rows(hashed.withColumn("position", F.row_number().over(w).cast("bigint")))


def test_leader_with_a_hot_key(spark):
    from rillmark.operators.aggregates import running_leader

    events = spark.range(300).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("key"), F.col("id").alias("t"))
    plain = running_leader(events, key="key", order="t", slice_rows=100_000)
    assert rows(running_leader(events, key="key", order="t", slice_rows=20)) == rows(plain)


@pytest.mark.parametrize("slice_rows", [None, 7])
def test_report_totals(spark, slice_rows):
    """Reports per key by hand, with ties, a hot key and a null key."""
    import random

    rnd = random.Random(9)
    data = [(k, i, rnd.randint(0, 400) * 1000) for i, k in enumerate(["hot"] * 80 + ["a", "b", None] * 15 + ["one"])]
    want = []
    for k in {d[0] for d in data}:
        times = sorted(d[2] for d in data if d[0] == k)
        at = None
        for t in times:
            if at is None or t > at:
                at = t + 20_000
                want.append((k or "-", at, sum(x <= at for x in times)))
    table = spark.createDataFrame(data, "k string, i bigint, ms bigint").withColumn("ts", F.timestamp_millis("ms"))
    found = aggregates.report_totals(table, key="k", ts="ts", seq="i", wait="20 seconds", slice_rows=slice_rows)
    assert sorted((r.k or "-", r.ms, r.total) for r in found.select("k", F.unix_millis("reported_at").alias("ms"), "total").collect()) == sorted(want)
    assert aggregates.report_totals(table.limit(0), key="k", ts="ts", seq="i", wait="1 second").count() == 0
