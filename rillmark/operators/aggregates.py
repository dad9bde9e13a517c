"""Counts, running aggregates and count-triggered aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.columns import Names, names
from rillmark.functions.aggregate import floor_div
from rillmark.operators.ordered import (
    Running,
    Slices,
    check_keys,
    cut,
    with_position,
    with_row_frames,
    with_running,
    written,
)
from rillmark.operators.windows import interval


def count_by(df: DataFrame, key: Names, name: str = "cnt") -> DataFrame:
    """Rows per key; on a stream run it in update mode."""
    return df.groupBy(*names(key)).agg(F.count(F.lit(1)).alias(name))


def running_count(
    df: DataFrame, *, key: Names, order: Names, name: str = "cnt", slice_rows: int | None = None
) -> DataFrame:
    """After each record, how many records its key has had."""
    return with_position(df, keys=key, order=order, name=name, slice_rows=slice_rows)


def running_leader(
    df: DataFrame, *, key: str, order: str, slice_rows: int | None = None
) -> DataFrame:
    """After each record, the key with the highest count so far; the newer one on a tie."""
    # The order over all keys is cut on the narrow input, before the counts are made.
    whole = cut(df, None, order, slice_rows)
    counted = running_count(whole.df, key=key, order=order, slice_rows=check_keys(df, key, slice_rows))
    top = F.struct(F.col("cnt"), F.col(order).alias("at"), F.col(key).alias("leader"))
    led = with_running(
        counted,
        keys=None,
        order=order,
        measures={"top": Running("max", top)},
        sliced=Slices(counted, whole.columns, whole.count),
    )
    return led.select(
        *df.columns, F.col("top.leader").alias("leader"), F.col("top.cnt").alias("leader_cnt")
    )


def rolling_max(
    df: DataFrame, *, key: Names, order: Names, value: str, keep: Names, slice_rows: int | None = None
) -> DataFrame:
    """After each record, the maximum so far next to the other fields of the key's first record."""
    measures = {"max_" + value: Running("max", F.col(value))}
    measures |= {"first_" + c: Running("first", F.col(c)) for c in names(keep)}
    return with_running(df, keys=key, order=order, measures=measures, slice_rows=slice_rows)


def rolling_max_by(
    df: DataFrame, *, key: Names, order: str, value: str, slice_rows: int | None = None
) -> DataFrame:
    """After each record, the whole record with the maximum so far; the first one on a tie.

    ``order`` is a whole-number column. The record comes as the struct column ``best``.
    """
    rank = F.struct(
        F.col(value).alias("v"), (-F.col(order)).alias("o"), F.struct(*df.columns).alias("record")
    )
    led = with_running(df, keys=key, order=order, measures={"best": Running("max", rank)}, slice_rows=slice_rows)
    return led.withColumn("best", F.col("best.record"))


def max_by_key(df: DataFrame, *, key: Names, order: str, value: str) -> DataFrame:
    """The record with the maximum of each key, the first one on a tie, as the struct ``best``.

    On a stream run it in update mode: each trigger sends the keys whose record changed.
    """
    rank = F.struct(F.col(value).alias("v"), (-F.col(order)).alias("o"))
    return df.groupBy(*names(key)).agg(F.max_by(F.struct(*df.columns), rank).alias("best"))


def every_nth_avg(
    df: DataFrame, *, key: Names, order: Names, value: Column, size: int = 5, slice_rows: int | None = None
) -> DataFrame:
    """Average of ``size`` records per key, sent when the record after them arrives.

    That record triggers the result and belongs to no group. The average is a whole number.
    """
    placed = with_position(
        df.withColumn("_value", value), keys=key, order=order, name="_pos", slice_rows=slice_rows
    )
    return nth_avg_at(placed, key=key, position="_pos", value="_value", size=size)


def nth_avg_at(placed: DataFrame, *, key: Names, position: str, value: str, size: int = 5) -> DataFrame:
    """``every_nth_avg`` of rows that are numbered from 1 within their key."""
    step = F.lit(size + 1).cast("bigint")
    slot = F.pmod(F.col(position) - 1, step)
    kept = F.when(slot < size, F.col(value))
    return (
        placed.groupBy(*names(key), floor_div(F.col(position) - 1, step).alias("round"))
        .agg(
            floor_div(F.sum(kept), F.lit(size)).alias("avg_value"),
            F.count(F.lit(1)).alias("_n"),
        )
        .filter(F.col("_n") == step)
        .drop("_n")
    )


def cumulative_count(
    df: DataFrame, *, key: Names, ts: str, every: str, slice_rows: int | None = None
) -> DataFrame:
    """Count since the beginning per key, reported once for each interval with records."""
    per_interval = (
        df.groupBy(*names(key), F.window(ts, every).alias("w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*names(key), F.col("w.end").alias("reported_at"), "n")
    )
    return with_running(
        per_interval,
        keys=key,
        order="reported_at",
        measures={"total": Running("sum", F.col("n"))},
        slice_rows=slice_rows,
    )


def report_totals(
    df: DataFrame, *, key: Names, ts: str, seq: str, wait: str, slice_rows: int | None = None
) -> DataFrame:
    """Count since the beginning per key, reported ``wait`` after the first record since the last report.

    Gives the key, ``reported_at`` and ``total``. Each record knows where the next report would start if
    one started with it: at the first record later than its time and the wait. Which records do start
    one is found by pointer jumping: in round k those known so far jump 2^k reports ahead. So the number
    of rounds grows with the logarithm of a key's reports, joins are on (key, position) and therefore
    even, and a key may have any number of records. ``seq`` orders records of the same time; neither is null.
    """
    keys = names(key)
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    wait_us = F.unix_micros(F.timestamp_seconds(F.lit(0)) + interval(wait))
    rows = df.select(*keys, us.alias("_us"), F.col(seq).cast("bigint").alias("_seq"))
    placed = with_position(rows, keys=keys, order=["_us", "_seq"], name="_pos", slice_rows=slice_rows)
    records = placed.withColumn("_ask", F.lit(0))
    asks = placed.withColumns({"_us": F.col("_us") + wait_us, "_ask": F.lit(1)})
    # records of the very time of the report still count
    counted = with_running(
        records.unionByName(asks),
        keys=keys,
        order=["_us", "_ask", "_seq"],
        measures={"_total": Running("sum", (1 - F.col("_ask")).cast("bigint"))},
        slice_rows=slice_rows,
    )
    found = counted.filter("_ask = 1").select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], "_pos", "_us", "_total")
    group = [f"_k{i}" for i in range(len(keys))]
    nodes = written(found, "reports")
    # a pointer beyond the last record finds nothing
    jumps = nodes.select(*group, "_pos", (F.col("_total") + 1).alias("_to"))
    reached = nodes.filter("_pos = 1").select(*group, "_pos")
    while True:
        at = jumps.alias("j")
        ahead = reached.alias("r").join(at, _equal("r", "j", group) & (F.col("r._pos") == F.col("j._pos")))
        ahead = ahead.select(*[F.col(f"r.{g}").alias(g) for g in group], F.col("j._to").alias("_pos"))
        ahead = written(ahead.join(nodes.alias("n"), _equal(None, "n", group, ahead) & (ahead["_pos"] == F.col("n._pos")), "left_semi"), "reports")
        if ahead.isEmpty():
            break
        reached = written(reached.unionByName(ahead), "reports")
        far = jumps.alias("j").join(jumps.alias("k"), _equal("j", "k", group) & (F.col("j._to") == F.col("k._pos")))
        jumps = written(far.select(*[F.col(f"j.{g}").alias(g) for g in group], F.col("j._pos").alias("_pos"), F.col("k._to").alias("_to")), "reports")
    started = nodes.alias("n").join(reached.alias("r"), _equal("n", "r", group) & (F.col("n._pos") == F.col("r._pos")), "left_semi")
    at = F.timestamp_micros("_us")
    if dict(df.dtypes)[ts] == "timestamp_ntz":
        at = at.cast("timestamp_ntz")
    return started.select(*[F.col(g).alias(c) for g, c in zip(group, keys)], at.alias("reported_at"), F.col("_total").alias("total"))


def _equal(left: str | None, right: str, group: list[str], of: DataFrame | None = None) -> Column:
    """Null-safe equality of key columns."""
    pairs = [(of[g] if of is not None else F.col(f"{left}.{g}")).eqNullSafe(F.col(f"{right}.{g}")) for g in group]
    return reduce(lambda a, b: a & b, pairs, F.lit(True))


def recent_avg(
    df: DataFrame, *, key: Names, order: Names, value: Column, before: int = 5, slice_rows: int | None = None
) -> DataFrame:
    """Whole-number average of a value over the current row and the ``before`` rows ahead of it."""

    def average(w):
        frame = w.rowsBetween(-before, 0)
        return floor_div(F.sum("_value").over(frame), F.count("_value").over(frame))

    return with_row_frames(
        df.withColumn("_value", value),
        keys=key,
        order=order,
        before=before,
        columns={"recent_avg": average},
        slice_rows=slice_rows,
    ).drop("_value")
