"""Union, routing and joins of event tables and streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.columns import Names, micros, names, split_window
from rillmark.functions.text import tokens
from rillmark.operators.ordered import Running, fits_broadcast, with_row_frames, with_running


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of all tables, columns matched by name. Watermarks of streams: the smallest rules."""
    return reduce(lambda a, b: a.unionByName(b), tables)


def route(df: DataFrame, channels: list[tuple[str, Column]], other: str = "other") -> DataFrame:
    """Tag each row with the first channel whose condition holds."""
    tag = reduce(lambda rest, c: F.when(c[1], F.lit(c[0])).otherwise(rest), reversed(channels), F.lit(other))
    return df.withColumn("channel", tag)


def channel(routed: DataFrame, name: str) -> DataFrame:
    """The rows of one channel."""
    return routed.filter(F.col("channel") == name).drop("channel")


def _plain(df: DataFrame, column: str) -> Column:
    """A column, freed from the event-time mark that a stream may carry only once."""
    if df.isStreaming and isinstance(df.schema[column].dataType, T.TimestampType):
        return F.timestamp_micros(F.unix_micros(column))
    return F.col(column)


def _side(df: DataFrame, keys: list[str], prefix: str) -> list[Column]:
    return [_plain(df, c).alias(f"{prefix}_{c}") for c in df.columns if c not in keys]


def window_join(left: DataFrame, right: DataFrame, *, key: Names, ts: str, size: str) -> DataFrame:
    """All pairs of rows with the same key in the same fixed window.

    Other columns come back as ``left_*`` and ``right_*``. Adaptive execution splits a
    hot (key, window) over several tasks.
    """
    keys = names(key)
    a = left.select(*keys, F.window(ts, size).alias("window"), *_side(left, keys, "left"))
    b = right.select(*keys, F.window(ts, size).alias("window"), *_side(right, keys, "right"))
    return split_window(a.join(b, [*keys, "window"]))


def window_aggregate(
    left: DataFrame, right: DataFrame, *, key: Names, ts: str, size: str, aggs: list[Column]
) -> DataFrame:
    """Aggregates over both sides of each key and window, also where one side is empty.

    ``aggs`` see the column ``side`` (``left`` or ``right``) next to the common columns.
    One shuffle of pre-aggregated rows serves both sides.
    """
    both = left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right")))
    return split_window(both.groupBy(*names(key), F.window(ts, size).alias("window")).agg(*aggs))


def window_cogroup(
    left: DataFrame,
    right: DataFrame,
    *,
    key: Names,
    ts: str,
    size: str,
    value: str,
    piece: str | None = None,
) -> DataFrame:
    """The values of both sides of each key and window as two lists in time order.

    A window comes as one row or, with ``piece``, a time span that divides it, as one row
    per span that holds values, numbered from the window's start. Choose it so that the
    rows of one key in one span fit a task. Batch and stream give the same rows.
    """
    keys = names(key)
    both = left.select(*keys, ts, value, F.lit(True).alias("_left")).unionByName(
        right.select(*keys, ts, value, F.lit(False).alias("_left"))
    )

    def listed(side: Column) -> Column:
        # collect_list skips nulls, so rows of the other side are left out.
        pair = F.when(side, F.struct(F.col(ts).alias("t"), F.col(value).alias("v")))
        return F.transform(F.sort_array(F.collect_list(pair)), lambda p: p["v"])

    lists = [listed(F.col("_left")).alias("left_list"), listed(~F.col("_left")).alias("right_list")]
    # Windows start at multiples of their size since the epoch, and pieces divide them.
    span = F.unix_micros(F.timestamp_seconds(F.lit(0)) + F.expr(f"interval {piece or size}"))

    def number(at: Column) -> Column:
        us = F.unix_micros(at.cast("timestamp"))
        return F.call_function("div", us - F.pmod(us, span), span)

    grouped = both.groupBy(*keys, F.window(ts, size).alias("window"), number(F.col(ts)).alias("_number")).agg(*lists)
    return split_window(grouped.withColumn("piece", F.col("_number") - number(F.col("window.start"))).drop("_number"))


def interval_join(
    left: DataFrame, right: DataFrame, *, key: Names, ts: str, lower_ms: int, upper_ms: int
) -> DataFrame:
    """Pairs of equal key whose right time lies in [left + lower, left + upper], ends included.

    A batch join first equates a time bucket as wide as the interval, of which a left
    row meets two at most. So a hot key is split by time and rows far apart never pair.
    A stream joins on the bare condition, from which Spark derives how long to keep rows.
    """
    keys = names(key)
    if left.isStreaming or right.isStreaming:
        a = left.select(*[F.col(k).alias(f"_{k}") for k in keys], *[F.col(c).alias(f"left_{c}") for c in left.columns if c not in keys])
        b = right.select(*keys, *[F.col(c).alias(f"right_{c}") for c in right.columns if c not in keys])
        span = F.col(f"right_{ts}").between(
            F.col(f"left_{ts}") + F.expr(f"interval {lower_ms} milliseconds"),
            F.col(f"left_{ts}") + F.expr(f"interval {upper_ms} milliseconds"),
        )
        on = reduce(lambda x, y: x & y, [F.col(f"_{k}") == F.col(k) for k in keys])
        return a.join(b, on & span).drop(*[f"_{k}" for k in keys])
    width = F.lit(max(upper_ms - lower_ms, 1) * 1000).cast("bigint")

    def bucket(at: Column) -> Column:
        return F.call_function("div", at - F.pmod(at, width), width)

    at = micros(left, ts)
    low, high = at + lower_ms * 1000, at + upper_ms * 1000
    a = left.select(
        *keys, low.alias("_low"), high.alias("_high"), *_side(left, keys, "left")
    ).withColumn("_bucket", F.explode(F.sequence(bucket(F.col("_low")), bucket(F.col("_high")))))
    b = right.select(*keys, micros(right, ts).alias("_at"), *_side(right, keys, "right")).withColumn(
        "_bucket", bucket(F.col("_at"))
    )
    pairs = a.join(b, [*keys, "_bucket"]).filter(F.col("_at").between(F.col("_low"), F.col("_high")))
    return pairs.drop("_bucket", "_low", "_high", "_at")


def reconcile(app: DataFrame, third: DataFrame, *, key: str, ts: str, wait: str, keep: Names = ()) -> DataFrame:
    """Match bills of two sources by id; the third party may follow the app by up to ``wait``.

    Gives ``match``, ``third_missing`` or ``app_missing`` as ``status``, told by which side is there, so a bill without
    a time is missing its partner whatever its side. Ids are meant to be unique per source; where one repeats, each
    fitting pair is a match. A batch join equates a time bucket as long as the wait next to the id, so an id that
    repeats very often is split by time. One join gives pairs and bills without a partner; each side is shuffled once.
    Columns to ``keep`` come back as ``app_*`` and ``third_*``.
    """
    span = F.expr(f"interval {wait}")
    kept = {s: [F.col(c).alias(f"{s}_{c}") for c in names(keep)] for s in ("app", "third")}
    a = app.select(F.col(key).alias("app_id"), F.col(ts).alias("app_ts"), *kept["app"], F.lit(True).alias("_app"))
    b = third.select(F.col(key).alias("third_id"), F.col(ts).alias("third_ts"), *kept["third"], F.lit(True).alias("_third"))
    in_time = (F.col("third_ts") >= F.col("app_ts")) & (F.col("third_ts") <= F.col("app_ts") + span)
    on = (F.col("app_id") == F.col("third_id")) & in_time
    if app.isStreaming or third.isStreaming:
        both = a.join(b, on, "full_outer")
    else:
        width = F.greatest(F.unix_micros(F.timestamp_seconds(F.lit(0)) + span), F.lit(1).cast("bigint"))

        def bucket(at: str) -> Column:
            return F.floor(F.unix_micros(F.col(at).cast("timestamp")) / width)

        # The third party's bucket is that of the app bill or the next one, so an app bill stands in both.
        twice = a.withColumn("_row", F.monotonically_increasing_id())
        twice = twice.withColumn("_bucket", F.explode(F.array(bucket("app_ts"), bucket("app_ts") + 1))).alias("x")
        once = b.withColumn("_bucket", bucket("third_ts")).alias("y")
        joined = twice.join(once, [F.col("x._bucket") == F.col("y._bucket"), on], "full").drop("_bucket")
        # a bill of the third party came once, so what it found is final; an app bill is alone if neither of its two found any
        found = joined.filter("_third").drop("_row")
        none = joined.filter("_third IS NULL").groupBy("_row").agg(
            F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in a.columns]
        )
        both = found.unionByName(none.filter("_n = 2").drop("_row", "_n"), allowMissingColumns=True)
    status = F.when(F.col("_third").isNull(), "third_missing").when(F.col("_app").isNull(), "app_missing").otherwise("match")
    more = [f"{s}_{c}" for s in ("app", "third") for c in names(keep)]
    return both.select(F.coalesce("app_id", "third_id").alias(key), "app_ts", "third_ts", status.alias("status"), *more)


def latest_rule(rules: DataFrame, order: str) -> DataFrame:
    """The rule that came last; it replaces all earlier ones."""
    return rules.orderBy(F.col(order).desc()).limit(1)


def match_rules(
    actions: DataFrame,
    rules: DataFrame,
    *,
    key: Names,
    order: Names,
    action: str,
    slice_rows: int | None = None,
) -> DataFrame:
    """Actions that, with the action before them of the same key, fulfil a rule.

    ``rules`` has ``action1`` and ``action2``. It is broadcast if its size allows.
    """
    paired = with_row_frames(
        actions,
        keys=key,
        order=order,
        before=1,
        columns={"previous": lambda w: F.lag(action).over(w)},
        slice_rows=slice_rows,
    )
    side = rules.select("action1", "action2").distinct()
    side = F.broadcast(side) if fits_broadcast(side) else side
    on = (F.col("previous") == F.col("action1")) & (F.col(action) == F.col("action2"))
    return paired.join(side, on).drop("previous")


def match_rules_in_force(
    actions: DataFrame,
    rules: DataFrame,
    *,
    key: Names,
    order: Names,
    action: str,
    keep: Names = (),
    slice_rows: int | None = None,
) -> DataFrame:
    """Actions that, with the action before them of the same key, fulfil the rule in force when they arrive.

    ``rules`` has ``action1``, ``action2`` and, as ``order``, when each came; a rule replaces all before it, also for an
    action that arrives at the same place. Rules and actions form one order, over which the last rule is carried.
    """
    order = names(order)
    columns = list(dict.fromkeys([*names(key), *order, action, *names(keep)]))
    paired = with_row_frames(
        actions.select(*columns),
        keys=key,
        order=order,
        before=1,
        columns={"previous": lambda w: F.lag(action).over(w)},
        slice_rows=slice_rows,
    )
    place = [F.col(c).alias(f"at{i}") for i, c in enumerate(order)]
    came = rules.select(*order, F.struct(*place, "action1", "action2").alias("_rule"), F.lit(0).alias("_side"))
    both = paired.withColumn("_side", F.lit(1)).unionByName(came, allowMissingColumns=True)
    ruled = with_running(both, keys=None, order=[*order, "_side"], measures={"_force": Running("max", F.col("_rule"))}, slice_rows=slice_rows)
    fits = (F.col("previous") == F.col("_force.action1")) & (F.col(action) == F.col("_force.action2"))
    return ruled.filter((F.col("_side") == 1) & fits).select(
        *columns, F.col("_force.action1").alias("action1"), F.col("_force.action2").alias("action2")
    )


def lateral_split(df: DataFrame, column: str, separator: str = "?") -> DataFrame:
    """One row per part of a text, with the part's length; empty parts at the end don't count, rows without a part vanish."""
    parts = df.withColumn("word", F.explode(tokens(column, separator)))
    return parts.withColumn("length", F.length("word").cast("bigint"))
