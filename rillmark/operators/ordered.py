"""Ordered computation per key that stays parallel when one key holds most rows.

A plain ``OVER (PARTITION BY key ORDER BY t)`` sorts every row of a key in one task.
The functions here first count rows per key. Without large keys, which is the usual
case, they return exactly that plain plan. Large keys are cut into slices, contiguous
in the order; the window runs per (key, slice) and what has to cross a slice border is
carried over by a small second step:

* row frames of fixed reach need only the few rows next to each border;
* running aggregates need one total per slice.

With no key at all (one order over the whole table) slices are always used.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from rillmark.columns import Names, micros, names
from rillmark.session import shared_folder

# Rows one task should sort at most; a larger key is cut.
SLICE_ROWS_CONF = "spark.rillmark.sliceRows"
SLICE_ROWS = 4_000_000
# Passed as ``slice_rows`` where the keys are known to be small: no count is made.
KNOWN_SMALL = sys.maxsize
# Hash buckets that tell which keys may be large, and how many large ones a condition names.
KEY_BUCKETS, NAMED_BUCKETS = 65_536, 1000
# A table of at most this many rows is small enough to be copied to every executor.
BROADCAST_ROWS = 100_000


@dataclass(frozen=True)
class Slices:
    """A DataFrame with slice columns, and a bound on the number of slices of cut keys.

    ``where`` holds for the rows of all keys that were cut, and few others; None stands for all rows.
    """

    df: DataFrame
    columns: list[str]
    count: int
    where: Column | None = None


def written(df: DataFrame, purpose: str) -> DataFrame:
    """A step as a table in the shared folder, so that what follows, or runs again, doesn't compute it anew."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def slice_rows_of(df: DataFrame, slice_rows: int | None) -> int:
    if slice_rows is not None:
        return slice_rows
    return int(df.sparkSession.conf.get(SLICE_ROWS_CONF, str(SLICE_ROWS)))


def check_keys(df: DataFrame, keys: Names, slice_rows: int | None = None) -> int:
    """The ``slice_rows`` to use after one count per key: ``KNOWN_SMALL`` if none is large.

    An operator of several ordered steps asks once, on the narrow input, not at each step.
    """
    limit = slice_rows_of(df, slice_rows)
    if limit == KNOWN_SMALL:
        return limit
    where = may_be_large(df, keys, limit)
    if where is None:
        return KNOWN_SMALL
    large = df.filter(where).groupBy(*names(keys)).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    return KNOWN_SMALL if large.isEmpty() else limit


def may_be_large(df: DataFrame, keys: Names, limit: int) -> Column | None:
    """A condition that holds for all rows of keys with more than ``limit`` rows; None if there is no such key.

    Rows are counted per hash bucket, so tasks hand on a bounded number of counts, however many keys there are. A key
    is no larger than its bucket; only keys of large buckets have to be counted by themselves.
    """
    bucket = F.pmod(F.xxhash64(*names(keys)), F.lit(KEY_BUCKETS))
    sizes = df.groupBy(bucket.alias("_b")).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
    large = [r["_b"] for r in sizes.limit(NAMED_BUCKETS + 1).collect()]
    if not large:
        return None
    return F.lit(True) if len(large) > NAMED_BUCKETS else bucket.isin(large)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether a side table is short enough to copy everywhere; reads no further than the bound."""
    return df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS


def small(df: DataFrame, rows: int) -> DataFrame:
    """Hint a broadcast only where the row count is known and small; else Spark decides."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def same(
    left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]], exact: list[tuple[str, str]] | None = None
) -> Column:
    """Null-safe equality of column pairs, and plain equality of those never null."""
    tests = [left[a].eqNullSafe(right[b]) for a, b in pairs]
    tests += [left[a] == right[b] for a, b in exact or []]
    return reduce(lambda a, b: a & b, tests)


def cut(df: DataFrame, keys: Names | None, order: Names, slice_rows: int | None = None) -> Slices:
    """Add slice columns that cut each key with more than ``slice_rows`` rows.

    Each round counts the rows of every (key, slice) and lays an even grid over those
    that are too large, along the first order column that varies inside them. Rounds
    repeat until nothing is too large; each parts every large slice, so they end. Only
    rows that agree in every order column cannot be parted. A table may be cut again
    along another order; its slice columns get names of their own. Counts are exact, so a re-run task cuts alike.
    Order columns hold timestamps or whole numbers, never null.
    """
    keys, order = names(keys), names(order)
    limit = slice_rows_of(df, slice_rows)
    if limit == KNOWN_SMALL:
        return Slices(df, [], 0)
    places = [micros(df, c) for c in order]
    slices: list[str] = []
    total = 0
    where = may_be_large(df, keys, limit) if keys else F.lit(True)
    if where is None:
        # the usual case, and the only count there is
        return Slices(df, [], 0)
    while True:
        group = keys + slices
        grids = _grids(df.filter(where), group, places, limit)
        taken = {c.lower() for c in df.columns}
        name = next(n for i in count() if (n := f"_slice{i}") not in taken)
        if group:
            cells = grids.agg(F.sum("_cells")).first()[0]
            if not cells:
                break
            total += cells
            # Written once, so that later rounds don't count anew; its size decides how it is joined.
            grids = written(grids, "grids")
            df = _with_cell(df, grids, group, places, name)
        else:
            # No key: one grid, and a lower limit from here on, so that every task gets a share.
            one = grids.first()
            if one is None:
                break
            total += one["_cells"]
            limit = one["_limit"]
            df = df.withColumn(name, F.call_function("div", _wide(places[one["_by"]]) - F.lit(one["_lo"]), F.lit(one["_step"])))
        slices.append(name)
    return Slices(df, slices, total, where if keys else None)


def _wide(place: Column) -> Column:
    """A place whose differences cannot overflow, as those of hashes could."""
    return place.cast("decimal(20,0)")


def _grids(df: DataFrame, group: list[str], places: list[Column], limit: int) -> DataFrame:
    """One row per group above the limit: which order column to cut, from where, how wide."""
    order = range(len(places))
    size = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.min(places[i]).alias(f"_lo{i}") for i in order],
        *[F.max(places[i]).alias(f"_hi{i}") for i in order],
    )
    if group:
        size = size.withColumn("_limit", F.lit(limit).cast("bigint"))
    else:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        share = F.least(F.lit(limit).cast("bigint"), F.ceil(F.col("_n") / F.lit(tasks)))
        size = size.withColumn("_limit", F.greatest(F.lit(1).cast("bigint"), share))
    by = F.coalesce(*[F.when(F.col(f"_lo{i}") < F.col(f"_hi{i}"), F.lit(i)) for i in order])
    lo, hi = (F.coalesce(*[F.when(F.col("_by") == i, F.col(f"_{s}{i}")) for i in order]) for s in ("lo", "hi"))
    return (
        size.withColumn("_by", by)
        .filter((F.col("_n") > F.col("_limit")) & F.col("_by").isNotNull())
        .withColumn("_cells", F.ceil(F.col("_n") * 2 / F.col("_limit")))
        .withColumns({"_lo": _wide(lo), "_hi": _wide(hi)})
        .select(
            *[F.col(c).alias(f"_g_{c}") for c in group],
            "_by",
            "_lo",
            F.expr("CAST(floor((_hi - _lo) / _cells) AS DECIMAL(20,0)) + 1").cast("decimal(20,0)").alias("_step"),
            "_cells",
            "_limit",
        )
    )


def _with_cell(df: DataFrame, grids: DataFrame, group: list[str], places: list[Column], name: str) -> DataFrame:
    """Number each row's cell in its group's grid; groups without a grid are one cell."""
    place = F.coalesce(*[F.when(F.col("_by") == i, p) for i, p in enumerate(places)])
    return (
        df.join(grids, same(df, grids, [(c, f"_g_{c}") for c in group]), "left")
        .withColumn("_at", _wide(place) - F.col("_lo"))
        .withColumn(name, F.coalesce(F.expr("_at div _step"), F.lit(0).cast("bigint")))
        .drop("_at", "_by", "_lo", "_step", "_cells", "_limit", *[f"_g_{c}" for c in group])
    )


def _sorted(order: list[str], reverse: bool) -> list[Column]:
    return [F.col(c).desc() if reverse else F.col(c).asc() for c in order]


def with_row_frames(
    df: DataFrame,
    *,
    keys: Names | None,
    order: Names,
    columns: dict[str, Callable[[WindowSpec], Column]],
    before: int = 0,
    after: int = 0,
    slice_rows: int | None = None,
    sliced: Slices | None = None,
) -> DataFrame:
    """Add window expressions that look at most ``before`` rows back and ``after`` ahead.

    ``columns`` maps a name to a function of the ordered window, such as
    ``lambda w: F.lag("ts").over(w)``. A table that was cut already, before other steps,
    comes in as ``sliced``, by slices along the same order, and keeps its slice columns.
    """
    keys, order = names(keys), names(order)
    given = sliced is not None
    sliced = sliced or cut(df, keys, order, slice_rows)
    df = sliced.df
    if not sliced.columns:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({n: f(w) for n, f in columns.items()})
    w = Window.partitionBy(*keys, *sliced.columns).orderBy(*order)
    one = F.lit(1)

    def near_border(back: int, ahead: int) -> Column:
        """Whether fewer rows than that lie before or after the row in its slice."""
        near = F.lit(False)
        near = near | F.lag(one, back).over(w).isNull() if back else near
        return near | F.lead(one, ahead).over(w).isNull() if ahead else near

    # Rows at a border need rows of the next slice; those reach no further than this.
    reach = before + after
    marked = df.withColumns({"_border": near_border(before, after), "_near": near_border(reach, reach)})
    inside = marked.withColumns({n: f(w) for n, f in columns.items()}).filter(~F.col("_border"))
    across = Window.partitionBy(*keys).orderBy(*sliced.columns, *order)
    border = (
        marked.filter("_near").withColumns({n: f(across) for n, f in columns.items()}).filter("_border")
    )
    return inside.unionByName(border).drop("_border", "_near", *([] if given else sliced.columns))


@dataclass(frozen=True)
class Running:
    """A running aggregate: ``kind`` is count, sum, max, min or first (in the order)."""

    kind: str
    column: Column

    def local(self) -> Column:
        if self.kind == "first":
            return F.first(self.column)
        return {"count": F.count, "sum": F.sum, "max": F.max, "min": F.min}[self.kind](self.column)

    def total(self, order: list[str], reverse: bool) -> Column:
        if self.kind == "first":
            pick = F.max_by if reverse else F.min_by
            return pick(F.struct(self.column.alias("v")), F.struct(*order))
        return self.local()

    def carried(self, name: str) -> Column:
        if self.kind == "first":
            return F.first(name, ignorenulls=True)
        return {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}[self.kind](name)

    def joined(self, carried: Column, local: Column) -> Column:
        if self.kind == "first":
            return F.when(carried.isNotNull(), carried["v"]).otherwise(local)
        if self.kind in ("count", "sum"):
            return F.when(carried.isNull(), local).when(local.isNull(), carried).otherwise(carried + local)
        return (F.greatest if self.kind == "max" else F.least)(carried, local)


def with_running(
    df: DataFrame,
    *,
    keys: Names | None,
    order: Names,
    measures: dict[str, Running],
    reverse: bool = False,
    exclusive: bool = False,
    slice_rows: int | None = None,
    sliced: Slices | None = None,
) -> DataFrame:
    """Add aggregates over all rows of the key up to the current one.

    ``reverse`` runs from the last row backwards; ``exclusive`` leaves out the current
    row. The order must be total, so that the answer does not depend on chance. For
    ``sliced`` see ``with_row_frames``.
    """
    keys, order = names(keys), names(order)
    given = sliced is not None
    sliced = sliced or cut(df, keys, order, slice_rows)
    df = sliced.df
    end = -1 if exclusive else 0
    w = (
        Window.partitionBy(*keys, *sliced.columns)
        .orderBy(*_sorted(order, reverse))
        .rowsBetween(Window.unboundedPreceding, end)
    )
    if not sliced.columns:
        if not keys:
            w = Window.partitionBy(F.lit(0)).orderBy(*_sorted(order, reverse)).rowsBetween(Window.unboundedPreceding, end)
        return df.withColumns({n: m.local().over(w) for n, m in measures.items()})
    group = keys + sliced.columns
    # a key that was not cut has nothing to carry
    summed = sliced.df if sliced.where is None else sliced.df.filter(sliced.where)
    totals = summed.groupBy(*group).agg(
        *[m.total(order, reverse).alias(f"_t_{n}") for n, m in measures.items()]
    )
    # One row per slice: the order over slices is short, also where there is no key.
    over_slices = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(*_sorted(sliced.columns, reverse))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    any_carry = reduce(lambda a, b: a | b, [F.col(f"_c_{n}").isNotNull() for n in measures])
    carry = (
        totals.withColumns({f"_c_{n}": m.carried(f"_t_{n}").over(over_slices) for n, m in measures.items()})
        .filter(any_carry)
        .select(*[F.col(c).alias(f"_k_{c}") for c in group], *[f"_c_{n}" for n in measures])
    )
    local = sliced.df.withColumns({f"_l_{n}": m.local().over(w) for n, m in measures.items()})
    # Slice numbers are never null; on plain equality a sort-merge join keeps the window's partitioning.
    on = same(local, carry, [(c, f"_k_{c}") for c in keys], exact=[(c, f"_k_{c}") for c in sliced.columns])
    both = local.join(small(carry, sliced.count), on, "left")
    done = both.withColumns(
        {n: m.joined(F.col(f"_c_{n}"), F.col(f"_l_{n}")) for n, m in measures.items()}
    )
    return done.drop(
        *([] if given else sliced.columns),
        *[f"_k_{c}" for c in group],
        *[f"_{p}_{n}" for n in measures for p in ("c", "l")],
    )


def with_position(
    df: DataFrame, *, keys: Names | None, order: Names, name: str = "position", slice_rows: int | None = None
) -> DataFrame:
    """Number the rows of each key 1, 2, 3, ... in the order."""
    return with_running(
        df, keys=keys, order=order, measures={name: Running("count", F.lit(1))}, slice_rows=slice_rows
    )
