"""Event sequences per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.columns import Names, names
from rillmark.operators.ordered import Running, with_row_frames, with_running
from rillmark.operators.windows import interval


def strict_sequence(
    df: DataFrame,
    *,
    key: Names,
    order: Names,
    steps: list[tuple[str, Column]],
    keep: Names,
    slice_rows: int | None = None,
) -> DataFrame:
    """Adjacent records of a key that satisfy the steps one by one; matches may overlap.

    ``steps`` are (label, condition). A match is one row: the key and, for each label, a
    struct of the kept columns.
    """
    record = F.struct(*names(keep)).alias("record")
    tests = df.withColumns({f"_is{i}": cond for i, (_, cond) in enumerate(steps)}).withColumn("_record", record)
    columns = {label: (lambda w, i=i: F.lead("_record", i).over(w)) for i, (label, _) in enumerate(steps)}
    columns |= {
        f"_ok{i}": (lambda w, i=i: F.lead(f"_is{i}", i).over(w)) for i in range(1, len(steps))
    }
    found = with_row_frames(
        tests, keys=key, order=order, after=len(steps) - 1, columns=columns, slice_rows=slice_rows
    )
    holds = reduce(lambda a, b: a & b, [F.col("_is0"), *[F.col(f"_ok{i}") for i in range(1, len(steps))]])
    return found.filter(holds).select(*names(key), *[label for label, _ in steps])


def consecutive_times(
    df: DataFrame,
    *,
    key: Names,
    order: Names,
    condition: Column,
    times: int,
    value: str,
    slice_rows: int | None = None,
) -> DataFrame:
    """One match for each record that ends a run of ``times`` adjacent fitting records.

    ``values`` lists the kept value of the run, oldest first.
    """

    def run(w):
        return w.rowsBetween(-(times - 1), 0)

    found = with_row_frames(
        df.withColumn("_is", condition),
        keys=key,
        order=order,
        before=times - 1,
        columns={
            "_fit": lambda w: F.count_if(F.col("_is")).over(run(w)),
            "values": lambda w: F.collect_list(value).over(run(w)),
        },
        slice_rows=slice_rows,
    )
    return found.filter(F.col("_fit") == times).select(*names(key), "values")


def followed_by_within(
    df: DataFrame,
    *,
    key: Names,
    order: Names,
    ts: str,
    first: Column,
    second: Column,
    within: str,
    keep: Names,
    slice_rows: int | None = None,
) -> DataFrame:
    """Each ``first`` record with the key's next ``second`` record less than ``within`` later.

    Others in between are skipped. Without one the status is ``timeout`` and ``end_ts`` null.
    """
    tagged = df.withColumns({"_first": first, "_second": second}).filter(F.col("_first") | F.col("_second"))
    # Backwards in order, the smallest second record so far is the next one.
    place = F.when(F.col("_second"), F.struct(*names(order), F.col(ts).alias("at")))
    found = with_running(
        tagged,
        keys=key,
        order=order,
        reverse=True,
        exclusive=True,
        measures={"_next": Running("min", place)},
        slice_rows=slice_rows,
    )
    in_time = F.col("_next.at") < F.col(ts) + interval(within)
    end = F.when(in_time, F.col("_next.at"))
    return found.filter("_first").select(
        *names(key),
        *names(keep),
        F.col(ts).alias("start_ts"),
        end.alias("end_ts"),
        F.when(in_time, "matched").otherwise("timeout").alias("status"),
    )
