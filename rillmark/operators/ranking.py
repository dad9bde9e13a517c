"""Top-N within windows and overall."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rillmark.columns import Names, names


def rank_within(
    df: DataFrame,
    *,
    group: Names,
    by: str,
    tie: str,
    n: int,
    descending: bool = True,
    rank: str = "rank",
) -> DataFrame:
    """The first ``n`` rows of each group. Each task keeps its own first ``n`` before the
    shuffle, so no group is gathered."""
    first = F.col(by).desc() if descending else F.col(by).asc()
    w = Window.partitionBy(*names(group)).orderBy(first, F.col(tie).asc())
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n).withColumn(
        rank, F.col(rank).cast("bigint")
    )


def top_overall(df: DataFrame, *, by: str, tie: str, n: int) -> DataFrame:
    """The ``n`` largest rows with their rank; only ``n`` rows per task leave the scan."""
    best = df.orderBy(F.col(by).desc(), F.col(tie).asc()).limit(n)
    w = Window.partitionBy(F.lit(0)).orderBy(F.col(by).desc(), F.col(tie).asc())
    return best.withColumn("rank", F.row_number().over(w).cast("bigint"))
