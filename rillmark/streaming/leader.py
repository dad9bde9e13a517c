"""The key with the highest running count of a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.columns import Names, names
from rillmark.operators.ranking import rank_within


def counts_with_last(df: DataFrame, *, key: str, order: str) -> DataFrame:
    """Count per key and the place of its last record; run it in update mode."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("cnt"), F.max(order).alias("at"))


class LeaderSink:
    """A ``foreachBatch`` sink for ``counts_with_last`` that keeps the leader after each batch.

    Counts only grow, so the leader is the larger of the last one and this batch's changed
    keys; on a tie the newer wins. One row per batch id is written; a replay rewrites it.
    """

    def __init__(self, folder: str, key: str) -> None:
        self.folder, self.key = folder, key

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        best = F.max(F.struct("cnt", "at", F.col(self.key).alias("leader"))).alias("top")
        now = df.agg(best)
        if batch_id > 0:
            # the batch before carries the leader of all
            before = spark.read.schema(now.schema).parquet(f"{self.folder}/batch={batch_id - 1}")
            now = now.unionByName(before).agg(F.max("top").alias("top"))
        now.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def leaders(self, spark: SparkSession) -> DataFrame:
        """The leader after each batch."""
        return spark.read.parquet(self.folder).select("batch", "top.leader", "top.cnt")


class TopOfWindows:
    """A ``foreachBatch`` sink that ranks the keys of each window of an append-mode stream of counts.

    In append mode a window's counts all come in the micro-batch in which the watermark passes its end. So the
    ranking of that batch is final: each task keeps ``n`` rows per window before they are shuffled, and no list of
    a window's keys is made. One table per batch id is written; a replay rewrites it.
    """

    def __init__(self, folder: str, *, by: str, tie: str, n: int, descending: bool = True) -> None:
        self.folder, self.by, self.tie, self.n, self.descending = folder, by, tie, n, descending

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        top = rank_within(df, group=["window_start", "window_end"], by=self.by, tie=self.tie, n=self.n, descending=self.descending)
        top.write.mode("overwrite").parquet(f"{self.folder}/batch={batch_id}")

    def ranked(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.folder).drop("batch")


def stream_top_overall(counts: DataFrame, *, by: str, tie: Names, n: int) -> DataFrame:
    """The ``n`` largest counts of a stream; run it in complete mode."""
    return counts.orderBy(F.col(by).desc(), *[F.col(c).asc() for c in names(tie)]).limit(n)
