"""Bills of two sources that come as streams, matched micro-batch by micro-batch."""

from __future__ import annotations

import json
import uuid

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.columns import micros
from rillmark.operators.joins import reconcile

SIDES = {"app": True, "third": False}


class BillCheck:
    """A ``foreachBatch`` sink for ``both_sides`` that runs ``reconcile`` on what is new and what may still find a partner.

    Both sides wait ``wait`` longer than the watermark, the lower one of the two sides. A pair is told in the batch that brings
    the later one of the two; a bill of the third party without a partner once the watermark has passed it, one of the app
    once it has passed the wait as well. So rows are joined by shuffles of narrow files, and none is looked up in a state store one by one.
    Bills that come too late are left out and lie in ``late``. All tables are written per batch id, so a
    replayed batch replaces its own output. A bill without a time has no partner and is told at once.
    """

    def __init__(self, folder: str, schema: T.StructType, *, key: str, ts: str, wait: str, delay_ms: int) -> None:
        self.folder, self.key, self.ts, self.wait, self.delay_us = folder.rstrip("/"), key, ts, wait, delay_ms * 1000
        self.schema = T.StructType([schema[key], schema[ts], T.StructField("is_app", T.BooleanType())])
        self.fs, self.path = pafs.FileSystem.from_uri(self.folder)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        marks = self._marks(batch_id - 1)
        before = self._watermark(marks)
        at = micros(df, self.ts)
        late = F.lit(False) if before is None else F.coalesce(at <= F.lit(before), F.lit(False))
        tagged = df.select(*self.schema.fieldNames(), late.alias("late"))
        tagged.write.mode("overwrite").partitionBy("late").parquet(f"{self.folder}/came/batch={batch_id}")
        new = self._came(spark, batch_id).filter("NOT late").drop("late")
        latest = {r["is_app"]: r["us"] for r in new.groupBy("is_app").agg(F.max(at).alias("us")).collect()}
        for name, is_app in SIDES.items():
            marks[name] = max((x for x in (marks[name], latest.get(is_app)) if x is not None), default=None)
        self._set_marks(batch_id, marks)
        now = self._watermark(marks)

        rows = new.withColumn("new", F.lit(True))
        if batch_id > 0:
            held = spark.read.schema(self.schema).parquet(f"{self.folder}/held/batch={batch_id - 1}")
            rows = rows.unionByName(held.withColumn("new", F.lit(False)))
        sides = [rows.filter(F.col("is_app") == is_app).drop("is_app") for is_app in SIDES.values()]
        found = reconcile(*sides, key=self.key, ts=self.ts, wait=self.wait, keep="new")
        told = (
            F.when(F.col("status") == "match", F.col("app_new") | F.col("third_new"))
            .when(F.col("status") == "third_missing", self._over("app", self._until(found, "app_ts"), before, now))
            .otherwise(self._over("third", micros(found, "third_ts"), before, now))
        )
        found.filter(told).drop("app_new", "third_new").write.mode("overwrite").parquet(f"{self.folder}/sent/batch={batch_id}")
        waits = F.col(self.ts).isNotNull() if now is None else self._until(rows, self.ts) > F.lit(now)
        rows.filter(waits).drop("new").write.mode("overwrite").parquet(f"{self.folder}/held/batch={batch_id}")

    def _until(self, df: DataFrame, ts: str) -> Column:
        return F.unix_micros(F.col(ts).cast("timestamp") + F.expr(f"interval {self.wait}"))

    @staticmethod
    def _over(side: str, at: Column, before: int | None, now: int | None) -> Column:
        """Whether the watermark has come to a time with this batch; what has no time is over as it comes."""
        passed = F.lit(False) if now is None else at <= F.lit(now)
        passed = passed if before is None else passed & (at > F.lit(before))
        return F.when(at.isNull(), F.col(f"{side}_new")).otherwise(passed)

    def _watermark(self, marks: dict[str, int | None]) -> int | None:
        return None if None in marks.values() else min(marks.values()) - self.delay_us

    def _came(self, spark: SparkSession, batch_id: int) -> DataFrame:
        # read with its partition column, as a side without rows has no folder
        whole = T.StructType([*self.schema.fields, T.StructField("late", T.BooleanType())])
        return spark.read.schema(whole).parquet(f"{self.folder}/came/batch={batch_id}")

    def _marks(self, batch_id: int) -> dict[str, int | None]:
        """The largest time of each side up to a batch."""
        found = self.fs.get_file_info(f"{self.path}/marks/{batch_id}.json")
        if not found.is_file:
            return dict.fromkeys(SIDES)
        with self.fs.open_input_file(found.path) as source:
            return json.loads(source.read())

    def _set_marks(self, batch_id: int, marks: dict[str, int | None]) -> None:
        self.fs.create_dir(f"{self.path}/marks", recursive=True)
        draft = f"{self.path}/marks/.{batch_id}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as out:
            out.write(json.dumps(marks).encode())
        self.fs.move(draft, f"{self.path}/marks/{batch_id}.json")

    def sent(self, spark: SparkSession) -> DataFrame:
        """All bills told so far."""
        return spark.read.parquet(f"{self.folder}/sent").drop("batch")

    def late(self, spark: SparkSession) -> DataFrame:
        whole = T.StructType([*self.schema.fields, *[T.StructField(c, k) for c, k in (("late", T.BooleanType()), ("batch", T.IntegerType()))]])
        return spark.read.schema(whole).parquet(f"{self.folder}/came").filter("late").drop("late", "batch")


def both_sides(app: DataFrame, third: DataFrame) -> DataFrame:
    """The bills of both sources as one stream; ``is_app`` tells which is which."""
    return app.withColumn("is_app", F.lit(True)).unionByName(third.withColumn("is_app", F.lit(False)))
