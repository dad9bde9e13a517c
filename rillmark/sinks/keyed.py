"""A table of one row, or a few, per key that micro-batches change in place of one another.

Rows lie in hash buckets. A batch rewrites only the buckets of the keys that it touches and then
names, in its manifest, the folder of every bucket: its own or that of an earlier batch. So a batch
shows as a whole or not at all, a replayed batch starts from the same version and ends at the same
rows, and storage follows the number of keys, not of batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.columns import Names, names

# Versions that stay: the current one and the one a replay of the last batch starts from.
KEPT_VERSIONS = 2


class KeyedTable:
    """Rows of ``schema`` per key, as they are after each batch.

    ``buckets`` should be so many that one bucket is a small file set: a batch reads and writes whole
    buckets. The bucket column is ``_bucket``.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, key: Names, buckets: int = 16) -> None:
        self.spark, self.folder, self.schema = spark, folder.rstrip("/"), schema
        self.key, self.buckets = names(key), buckets
        self.fs, self.path = pafs.FileSystem.from_uri(self.folder)

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def manifest(self, batch: int) -> dict[int, str]:
        """The folder of each bucket that has rows after a batch; before the first there is none."""
        found = self.fs.get_file_info(f"{self.path}/manifest/{batch}.json")
        if not found.is_file:
            return {}
        with self.fs.open_input_file(found.path) as source:
            return {int(b): at for b, at in json.loads(source.read()).items()}

    def last_batch(self, before: int | None = None) -> int:
        """The last batch that has a manifest (before another batch); -1 if there is none."""
        infos = self.fs.get_file_info(pafs.FileSelector(f"{self.path}/manifest", allow_not_found=True))
        done = [int(i.base_name.removesuffix(".json")) for i in infos if i.base_name.endswith(".json")]
        return max([n for n in done if before is None or n < before], default=-1)

    def read(self, batch: int | None = None, buckets: set[int] | None = None) -> DataFrame:
        """The rows after a batch, by default the last; of all buckets or some."""
        held = self.manifest(self.last_batch() if batch is None else batch)
        paths = sorted(f"{self.folder}/{at}" for b, at in held.items() if buckets is None or b in buckets)
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def merge(self, batch: int, new: DataFrame, combine: Callable[[DataFrame, DataFrame], DataFrame]) -> DataFrame:
        """Change the keys of ``new`` by ``combine(old, new)``, which gives their rows after this batch.

        ``old`` has the rows of those buckets only and also keys that are not in ``new``, which
        ``combine`` has to hand on. Gives the rows that were written. A replay of the last batch sees
        the version before it again. Rows that ``combine`` has dealt by ``_bucket`` and gives with that column aren't dealt again.
        """
        before = self.last_batch(before=batch)
        held = self.manifest(before)
        version = f"v{batch}"
        target = f"{self.folder}/{version}"
        # used several times below; a micro-batch would be computed as often
        new.write.mode("overwrite").parquet(f"{self.folder}/came")
        new = self.spark.read.schema(new.schema).parquet(f"{self.folder}/came")
        # as many numbers as there are buckets at most
        touched = {r["b"] for r in new.select(self.bucket().alias("b")).distinct().collect()}
        old = self.read(before, touched)
        after = combine(old, new)
        if "_bucket" not in after.columns:
            after = after.select(*self.schema.fieldNames()).withColumn("_bucket", self.bucket()).repartition("_bucket")
        after.write.mode("overwrite").partitionBy("_bucket").parquet(target)
        wrote = self.fs.get_file_info(pafs.FileSelector(f"{self.path}/{version}"))
        here = {int(i.base_name.split("=")[1]): f"{version}/{i.base_name}" for i in wrote if i.base_name.startswith("_bucket=")}
        # a touched bucket without rows is gone
        self._publish(batch, {b: at for b, at in held.items() if b not in touched} | here)
        self._remove_old(batch, before)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.folder}/{at}" for at in sorted(here.values())]) if here else self.read(-1)

    def _publish(self, batch: int, held: dict[int, str]) -> None:
        self.fs.create_dir(f"{self.path}/manifest", recursive=True)
        draft = f"{self.path}/manifest/.{batch}-{uuid.uuid4().hex}"
        with self.fs.open_output_stream(draft) as out:
            out.write(json.dumps(held).encode())
        self.fs.move(draft, f"{self.path}/manifest/{batch}.json")

    def _remove_old(self, batch: int, before: int) -> None:
        """Remove manifests before the last two, and bucket folders that neither of those names."""
        kept = {batch, before}
        used = {at for n in kept for at in self.manifest(n).values()}
        for info in self.fs.get_file_info(pafs.FileSelector(self.path)):
            if info.base_name.startswith("v") and info.base_name[1:].isdigit() and int(info.base_name[1:]) <= batch:
                inside = [i for i in self.fs.get_file_info(pafs.FileSelector(info.path)) if i.base_name.startswith("_bucket=")]
                left = [i for i in inside if f"{info.base_name}/{i.base_name}" in used]
                for i in inside if left else []:
                    if i not in left:
                        self.fs.delete_dir(i.path)
                if not left:
                    self.fs.delete_dir(info.path)
        for info in self.fs.get_file_info(pafs.FileSelector(f"{self.path}/manifest")):
            number = info.base_name.removesuffix(".json")
            if number.isdigit() and int(number) < before:
                self.fs.delete_file(info.path)


def newest(key: Names) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Combine by taking the new row of a key in place of the old one."""

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.join(new.select(*names(key)).distinct(), names(key), "left_anti").unionByName(new)

    return combine


def added(key: Names, sums: Names) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Combine by adding the new numbers of a key to the old ones."""

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        return old.unionByName(new).groupBy(*names(key)).agg(*[F.sum(c).alias(c) for c in names(sums)])

    return combine


class AddingSink:
    """A ``foreachBatch`` sink that adds up rows per key over the whole stream, each micro-batch by one aggregate.

    ``new`` gives the sums of one micro-batch; keys that it does not bring are not looked up one by one. A replayed batch changes nothing.
    """

    def __init__(self, table: KeyedTable, new: Callable[[DataFrame], DataFrame], sums: Names) -> None:
        self.table, self.new, self.sums = table, new, names(sums)

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        self.table.merge(batch_id, self.new(df), self._added)

    def _added(self, old: DataFrame, new: DataFrame) -> DataFrame:
        dealt = old.unionByName(new).withColumn("_bucket", self.table.bucket()).repartition("_bucket")
        # rows of a bucket lie together, so this takes no second shuffle
        return dealt.groupBy(*self.table.key, "_bucket").agg(*[F.sum(c).alias(c) for c in self.sums])


class KeyedSink:
    """A ``foreachBatch`` sink that keeps the current row of each key of an update-mode stream."""

    def __init__(self, table: KeyedTable) -> None:
        self.table = table

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        self.table.merge(batch_id, df, newest(self.table.key))
