"""Lloyd's clustering with the dimensions in shards.

The components of the vectors lie in column blocks. A round has three steps: a task adds, for the vectors of a chunk
and one column block, exact partial distances to that block's slice of the centroids; the partial distances of a chunk
meet and add up, and each vector takes the nearest centroid; then each column block sums its own components by the
number taken, which gives its slice of the next centroids. No task needs a whole vector or a whole centroid.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import stored
from rillmark.llm.ngrams import pack_numbers, unpack_numbers

#: Scaled components up to here give squared distances of 64 bits for 64 dimensions.
LARGEST = 1 << 27
BLOCKS = "chunk bigint, block int, width int, slice binary, ids array<bigint>"


def pack_signed(values: np.ndarray) -> bytes:
    """Whole numbers as bytes; small ones of either sign take few."""
    values = np.asarray(values, dtype=np.int64).reshape(-1)
    return pack_numbers(((values << 1) ^ (values >> 63)).view(np.uint64))


def unpack_signed(data: bytes, width: int) -> np.ndarray:
    values = unpack_numbers(data)
    return ((values >> np.uint64(1)).view(np.int64) ^ -(values & np.uint64(1)).view(np.int64)).reshape(-1, width)


def square_distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to the rows of c."""
    most = max(int(np.abs(x).max(initial=0)), int(np.abs(c).max(initial=0)), 1)
    if most**2 * x.shape[1] < 2**50:
        # whole numbers below 2^53 are exact as doubles, and those multiply faster
        f, g = x.astype(np.float64), c.astype(np.float64)
        return ((f * f).sum(1)[:, None] - 2 * (f @ g.T) + (g * g).sum(1)).astype(np.int64)
    return (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)


def kept_vectors(vectors: DataFrame, dims: int, id_col: str, vector_col: str) -> DataFrame:
    """(_id, _x) of the vectors that have all components, each a number."""
    rows = vectors.select(F.col(id_col).cast("bigint").alias("_id"), F.col(vector_col).cast("array<double>").alias("_x"))
    whole = F.forall("_x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.filter((F.size("_x") == dims) & F.coalesce(whole, F.lit(False)))


def column_blocks(kept: DataFrame, dims: int, shards: int, scale: int, chunk_rows: int) -> DataFrame:
    """The whole-number vectors as rows of (chunk, column block); the first block carries the ids."""
    cuts = np.linspace(0, dims, shards + 1).astype(int)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, chunk_rows):
                some = batch.slice(at, chunk_rows)
                flat = some.column(1).flatten().to_numpy(zero_copy_only=False)
                x = scaled(flat, scale).reshape(-1, dims)
                for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
                    ids = pa.array([some.column(0).to_pylist() if b == 0 else None], pa.list_(pa.int64()))
                    fields = [[chunk], [b], [hi - lo], [pack_signed(x[:, lo:hi])]]
                    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                    columns = [pa.array(v, k) for v, k in zip(fields, kinds)]
                    yield pa.RecordBatch.from_arrays([*columns, ids], names=["chunk", "block", "width", "slice", "ids"])
                chunk += 1

    return kept.mapInArrow(cut, BLOCKS)


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as whole numbers."""
    whole = np.floor(np.asarray(x, dtype=np.float64) * scale)
    if np.abs(whole).max(initial=0) > LARGEST:
        raise ValueError(f"a component times {scale} is beyond {LARGEST}; its squared distances need more than 64 bits")
    return whole.astype(np.int64)


def first_centroids(kept: DataFrame, k: int, scale: int, dims: int, seed: str) -> np.ndarray:
    """The vectors whose ids hash lowest: ``k`` rows at most come to the driver."""
    named = kept.withColumn("_hash", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("_id").cast("string")), 256))
    rows = named.filter("_hash IS NOT NULL").orderBy("_hash", "_x").limit(k).select("_x").collect()
    return scaled(np.array([r["_x"] for r in rows], dtype=np.float64), scale).reshape(-1, dims)


def assigned(blocks: DataFrame, centroids: np.ndarray, shards: int) -> DataFrame:
    """(chunk, taken, distance): for the vectors of each chunk the nearest centroid, and how far it is."""
    dims, k = centroids.shape[1], len(centroids)
    cuts = np.linspace(0, dims, shards + 1).astype(int)
    slices = [centroids[:, lo:hi] for lo, hi in zip(cuts, cuts[1:])]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, b, width, data in zip(*(batch.column(i).to_pylist() for i in range(4))):
                parts = pack_numbers(square_distances(unpack_signed(data, width), slices[b]).reshape(-1).view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array([chunk]), pa.array([parts], pa.binary())], names=["chunk", "parts"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = sum(unpack_numbers(p).view(np.int64).reshape(-1, k) for p in table.column("parts").to_pylist())
        taken = total.argmin(1)  # the first of equal ones
        far = total[np.arange(len(total)), taken]
        columns = [pa.array([key[0].as_py()], pa.int64())]
        columns += [pa.array([pack_numbers(v.astype(np.uint64))], pa.binary()) for v in (taken, far)]
        return pa.Table.from_arrays(columns, names=["chunk", "taken", "distance"])

    partial = blocks.select("chunk", "block", "width", "slice").mapInArrow(measure, "chunk bigint, parts binary")
    return partial.groupBy("chunk").applyInArrow(add, "chunk bigint, taken binary, distance binary")


def moved(blocks: DataFrame, labels: DataFrame, centroids: np.ndarray, shards: int) -> np.ndarray:
    """The next centroids. Each column block sums its own components; k * dims whole numbers come to the driver."""
    dims, k = centroids.shape[1], len(centroids)
    cuts = np.linspace(0, dims, shards + 1).astype(int)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((k, dims), dtype=np.int64)
        rows = np.zeros((shards, k), dtype=np.int64)
        for batch in batches:
            for b, width, data, taken in zip(*(batch.column(i).to_pylist() for i in range(4))):
                near, x = unpack_numbers(taken).astype(np.int64), unpack_signed(data, width)
                order = np.argsort(near, kind="stable")
                starts = np.flatnonzero(np.diff(near[order], prepend=-1))
                found = near[order][starts]
                sums[found, cuts[b] : cuts[b + 1]] += np.add.reduceat(x[order], starts)
                rows[b] += np.bincount(near, minlength=k)
        for b, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
            cluster, column = np.nonzero(np.broadcast_to(rows[b][:, None] > 0, (k, hi - lo)))
            found = [cluster, column + lo, sums[cluster, column + lo], rows[b][cluster]]
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in found], names=["cluster", "col", "s", "n"])

    parts = blocks.select("chunk", "block", "width", "slice").join(labels.select("chunk", "taken"), "chunk")
    parts = parts.select("block", "width", "slice", "taken").mapInArrow(add, "cluster bigint, col bigint, s bigint, n bigint")
    total = parts.groupBy("cluster", "col").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    out = centroids.copy()
    for r in total.select("cluster", "col", F.expr("(s - pmod(s, n)) div n").alias("v")).collect():
        out[r["cluster"], r["col"]] = r["v"]
    return out


def centroid_clusters(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = 64,
    shards: int = 4,
    seed: str = "1",
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    chunk_rows: int = 4096,
) -> DataFrame:
    """``id_col, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per vector after ``rounds`` rounds.

    Components become floor(scale * x), and all that follows is exact in whole numbers. The first centroids are the
    vectors with the lowest SHA-256 of ``seed:id``. A vector takes the nearest centroid, the smaller number on a tie;
    a centroid becomes the floor of its vectors' mean; one without vectors stays.

    * Vectors that are null, of another length, or that hold a null, a NaN or an infinity are left out.
    * A null id never gives a first centroid; its vector is clustered. Rows that repeat an id count each for itself.
    * With fewer vectors than ``k`` there are fewer clusters; an empty table gives an empty result.
    * A component beyond 2^27 after scaling raises an error, as distances would no longer fit 64 bits.
    * Other columns are ignored. The driver holds k * dims numbers, each task a chunk of one column block.
    """
    spark = vectors.sparkSession
    schema = f"`{id_col}` bigint, cluster int, distance bigint, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    kept = kept_vectors(vectors, dims, id_col, vector_col)
    centroids = first_centroids(kept, k, scale, dims, seed)
    if not len(centroids):
        return spark.createDataFrame([], schema)
    blocks = stored(column_blocks(kept, dims, shards, scale, chunk_rows), "column-blocks")
    for _ in range(rounds):
        centroids = moved(blocks, stored(assigned(blocks, centroids, shards), "labels"), centroids, shards)
    labels = stored(assigned(blocks, centroids, shards), "labels")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, int] = {}
        for batch in batches:
            for taken, far in zip(*(batch.column(i).to_pylist() for i in range(2))):
                near, d = unpack_numbers(taken).astype(np.int64), unpack_numbers(far).astype(np.int64)
                for c in np.unique(near).tolist():
                    total[c] = total.get(c, 0) + int(d[near == c].sum())
        yield pa.RecordBatch.from_pydict({"cluster": pa.array(list(total), pa.int32()), "d": pa.array(list(total.values()), pa.int64())})

    spreads = labels.select("taken", "distance").mapInArrow(spread, "cluster int, d bigint")
    inertia = {r["cluster"]: r["d"] for r in spreads.groupBy("cluster").agg(F.sum("d").alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    whole = sum(inertia.values())

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, (taken, far) in enumerate(zip(*(batch.column(i).to_pylist() for i in (1, 2)))):
                near = unpack_numbers(taken).astype(np.int64).tolist()
                ids = batch.column(0).slice(n, 1).flatten()
                columns = [
                    pa.array(near, pa.int32()),
                    pa.array(unpack_numbers(far).astype(np.int64)),
                    pa.array([inertia[c] for c in near], pa.int64()),
                    pa.array([whole] * len(near), pa.int64()),
                    pa.array([digests[c] for c in near], pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([ids, *columns], names=[id_col, *"cluster distance cluster_inertia inertia centroid_sha256".split()])

    ids = blocks.filter("block = 0").select("chunk", "ids")
    return ids.join(labels, "chunk").select("ids", "taken", "distance").mapInArrow(each, schema)
