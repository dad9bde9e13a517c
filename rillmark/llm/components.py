"""Connected components of a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import stored


#: Links that one task may join: a bound on its memory, not on the links, which stars join beyond it.
FEW_LINKS = 100_000


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Union-find over the links of one part: each node with the smallest node it is joined to."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while (up := parent.get(top, top)) != top:
            top = up
        while x != top:
            parent[x], x = top, parent.get(x, x)
        return top

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    nodes = [x for x in parent if root(x) != x]
    if nodes:
        roots = [root(x) for x in nodes]
        yield pa.RecordBatch.from_arrays([pa.array(np.array(nodes)), pa.array(np.array(roots))], names=["u", "v"])


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for each node that isn't the smallest of its component.

    Links of a part are first contracted by union-find. If no more than ``FEW_LINKS`` pairs of numbers are left, some
    megabytes, one task joins them the same way; else large and small stars alternate across parts until
    nothing changes, each round written to the shared folder. Minima are pre-aggregated, joins may be split where a
    node is hot, and only a count and a checksum per round come to the driver.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u != v")
    edges = stored(edges.mapInArrow(forest, "u bigint, v bigint"), "links")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        if mark[0] <= FEW_LINKS:
            edges = stored(edges.repartition(1).mapInArrow(forest, "u bigint, v bigint"), "links")
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        seen = mark
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        rest = large.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(rest.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct(), "links")
