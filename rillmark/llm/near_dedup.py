"""MinHash near-dedup: SuperMinHash signatures, banding, links confirmed on whole sets, union-find groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.llm.common import bounded, map_batches, stored, text_or_empty
from rillmark.llm.components import components
from rillmark.llm.minhash import band_hashes, rows_per_band, set_digest, shingle_set, super_minhash

#: Turns in which buckets try another centre before the rest is compared by shingles. They only save work.
TURNS = 5
#: Places in which occurrences of shingles are counted. What counts is how they compare, which doesn't change with size.
COUNTS = 1 << 18
#: Shingles whose signatures are made together.
TOGETHER = 50_000


def sketches(docs: DataFrame, words: int, size: int, rows: int) -> DataFrame:
    """``id, n, d1, d2, bands``: size and digest of each document's shingle set, hashes of its bands."""

    def sketch(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t.as_py(), words) for t in batch.column(1)]
        bands: list[list[int] | None] = [None] * len(sets)
        held: list[int] = []
        weight = 0

        def flush() -> None:
            nonlocal weight
            if held:
                made = band_hashes(super_minhash([sets[i] for i in held], size), rows)
                for i, row in zip(held, made.tolist()):
                    bands[i] = row
            held.clear()
            weight = 0

        for i, s in enumerate(sets):
            if len(s):
                held.append(i)
                weight += len(s)
            if weight >= TOGETHER:
                flush()
        flush()
        digests = [set_digest(s) for s in sets]
        columns = [
            pa.array([len(s) for s in sets], pa.int64()),
            pa.array([d[0] for d in digests], pa.int64()),
            pa.array([d[1] for d in digests], pa.int64()),
            pa.array(bands, pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "n", "d1", "d2", "bands"])

    return map_batches(docs, sketch, "id bigint, n bigint, d1 bigint, d2 bigint, bands array<bigint>")


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """``id, d1, d2, shingles``: the whole shingle set as sorted 64-bit numbers, and its digest."""

    def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set(t.as_py(), words) for t in batch.column(1)]
        digests = [pa.array(d, pa.int64()) for d in zip(*(set_digest(s) for s in sets))]
        raw = pa.array([s.tobytes() for s in sets], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), *digests, raw], names=["id", "d1", "d2", "shingles"])

    return map_batches(docs, whole, "id bigint, d1 bigint, d2 bigint, shingles binary")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose whole sets have 100 * intersection >= percent * union."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, two = np.frombuffer(x.as_buffer(), "u8"), np.frombuffer(y.as_buffer(), "u8")
                same = len(one) + len(two) - len(np.union1d(one, two))
                keep.append(100 * same >= percent * (len(one) + len(two) - same))
            kept = batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))
            if kept.num_rows:
                yield kept

    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa")), "a")
    both = left.join(sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(judge, "a bigint, b bigint")


def alike(percent: int):
    """Sets of sizes n and cn can only reach the similarity if the sizes are that near."""
    return F.least("n", "cn") * 100 >= F.greatest("n", "cn") * percent


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 80,
    signature: int = 192,
) -> DataFrame:
    """One row per document: ``id_col, n_shingles, component_id, kept``.

    Documents with 100 * intersection >= percent * union of their sets of word shingles are linked; a component is
    what links reach, and its smallest id is kept. Steps:

    1. Documents with equal sets form a class; only its smallest id goes on. Copies are never expanded.
    2. Bands of SuperMinHash signatures give buckets of classes. In each bucket, all are compared with the smallest.
    3. Buckets that are not one component by then are compared with other centres, a few turns.
    4. Classes of buckets that still are not are compared by their rarest shingles, which finds every pair of them that
       can be linked; a pair already known to be in one component is left out.

    The number of places per band is chosen so that a pair at the limit of similarity shares no band once in a
    million. Every link is confirmed on whole sets.

    * Null texts are empty; texts without words have no set and are linked with nothing. Texts may be of any length.
    * Rows with a null id are reported, linked with nothing and kept. Rows that repeat an id each follow their own text.
    * Ids are whole numbers. Other columns are ignored. An empty table gives an empty result.
    """
    found, _ = near_components(docs, id_col, text_col, words, percent, signature)
    return found.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def near_components(docs: DataFrame, id_col: str, text_col: str, words: int, percent: int, signature: int = 192) -> tuple[DataFrame, DataFrame]:
    """(id, n, d1, d2, component) per document, and the ids that are used for different sets.

    The classes of such an id are nodes of their own, with a number made of id and digest; of all others the id is the node.
    """
    rows = rows_per_band(signature, percent / 100)
    source = docs.select(F.col(id_col).cast("bigint").alias("id"), text_or_empty(text_col).alias("text"))
    sketched = stored(sketches(source, words, signature, rows), "near-sketch")
    there = sketched.filter("n > 0 AND id IS NOT NULL")
    digest = F.struct("d1", "d2")
    twice = there.groupBy("id").agg(F.min(digest).alias("low"), F.max(digest).alias("high")).filter("low != high").select("id")
    twice = stored(twice, "near-twice")
    none_twice = twice.isEmpty()

    def noded(df: DataFrame) -> DataFrame:
        if none_twice:
            return df.withColumn("node", F.col("id"))
        marked = df.join(twice.withColumn("_twice", F.lit(True)), "id", "left")
        return marked.withColumn("node", F.when(F.col("_twice"), F.xxhash64("id", "d1", "d2")).otherwise(F.col("id"))).drop("_twice")

    classes = noded(there).groupBy("d1", "d2").agg(
        F.min("node").alias("rep"), F.min("id").alias("least"), F.min_by("id", "node").alias("id"), F.any_value("n").alias("n"), F.any_value("bands").alias("bands")
    )
    classes = stored(classes, "near-classes")

    each = classes.select("rep", "n", F.posexplode("bands").alias("band", "key"))
    members = shared(each)
    wanted = stored(members.select("rep").distinct().join(classes.select("rep", "id"), "rep"), "near-wanted")
    sets = noded(full_sets(source.join(wanted.select("id").distinct(), "id", "left_semi"), words))
    if not none_twice:
        # of an id that is used twice only the set asked for, and that once
        sets = sets.join(wanted.select(F.col("rep").alias("node")), "node", "left_semi").dropDuplicates(["node"])
    sets = stored(sets.select(F.col("node").alias("id"), "shingles"), "near-sets")

    stars = members.filter("rep != center").filter(alike(percent)).select(F.col("rep").alias("a"), F.col("center").alias("b")).distinct()
    links = stored(confirmed(stars, sets, percent), "near-links")
    labels = stored(components(links, "a", "b"), "near-labels")
    apart = unresolved(members, labels)
    for turn in range(TURNS):
        if apart.isEmpty():
            break
        labels = relabelled(labels, confirmed(star_pairs(apart, turn, percent), sets, percent))
        apart = unresolved(apart.drop("component"), labels)
    alone = stored(apart.select(F.col("rep").alias("id"), "n", "component").distinct(), "near-alone")
    if not alone.isEmpty():
        labels = relabelled(labels, confirmed(rare_pairs(alone, sets, percent), sets, percent))

    belongs = classes.join(labels, classes["rep"] == labels["node"], "left")
    belongs = belongs.select("d1", "d2", "least", F.coalesce("component", "rep").alias("component"))
    if not none_twice:
        # a component is named after its smallest id, also where a node is no id
        lowest = belongs.groupBy("component").agg(F.min("least").alias("low"))
        belongs = belongs.join(lowest, "component").select("d1", "d2", F.col("low").alias("component"))
    belongs = stored(belongs.select("d1", "d2", "component"), "near-belongs")
    result = sketched.drop("bands").join(belongs, ["d1", "d2"], "left")
    own = F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("component")).otherwise(F.col("id"))
    return result.withColumn("component", own).select("id", "n", "d1", "d2", "component"), twice


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components after some more links: only these are joined, between the components that there are."""
    links = stored(links, "near-links")
    one, two = (labels.select(F.col("node").alias(c), F.col("component").alias(f"{c}_of")) for c in "ab")
    between = links.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("a_of", "a").alias("a"), F.coalesce("b_of", "b").alias("b"))
    joined = components(between.filter("a != b"), "a", "b")
    top = joined.select(F.col("node").alias("component"), F.col("component").alias("top"))
    moved = labels.join(top, "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    # a component's own name is a node as well once it has joined another
    return stored(moved.unionByName(joined).distinct(), "near-labels")


def shared(each: DataFrame) -> DataFrame:
    """Members of the buckets with several classes, each with the smallest: ``rep, n, band, key, center, cn``."""
    several = each.groupBy("key").agg(F.min(F.struct("rep", "n")).alias("c"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    several = stored(several.select("key", F.col("c.rep").alias("center"), F.col("c.n").alias("cn")), "near-buckets")
    return stored(each.join(several, "key").select("rep", "n", "band", "key", "center", "cn"), "near-members")


def unresolved(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component: ``key, rep, n, component``."""
    labelled = members.join(labels, members["rep"] == labels["node"], "left")
    labelled = labelled.select("rep", "n", "key", F.coalesce("component", "rep").alias("component"))
    several = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = several.filter("low != high").select("key")
    return stored(labelled.join(several, "key", "left_semi").select("key", "rep", "n", "component"), "near-apart")


def star_pairs(apart: DataFrame, turn: int, percent: int) -> DataFrame:
    """Each member with its bucket's centre of this turn, unless they are in one component already.

    The centre is the least in an order that each turn draws anew, the same for all buckets, so a member meets few.
    """
    first = F.min_by(F.struct("rep", "n", "component"), F.xxhash64("rep", F.lit(turn))).alias("c")
    centers = apart.groupBy("key").agg(first).select("key", F.col("c.rep").alias("b"), F.col("c.n").alias("cn"), F.col("c.component").alias("cb"))
    met = apart.join(centers, "key").filter("component != cb").filter(alike(percent))
    return met.select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b")).distinct()


def rare_pairs(apart: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that can reach the similarity, by their rarest shingles.

    If sets of n and m reach it, the first n - ceil(percent * n / 100) + 1 shingles of the one and as many of the
    other, in any order common to both, have one in common. The order here is by how often a shingle occurs, rarest
    first, so texts that only share a frequent passage don't meet. Occurrences are counted in ``COUNTS`` places, which
    is all that goes through the driver; where shingles share a place the order is less sharp, not less right.
    """
    own = apart.join(sets, "id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTS, dtype=np.int64)
        for batch in batches:
            for raw in batch.column(0):
                np.add.at(total, (np.frombuffer(raw.as_buffer(), "u8") % COUNTS).astype(np.int64), 1)
        at = np.flatnonzero(total)
        if len(at):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["place", "n"])

    own = stored(own, "near-own")
    counted = own.select("shingles").mapInArrow(count, "place bigint, n bigint").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTS, dtype=np.int64)
    counts[counted["place"].to_numpy()] = counted["n"].to_numpy()
    sent = apart.sparkSession.sparkContext.broadcast(counts)

    def prefixes(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        keys, rows, places = [], [], []
        for i, raw in enumerate(batch.column(3)):
            shingles = np.frombuffer(raw.as_buffer(), "u8")
            often = sent.value[(shingles % COUNTS).astype(np.int64)]
            first = np.lexsort((shingles, often))[: len(shingles) - -(-percent * len(shingles) // 100) + 1]
            place = np.flatnonzero(often[first] > 1)
            keys.append(shingles[first[place]])
            rows.append(np.full(len(place), i))
            places.append(place)
        at = pa.array(np.concatenate(rows))
        columns = [batch.column(k).take(at) for k in range(3)]
        own_columns = [pa.array(np.concatenate(keys).astype("i8")), pa.array(np.concatenate(places).astype("i4"))]
        return pa.RecordBatch.from_arrays([*own_columns, *columns], names=["key", "place", "id", "n", "component"])

    rare = map_batches(own.select("id", "n", "component", "shingles"), prefixes, "key bigint, place int, id bigint, n bigint, component bigint")
    rare = stored(rare, "near-rare")
    meets = rare.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low != high").select("key")
    rare = stored(rare.join(meets, "key", "left_semi"), "near-meets")
    one = rare.select("key", F.col("id").alias("a"), "n", (F.col("n") - F.col("place")).alias("left"), F.col("component").alias("ca"))
    two = rare.select("key", F.col("id").alias("b"), F.col("n").alias("cn"), (F.col("n") - F.col("place")).alias("cleft"), F.col("component").alias("cb"))
    # from the first shingle in common on, both sets must still hold as many as the similarity asks for
    enough = F.least("left", "cleft") * (100 + percent) >= (F.col("n") + F.col("cn")) * percent
    met = one.join(two, "key").filter("a < b AND ca != cb").filter(alike(percent) & enough)
    return met.select("a", "b").distinct()


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, one of each component, all columns unchanged.

    Of an id that is used for different texts only the rows whose set of shingles is a copy's go. Rows without an id and
    texts without words stay, and so do rows that repeat the one that stays. No text is shuffled as long as the ids to drop are
    no more than ``NARROW_ROWS``. An empty table stays empty; other columns may have any name.
    """
    found, twice = near_components(docs, id_col, text_col, words, percent)
    drop = found.filter("id IS NOT NULL AND id != component").select(F.col("id").alias("_id"), F.col("d1").alias("_d1"), F.col("d2").alias("_d2"))
    drop = stored(drop.distinct(), "near-drop")
    same_id = F.col(f"d.{id_col}").cast("bigint") == F.col("x._id")
    if twice.isEmpty():
        return docs.alias("d").join(bounded(drop.select("_id")).alias("x"), same_id, "left_anti")
    several = bounded(twice.select(F.col("id").alias("_id"))).alias("x")
    single = docs.alias("d").join(several, same_id, "left_anti").alias("d").join(bounded(drop.select("_id")).alias("x"), same_id, "left_anti")
    place = docs.columns.index(text_col)

    def digested(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests = [set_digest(shingle_set(t.as_py() or "", words)) for t in batch.column(place)]
        more = [pa.array(d, pa.int64()) for d in zip(*digests)]
        return pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "_near_d1", "_near_d2"])

    schema = T.StructType([*docs.schema.fields, *(T.StructField(f"_near_d{k}", T.LongType()) for k in (1, 2))])
    rest = map_batches(docs.alias("d").join(several, same_id, "left_semi"), digested, schema)
    copy = same_id & (F.col("d._near_d1") == F.col("x._d1")) & (F.col("d._near_d2") == F.col("x._d2"))
    return single.unionByName(rest.alias("d").join(bounded(drop).alias("x"), copy, "left_anti").drop("_near_d1", "_near_d2"))
