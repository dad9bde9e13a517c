"""Exact dedup by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillmark.llm.common import SPACES, bounded, stored, text_or_empty


def normalised(text_col: str) -> Column:
    """The text with each run of ASCII white space as one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(text_col), SPACES, " ")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    prefix_chars: int = 256,
    digest_all: bool = False,
) -> DataFrame:
    """One row per document: ``id_col, keep_id, group_size, kept, text_sha256``.

    Only narrow rows (id, length, hashes) are shuffled. Lengths that occur once decide their documents;
    of the others, so do prefix hashes that occur once per length; only the documents left get the full
    SHA-256, by which groups are formed. ``text_sha256`` is null where no full hash was needed, unless
    ``digest_all`` asks for it on every row; then it is taken in the first scan and the text is read once.

    * Null texts are empty, and empty texts are equal. Texts may be of any length.
    * The smallest id of a group stays. Null ids count as larger than all others; if a group has only
      null ids, all its rows stay, as nothing tells them apart. So do rows that repeat the id that stays.
    * Other columns are ignored, whatever their names. An empty table gives an empty result.
    """
    norm = normalised(text_col)
    digest = F.unhex(F.sha2(norm, 256))

    def narrow(df: DataFrame, with_digest: bool) -> DataFrame:
        columns = [
            F.col(id_col).alias("_id"),
            F.length(norm).alias("_n"),
            F.xxhash64(F.substring(norm, 1, prefix_chars)).alias("_head"),
        ]
        return df.select(*columns, *([digest.alias("_full")] if with_digest else []))

    keys = stored(narrow(docs, digest_all), "exact-keys")
    lengths = keys.groupBy("_n").count().filter("count > 1").select("_n")
    heads = keys.join(lengths, "_n", "left_semi").groupBy("_n", "_head").count().filter("count > 1")
    heads = stored(heads.select("_n", "_head"), "exact-heads")
    if digest_all:
        left = keys.join(heads, ["_n", "_head"], "left_semi")
        single = keys.join(heads, ["_n", "_head"], "left_anti")
    else:
        # the full text is hashed only where its length and head recur
        flagged = docs.select(F.col(id_col).alias("_id"), norm.alias("_norm")).select(
            "_id",
            F.length("_norm").alias("_n"),
            F.xxhash64(F.substring("_norm", 1, prefix_chars)).alias("_head"),
            F.col("_norm"),
        )
        left = flagged.join(bounded(heads), ["_n", "_head"], "left_semi").select("_id", F.unhex(F.sha2("_norm", 256)).alias("_full"))
        left = stored(left, "exact-full")
        single = keys.join(heads, ["_n", "_head"], "left_anti").withColumn("_full", F.lit(None).cast("binary"))
    groups = left.groupBy("_full").agg(F.min("_id").alias("_keep"), F.count(F.lit(1)).alias("_size")).filter("_size > 1")
    groups = stored(groups, "exact-groups")
    several = left.join(groups, "_full", "left").select(
        "_id",
        F.when(F.col("_size").isNull(), F.col("_id")).otherwise(F.col("_keep")).alias("_keep"),
        F.coalesce("_size", F.lit(1).cast("bigint")).alias("_size"),
        "_full",
    )
    alone = single.select("_id", F.col("_id").alias("_keep"), F.lit(1).cast("bigint").alias("_size"), "_full")
    return several.unionByName(alone).select(
        F.col("_id").alias(id_col),
        F.col("_keep").alias("keep_id"),
        F.col("_size").alias("group_size"),
        F.col("_id").eqNullSafe(F.col("_keep")).alias("kept"),
        F.lower(F.hex("_full")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, all columns unchanged.

    Rows are dropped by id and full hash together, so an id that is used for two texts loses only the copy. Texts are
    hashed only where their length and head recur, and again where their id is to be dropped. No text is shuffled as long as
    the rows to drop are no more than ``NARROW_ROWS``. Nulls, empty texts, repeated rows, other columns: see ``exact_dedup``;
    an empty table stays empty.
    """
    verdict = exact_dedup(docs, id_col, text_col).filter(~F.col("kept"))
    drop = stored(verdict.select(F.col(id_col).alias("_id"), F.unhex("text_sha256").alias("_full")).distinct(), "exact-drop")
    # not an equality to join on, so it is looked at only where the id is one to drop
    copy = F.coalesce(F.unhex(F.sha2(normalised(f"d.{text_col}"), 256)) == F.col("x._full"), F.lit(False))
    return docs.alias("d").join(bounded(drop).alias("x"), F.col(f"d.{id_col}").eqNullSafe(F.col("x._id")) & copy, "left_anti")
