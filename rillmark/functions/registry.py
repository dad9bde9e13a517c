"""SQL names for the functions.

Both the scalar and the table function are SQL that Catalyst inlines, so a query that
calls them stays in the JVM.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

HASH_SQL = """
CREATE OR REPLACE TEMPORARY FUNCTION string_hash(s STRING) RETURNS INT RETURN CAST(aggregate(
  transform(filter(split(s, ''), c -> c <> ''), c -> CAST(ascii(c) AS BIGINT)), 0L,
  (h, p) -> CASE WHEN p < 65536 THEN shiftright(shiftleft(h * 31 + p, 32), 32)
    ELSE shiftright(shiftleft(
      (h * 31 + shiftright(p - 65536, 10) + 55296) * 31 + ((p - 65536) & 1023) + 56320, 32), 32) END
) AS INT)
"""


#: Parts of a text between question marks with their lengths; empty parts at the end don't count.
SPLIT_SQL = r"""
CREATE OR REPLACE TEMPORARY FUNCTION split_lengths(s STRING) RETURNS TABLE(word STRING, length INT) RETURN
  SELECT word, length(word) AS length FROM (SELECT explode(
    CASE WHEN s = '' OR regexp_replace(s, '[?]+$', '') <> '' THEN split(regexp_replace(s, '[?]+$', ''), '[?]') END) AS word)
"""


def register_functions(spark: SparkSession) -> None:
    """Make ``string_hash`` and ``split_lengths`` callable from SQL."""
    spark.sql(HASH_SQL)
    spark.sql(SPLIT_SQL)
