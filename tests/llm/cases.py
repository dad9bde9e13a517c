"""Small tables with every awkward case, shared by the tests of the corpus operators."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

#: Names the operators use inside; none of these columns may disturb them.
CLASHING = "id bigint, n bigint, key string, _id string, part string, bucket bigint, names string, rep bigint, a string, shingles string"


def documents(spark: SparkSession, rows: list[tuple[int | None, str | None]]) -> DataFrame:
    extra = (7, 8, "k", "x", "p", 9, "m", 1, "a", "s")
    return spark.createDataFrame([(*r, *extra) for r in rows], f"doc_id bigint, text string, {CLASHING}").repartition(2)


def prose(seed: int, words: int) -> str:
    rnd = random.Random(seed)
    return " ".join("".join(rnd.choice(["ta", "ri", "mo", "sel", "ku", "é", "na"]) for _ in range(rnd.randint(1, 4))) for _ in range(words))


def awkward() -> list[tuple[int | None, str | None]]:
    """Null and empty texts, null ids, repeated rows, copies, near copies, one very long text."""
    base = prose(1, 120)
    near = base.split(" ")
    near[60] = "changed"
    return [
        (5, None),
        (3, ""),
        (9, " \t\n "),
        (None, base),
        (None, None),
        (10, base),
        (2, base.replace(" ", "\n ", 3)),
        (7, base.upper()),
        (11, " ".join(near)),
        (12, prose(2, 200)),
        (12, prose(2, 200)),
        (13, prose(3, 2)),
        (14, prose(4, 40_000)),
        (15, prose(5, 300) + " " + base),
    ]
