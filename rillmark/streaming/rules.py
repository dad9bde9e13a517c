"""Rules that come as a stream of their own and change while actions stream in."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.columns import Names, names
from rillmark.operators.joins import match_rules_in_force
from rillmark.streaming.turns import InTurn, Turn


class RulesInForce(InTurn):
    """A ``foreachBatch`` sink for ``joined`` that sends the actions which, with the one before, fulfil the rule in force.

    A rule governs what comes after it in event time until the next one comes, whichever micro-batches they
    arrive in. Carried are each key's last action and the last rule, which takes part in every stretch.
    """

    def __init__(self, spark: SparkSession, folder: str, schema: T.StructType, *, key: Names, ts: str, seq: str, action: str, delay_ms: int, slice_rows: int | None = None) -> None:
        self.of, self.action = names(key), action
        super().__init__(
            spark, folder, schema, key=["is_rule", *self.of], ts=ts, seq=seq, delay_ms=delay_ms, step=self.matched,
            always=F.col("is_rule"), slice_rows=slice_rows,
        )

    def matched(self, rows: DataFrame, turn: Turn) -> DataFrame:
        actions, rules = rows.filter(~F.col("is_rule")), rows.filter("is_rule")
        found = match_rules_in_force(
            actions, rules, key=self.of, order=[self.ts, self.seq], action=self.action, keep="_new", slice_rows=turn.slice_rows
        )
        return found.filter("_new").drop("_new")


def rules_and_actions(actions: DataFrame, rules: DataFrame, *, key: Names) -> DataFrame:
    """Both streams as one: rules have ``is_rule``, ``action1`` and ``action2``, and no key."""
    none = {c: F.lit(None).cast(actions.schema[c].dataType) for c in names(key)}
    both = actions.withColumn("is_rule", F.lit(False)).unionByName(
        rules.withColumns({**none, "is_rule": F.lit(True)}), allowMissingColumns=True
    )
    return both
