"""The corpus pipeline: each stage calls one operator of ``rillmark.llm`` on what the stage before has kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rillmark.llm.common import stored
from rillmark.llm.decontaminate import drop_contaminated
from rillmark.llm.exact_dedup import drop_copies
from rillmark.llm.near_dedup import drop_near_copies
from rillmark.llm.packing import pack_documents
from rillmark.llm.toxicity import drop_toxic, train

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal model, fitted on the labels, does not call toxic."""
    return drop_toxic(docs, train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the smallest id."""
    return drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose shingles of five words are alike to 0.8, directly or through others, the smallest id."""
    return drop_near_copies(docs, words=5, percent=80)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item of the benchmark."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, packed into sequences of at most 1024 tokens."""
    return pack_documents(docs, "byte_bpe_50k.json", capacity=1024, end_id=2)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("decontamination", benchmark_passages),
    ("best_fit_packing", packing),
]

#: Tokens, edit distances and learned weights are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"pipeline-{name}")
    return docs
