"""A training-data pipeline over ``documents``: each stage filters, rewrites or encodes what the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from treeledger.llm import stages
from treeledger.llm.common import stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("toxicity", stages.toxicity),
    ("near_dedup", stages.near_dedup),
    ("pii", stages.pii),
    ("mixing", stages.mixing),
    ("bpe", stages.bpe),
]

# Fitted weights, signatures and merges have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder; the result of each is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
