"""The stages of the pipeline: each takes (spark, docs, sf_dir) and returns documents for the next one.

All stages keep the columns of their input and read it whole; they handle null and empty texts as their operators do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger.llm import bpe as bpe_operator
from treeledger.llm import mixing as mixing_operator
from treeledger.llm import near_dedup as near_dedup_operator
from treeledger.llm import pii as pii_operator
from treeledger.llm import toxicity as toxicity_operator
from treeledger.llm.common import fresh, stored, table

TOXIC_FROM = 0.5


def _columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*(F.col(f"`{c}`") for c in names))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.5."""
    model = toxicity_operator.fit(docs, table(spark, sf_dir, "labels"))
    score = fresh(docs, "toxicity")
    scored = toxicity_operator.scored(docs, model, score=score)
    return _columns(scored.where(F.col(score) < TOXIC_FROM), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the least id; of its equal rows one stays too.

    Only the rejected ids are joined with the texts.  They are few in most corpora, and then sent to all tasks; where
    they are many, Spark joins them in its own way.
    """
    classes = near_dedup_operator.classes(docs, width=5, percent=80)
    name = fresh(docs, "named")

    def among(rows: DataFrame, how: str, ids: DataFrame) -> DataFrame:
        there = F.col("doc_id") == F.col(name)
        return rows.join(near_dedup_operator.sized(ids), there, how)

    rejected = classes.where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    kept = among(docs, "left_anti", stored(rejected, "pipeline-rejected"))
    # Rows that repeat an id are the same document; their ids are looked for first, so that other rows are not moved.
    again = classes.where("kept and doc_id is not null").groupBy(F.col("doc_id").alias(name)).count()
    again = stored(again.where("count > 1").drop("count"), "pipeline-again")
    if not again.limit(1).count():
        return kept
    once, more = among(kept, "left_anti", again), among(kept, "left_semi", again)
    return once.unionByName(more.dropDuplicates(["doc_id"]))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms in place of personal data; their number of characters follows the text."""
    changed = pii_operator.pseudonymised(docs, counts=False)
    if "n_chars" in docs.columns:
        same = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed = changed.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.coalesce(same, F.col("n_chars"))))
    return _columns(changed, docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    taken = mixing_operator.mixed(docs, keep=True).where("copies > 0")
    repeated = taken.select("_row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select(*(F.col("_row").getField(c).alias(c) for c in docs.columns))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the ids of their texts."""
    coded = bpe_operator.encode_column(docs, bpe_operator.byte_vocabulary())
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))
