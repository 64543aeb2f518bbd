"""Which elements are new, which are known, and which id each one has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeledger.functions.keys import element_id, with_keys
from treeledger.operators.lookups import surviving_among
from treeledger.operators.order import keep_first
from treeledger.schema import KEY, VISIT_ORDER


def known_keys(master: DataFrame, *types: str) -> DataFrame:
    """The keys present in the master, for the given types if any are given."""
    keys = with_keys(master).select(*KEY)
    return keys.where(F.col("k_type").isin(*types)) if types else keys


def only_new(keyed: DataFrame, master: DataFrame) -> DataFrame:
    """Rows (with key columns) whose key is not in the master."""
    return keyed.join(known_keys(master), KEY, "left_anti")


def already_known(keyed: DataFrame, master: DataFrame) -> DataFrame:
    """Rows (with key columns) whose key is in the master."""
    return keyed.join(known_keys(master), KEY, "left_semi")


def first_by_key(df: DataFrame, order: list[str] = VISIT_ORDER) -> DataFrame:
    """One row per element key: the first one met."""
    return keep_first(with_keys(df), KEY, order)


def resolve_ids(candidates: DataFrame, master: DataFrame, order: list[str], new_id: Column) -> DataFrame:
    """Add ``ID`` (of the master if the key is there, else ``new_id``) and ``is_new`` to rows with key columns."""
    known = surviving_among(master, candidates, order).select(*KEY, F.col("ID").alias("_known_id"))
    return (
        candidates.join(known, KEY, "left")
        .withColumns({"ID": F.coalesce("_known_id", new_id), "is_new": F.col("_known_id").isNull()})
        .drop("_known_id")
    )


def default_id() -> Column:
    """Id of an element that is unique by key."""
    return element_id("TYPE", "PROJECT_ID", "NAME")


def occurrence_id() -> Column:
    """Id of one occurrence of a leaf, for runs that create every occurrence."""
    return element_id("TYPE", "PROJECT_ID", "NAME", "folder_name", "file_name", "row_idx", "col_idx")


def duplicate_keys(leaves: DataFrame) -> DataFrame:
    """Leaf keys that occur more than once: number of rows and in how many blocks.

    Counts per (key, block) come first; the second step then adds up one row per block of each key.
    """
    per_block = with_keys(leaves).groupBy(*KEY, "block_name").agg(F.count(F.lit(1)).alias("n"))
    return (
        per_block.groupBy(*KEY)
        .agg(F.sum("n").alias("n_rows"), F.count("block_name").alias("n_blocks"))
        .where("n_rows > 1")
    )
