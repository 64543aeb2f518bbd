"""Parent links: reading them, following them, sampling them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.operators.order import keep_first
from treeledger.schema import TYPES


def parents_of(elements: DataFrame, order: list[str], children: DataFrame | None = None) -> DataFrame:
    """The elements that are named as a parent, the first row of each id.

    Parents are few; the semi-join picks them out before anything is grouped, so the leaves are not shuffled for it.
    """
    asked = (elements if children is None else children).select(F.col("PARENT_ID").alias("ID")).distinct()
    kept = ["ID", "NAME", "TYPE", "PARENT_ID"]
    extra = [c for c in order if c not in kept]
    rows = elements.select(*kept, *extra).join(asked, "ID", "left_semi")
    return keep_first(rows, ["ID"], order).select(*kept)


def children_with_parent(elements: DataFrame, order: list[str]) -> DataFrame:
    """Each TABLE and INVERTER with the name of its parent: the first element of that id, of any type."""
    leaves = elements.where(F.col("TYPE").isin("TABLE", "INVERTER"))
    parents = parents_of(elements, order, leaves).select(
        F.col("ID").alias("PARENT_ID"), F.col("NAME").alias("parent_name")
    )
    return leaves.join(parents, "PARENT_ID").select("PROJECT_ID", "ID", "NAME", "TYPE", "PARENT_ID", "parent_name")


def element_paths(elements: DataFrame, order: list[str]) -> DataFrame:
    """Path and depth of every element, following at most two parent links (the tree has three levels).

    Blocks are joined to plots first, so that the leaves, which are nearly all rows, take part in one join only.
    """
    parents = parents_of(elements, order)
    plots = parents.where("TYPE = 'PLOT'").select(F.col("ID").alias("p_id"), F.col("NAME").alias("plot"))
    blocks = parents.where("TYPE = 'BLOCK'").select(F.col("ID").alias("b_id"), F.col("NAME").alias("block"), "PARENT_ID")
    above = blocks.join(plots, F.col("PARENT_ID") == F.col("p_id"), "left").select("b_id", "block", "plot").unionByName(
        plots.select(F.col("p_id").alias("b_id"), F.lit(None).cast("string").alias("block"), "plot")
    )
    up = elements.join(above, F.col("PARENT_ID") == F.col("b_id"), "left")
    parts = F.array_compact(F.array("plot", "block", "NAME"))
    return up.select(
        "ID", "PROJECT_ID", "TYPE", F.concat_ws("/", parts).alias("path"), F.size(parts).cast("bigint").alias("depth")
    )


def sample_chain(elements: DataFrame, order: list[str]) -> DataFrame:
    """The first PLOT, its first BLOCK, and the first TABLE and INVERTER of that block; nulls where a level is empty.

    Each level is a global ``min_by``, which leaves one row; the four rows are put side by side by one more aggregate.
    """
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)

    def first(rows: DataFrame, kind: str) -> DataFrame:
        picked = rows.agg(F.min_by(F.struct("ID", "NAME"), rank).alias("e"))
        return picked.select(F.lit(kind).alias("kind"), F.col("e.ID").alias("id"), F.col("e.NAME").alias("name"))

    def below(parent: DataFrame, kind: str) -> DataFrame:
        children = elements.where(F.col("TYPE") == kind)
        return first(children.join(parent.select(F.col("id").alias("PARENT_ID")), "PARENT_ID", "left_semi"), kind)

    plot = first(elements.where("TYPE = 'PLOT'"), "PLOT")
    block = below(plot, "BLOCK")
    levels = plot.unionByName(block).unionByName(below(block, "TABLE")).unionByName(below(block, "INVERTER"))
    return levels.agg(
        *[
            F.max(F.when(F.col("kind") == kind, F.col(field))).alias(f"{kind.lower()}_{field}")
            for kind in TYPES
            for field in ("id", "name")
        ]
    )
