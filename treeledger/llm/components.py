"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.llm.common import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node of a link; the component is the least node that can be reached.

    Every node points to a node of its component that is not greater.  In each round the ends of a link hand each
    other, and the nodes they point to, the least node known to either, and every node skips to where its node points.
    The number of rounds grows with the logarithm of the longest path; each is written to the shared folder.
    """
    ends = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    both = stored(ends.union(ends.select("v", "u")).distinct(), "links")
    labels = stored(both.groupBy("u").agg(F.least("u", F.min("v")).alias("f")), "labels")
    while True:
        point = labels.select(F.col("u").alias("pu"), F.col("f").alias("g"))
        # Where the node that a node points to points itself.
        far = stored(labels.join(point, F.col("f") == F.col("pu")).select("u", "f", "g"), "far")
        near = far.select(F.col("u").alias("nu"), F.col("g").alias("ng"))
        least = both.join(near, F.col("v") == F.col("nu")).groupBy("u").agg(F.min("ng").alias("m"))
        hooked = stored(far.join(least, "u").select("u", "f", F.least("g", "m").alias("m")), "hooked")
        asked = hooked.select("u", "m").union(hooked.select(F.col("f").alias("u"), "m"))
        new = asked.groupBy("u").agg(F.min("m").alias("m"))
        after = stored(
            labels.join(new, "u").select("u", F.col("m").alias("f"), (F.col("m") != F.col("f")).alias("moved")), "labels"
        )
        moved = after.where("moved").limit(1).count()
        labels = after.select("u", "f")
        if not moved:
            return labels.select(F.col("u").alias("node"), F.col("f").alias("component"))
