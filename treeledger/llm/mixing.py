"""Mix sources to target weights with hash-threshold histograms.

Every document has a place on a line of hashes.  A source that takes part of itself once more takes the documents below
a threshold.  A histogram of sizes by source and leading hash bits gives the bucket in which the threshold lies; only
that bucket is split again by its next bits.  No step sorts documents, and all that is joined to them is one row a
source.

Defined results: a null or empty text has size 0 and takes nothing; null sources are one source; rows with equal id and
text have one hash and are taken alike; an empty table gives an empty result.  Other columns are kept by ``mixed``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from treeledger.llm.common import stored, words

BITS = 12  # hash bits of one histogram
LEVELS = 3  # histograms, each inside the boundary bucket of the one before: 2^36 buckets
WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
LIMIT = 2


def _bucket(level: int) -> Column:
    """The leading bits of the hash up to this level."""
    return F.shiftrightunsigned("_hash", 64 - BITS * (level + 1))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, limit: float = LIMIT
) -> DataFrame:
    """Target of each source from ``_source, _source_size``.

    Sources in order of code points, null last, carry the repeating weights.  A target stops at ``limit`` times the
    size; what is over is shared again by weight.  With the sources in order of size by weight those that stop come
    first, so running sums give the level that the others reach.
    """
    by_name, by_ratio = Window.orderBy(F.col("_source").asc_nulls_last()), Window.orderBy("_ratio", "_place")
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("_place") % len(weights) + 1).cast("int"))
    most = limit * F.col("_source_size")
    fits = F.col("_level") * F.col("_weight") <= most
    return (
        sizes.withColumn("_place", F.row_number().over(by_name) - 1)
        .withColumn("_weight", weight)
        .withColumn("_ratio", F.col("_source_size") / F.col("_weight"))
        .withColumn("_stopped", F.coalesce(F.sum(most).over(before), F.lit(0.0)))
        .withColumn("_left", F.sum("_weight").over(whole) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)))
        .withColumn("_budget", F.sum("_source_size").over(whole) * float(share))
        .withColumn("_level", (F.col("_budget") - F.col("_stopped")) / F.col("_left"))
        .withColumn("_reached", F.min_by(F.when(fits, F.col("_level")), F.when(fits, F.col("_ratio"))).over(whole))
        .select(
            "_source",
            "_source_size",
            F.least(most.cast("double"), F.coalesce("_reached", F.col("_level")) * F.col("_weight")).alias("_target"),
        )
    )


def thresholds(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """How each source is taken: whole copies, and a hash bound below which documents are taken once more."""
    copies = F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(0)
    edge = targets.withColumn("_copies", copies.cast("long")).withColumn(
        "_rest", F.col("_target") - F.col("_copies") * F.col("_source_size")
    )
    edge = stored(edge.withColumn("_edge", F.lit(0).cast("long")), "mixing-edge")
    for level in range(LEVELS):
        inside = rows
        if level:
            inside = rows.join(
                edge.select(F.col("_source").alias("_s"), F.col("_edge").alias("_e")),
                F.col("_source").eqNullSafe(F.col("_s")) & (_bucket(level - 1) == F.col("_e")),
                "left_semi",
            )
        histogram = inside.groupBy("_source", _bucket(level).alias("_bucket")).agg(F.sum("size").alias("_sum"))
        upto = Window.partitionBy("_source").orderBy("_bucket")
        summed = histogram.withColumn("_upto", F.sum("_sum").over(upto)).withColumnRenamed("_source", "_s")
        # The boundary is the first bucket whose running sum passes what is left; none is passed when all fits.
        passed = (
            summed.join(edge, F.col("_source").eqNullSafe(F.col("_s")))
            .where(F.col("_upto") > F.col("_rest"))
            .groupBy("_s")
            .agg(F.min(F.struct("_bucket", "_upto", "_sum")).alias("_first"))
        )
        rest = F.col("_rest") - (F.col("_first._upto") - F.col("_first._sum"))
        if level == LEVELS - 1:  # the last bucket is taken when that comes nearer to the target
            bound = F.col("_first._bucket") + (2 * rest > F.col("_first._sum")).cast("long")
        else:
            bound = F.col("_first._bucket")
        edge = stored(
            edge.join(passed, F.col("_source").eqNullSafe(F.col("_s")), "left").select(
                "_source",
                "_source_size",
                "_target",
                "_copies",
                F.coalesce(rest, F.col("_rest")).alias("_rest"),
                # With no bucket passed, the bound stays above all hashes of the source.
                F.coalesce(bound, F.lit(1 << BITS * (level + 1))).alias("_edge"),
            ),
            f"mixing-edge-{level}",
        )
    return edge


def mixed(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    limit: float = LIMIT,
    keep: bool = False,
) -> DataFrame:
    """Per document its size in words, the size and target of its source, and the words that the mix takes of it.

    With ``keep`` the columns of the documents come along, below ``copies``, the number of times that each is taken.
    """
    base = docs.select(
        (F.struct(*(F.col(f"`{c}`") for c in docs.columns)) if keep else F.lit(None).cast(T.ByteType())).alias("_row"),
        F.col(doc_id).alias("_id"),
        F.col(source).alias("_source"),
        F.size(words(F.col(text))).cast("long").alias("size"),
        F.xxhash64(doc_id, text).alias("_hash"),
    )
    narrow = stored(base.select("_id", "_source", "size", "_hash"), "mixing-sizes")
    sizes = stored(narrow.groupBy("_source").agg(F.sum("size").alias("_source_size")), "mixing-sources")
    edge = thresholds(narrow, stored(source_targets(sizes, weights, share, limit), "mixing-targets"))
    extra = (_bucket(LEVELS - 1) < F.col("_edge")).cast("long")
    taken = (base if keep else narrow).join(
        edge.withColumnRenamed("_source", "_s"), F.col("_source").eqNullSafe(F.col("_s"))
    )
    copies = (F.col("_copies") + F.when(F.col("_copies") < limit, extra).otherwise(0)).alias("copies")
    columns = [F.col("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), copies]
    out = taken.select(*(["_row"] if keep else [F.col("_id").alias(doc_id)]), *columns)
    return out if keep else out.withColumn("taken", F.col("size") * F.col("copies"))
