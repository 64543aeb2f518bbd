"""Row order made explicit.

Spark keeps no row order, and here order decides which of two equal elements survives.  These helpers pick the first or
last row of a key and number the rows of a group, without bringing a whole group into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: list[str], order: list[str], chooser) -> DataFrame:
    payload = [c for c in df.columns if c not in keys]
    rank = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    picked = df.groupBy(*keys).agg(chooser(F.struct(*payload), rank).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is lowest in ``order``.

    An aggregate, not a window: every task first reduces its own rows to one per key, so only one row per key and task
    is shuffled and a key that holds a third of all rows does no harm.
    """
    return _pick(df, keys, order, F.min_by)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The row of each key that is highest in ``order``."""
    return _pick(df, keys, order, F.max_by)


def number_rows(df: DataFrame, groups: list[str], order: str, name: str, width: int = 1 << 16) -> DataFrame:
    """Number the rows of each group 1, 2, … by the unique non-negative integer column ``order``.

    The result equals ``row_number() over (partition by groups order by order)``, but a group is cut into ranges of
    ``width`` order values.  Rows are ranked inside their range, and the counts of the earlier ranges are added.  The
    counts are summed in two steps so that no window holds more than ``width`` ranges.
    """
    ranged = df.withColumns(
        {"_range": F.floor(F.col(order) / width), "_span": F.floor(F.col(order) / width / width)}
    )
    counts = ranged.groupBy(*groups, "_span", "_range").agg(F.count(F.lit(1)).alias("_n"))
    spans = counts.groupBy(*groups, "_span").agg(F.sum("_n").alias("_span_n"))

    def before(parts: list[str], by: str, n: str):
        window = W.orderBy(by).rowsBetween(W.unboundedPreceding, -1)
        window = W.partitionBy(*parts).orderBy(by).rowsBetween(W.unboundedPreceding, -1) if parts else window
        return F.coalesce(F.sum(n).over(window), F.lit(0))

    span_start = spans.select(*groups, "_span", before(groups, "_span", "_span_n").alias("_before_span"))
    range_start = (
        counts.withColumn("_before_range", before(groups + ["_span"], "_range", "_n"))
        .join(span_start, groups + ["_span"])
        .select(*groups, "_range", (F.col("_before_span") + F.col("_before_range")).alias("_before"))
    )
    in_range = F.row_number().over(W.partitionBy(*groups, "_range").orderBy(order))
    # A left join, though every range is there: it keeps the rows on the streamed side whatever the estimates say.
    return (
        ranged.withColumn("_rank", in_range)
        .join(range_start, groups + ["_range"], "left")
        .select(*df.columns, (F.col("_before") + F.col("_rank")).cast("bigint").alias(name))
    )
