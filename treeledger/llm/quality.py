"""Quality rules: plain limits, then robust multivariate outliers within each language and source.

A document's text gives a vector of transformed statistics.  For each language and source the minimum-covariance-
determinant estimate is the mean and covariance of that share of the vectors whose covariance has the least determinant.
It is found by concentration steps: measure all distances, keep the nearest share, estimate again.  There are two fixed
starts (nearest by sum and by maximum of median-scaled coordinates); the one with the smaller determinant wins.  A
document is rejected when its Mahalanobis distance is beyond a quantile of the chi-squared distribution.

Every step is an aggregation of narrow rows to one row a group, with partial sums in the map tasks, and a join of those
rows back; the text is read once.

Defined results: a null or empty text has no words and fails the plain limits; documents that fail are not used for the
estimates; null languages and sources are groups of their own; groups of fewer than ``MIN_ROWS`` documents are pooled by
language, and a pool that is still smaller rejects none; repeated rows count as often as they occur; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeledger.llm.common import SPACES, let, stored, total, words

WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30
MIN_ROWS = 50  # documents that a group needs for an estimate of its own
SHARE = 0.75  # of the vectors that the estimate rests on
STEPS = 4
NORMAL_QUANTILE = 5.6  # of the share of normal documents that may be rejected: about one in a hundred million
RIDGE = 0.25  # added to each variance, in units of the scale below
ACCURACY = 10_000  # of quantiles
# Statistics and the least scale of each: a spread below it is no reason to reject.
STATISTICS = {"vocabulary": 0.05, "word_length": 0.15, "symbols": 0.03, "lines": 0.5, "repeats": 0.2}
P = len(STATISTICS)
PAIRS = list(combinations_with_replacement(range(P), 2))


def repeated_words(tokens: Column) -> Column:
    """Words inside windows of ``WINDOW`` words that the text has twice or more.

    Windows with equal hashes are neighbours after sorting; a text without any, which is most, is not sorted.
    """
    last = F.size(tokens) - WINDOW + 1

    def covered(hashes: Column) -> Column:
        at = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        # Of each run of equal hashes all starts count; the next start tells how many words a window adds.
        runs = let(
            F.array_sort(at),
            lambda s: F.array_sort(
                F.transform(
                    F.filter(
                        F.transform(
                            s,
                            lambda x, k: F.struct(
                                x["i"].alias("i"),
                                (
                                    F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                                    | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))
                                ).alias("again"),
                            ),
                        ),
                        lambda x: x["again"],
                    ),
                    lambda x: x["i"],
                )
            ),
        )
        return let(
            runs,
            lambda r: F.aggregate(
                F.transform(r, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(r, k + 1) - i, F.lit(WINDOW)))),
                F.lit(0).cast("long"),
                lambda sum_, x: sum_ + x,
            ),
        )

    hashed = let(
        F.transform(tokens, lambda w: F.xxhash64(w)),
        lambda w: F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(w, i, WINDOW))),
    )
    count = let(hashed, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0))
    return F.when(last >= 2, count).otherwise(0).cast("long")


def text_statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add the counts that the rules use: words, their characters, symbols, repeated lines and words, different words."""
    value = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(value, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = let(
        words(F.col(text)),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.size(F.array_distinct(w)).cast("long").alias("n_different"),
            repeated_words(w).alias("n_repeat_words"),
        ),
    )
    return docs.withColumn("_counted", counted).select(
        *(F.col(f"`{c}`") for c in docs.columns),
        "_counted.n_words",
        F.length(F.regexp_replace(value, SPACES, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(value, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        "_counted.n_repeat_words",
        "_counted.n_different",
        F.size(lines).cast("long").alias("n_lines"),
    )


def _vector() -> list[Column]:
    """Transformed statistics, in the order of STATISTICS; counts of at least one word are assumed."""
    share = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return [
        F.log("n_different") / F.log(F.greatest(F.col("n_words"), F.lit(2))),  # hardly depends on the length
        F.log(share("word_chars", "n_words")),
        share("n_symbols", "word_chars"),
        share("n_dup_lines", "n_lines"),
        share("n_repeat_words", "n_words"),
    ]


def chi_squared(quantile: float, p: int) -> float:
    """Quantile of the chi-squared distribution, from that of the normal one (Wilson and Hilferty)."""
    return p * (1 - 2 / (9 * p) + quantile * math.sqrt(2 / (9 * p))) ** 3


def _inverse(matrix: Column) -> Column:
    """Inverse of a symmetric P x P matrix, followed by its determinant: one sweep for each pivot."""

    def sweeping(k: int) -> Callable[[Column], Column]:
        def sweep(m: Column) -> Column:
            def cell(i: Column) -> Column:
                row, column, pivot = F.floor(i / P), i % P, m[k * P + k]
                return (
                    F.when(i == P * P, m[P * P] * pivot)
                    .when((row == k) & (column == k), -1 / pivot)
                    .when((row == k) | (column == k), F.get(m, i.cast("int")) / pivot)
                    .otherwise(
                        F.get(m, i.cast("int"))
                        - F.get(m, (row * P + k).cast("int")) * F.get(m, (k * P + column).cast("int")) / pivot
                    )
                )

            return F.transform(F.sequence(F.lit(0), F.lit(P * P)), cell)

        return sweep

    swept = F.concat(matrix, F.array(F.lit(1.0)))
    for k in range(P):
        swept = let(swept, sweeping(k))
    return F.transform(swept, lambda x, i: F.when(i == P * P, x).otherwise(-x))


def _distance(start: str) -> Column:
    """Squared Mahalanobis distance under the estimate of a start."""
    off = [F.col(f"z{i}") - F.col(f"mean_{start}")[i] for i in range(P)]
    return total(
        [(1.0 if i == j else 2.0) * off[i] * off[j] * F.col(f"inverse_{start}")[i * P + j] for i, j in PAIRS]
    )


def _estimates(rows: DataFrame, distances: dict[str, Column], share: float) -> DataFrame:
    """Mean, inverse covariance and determinant of the nearest share of each group, for each start."""
    measured = rows.select("_g", *(f"z{i}" for i in range(P)), *(d.alias(f"d_{s}") for s, d in distances.items()))
    limits = stored(
        measured.groupBy("_g").agg(
            *(F.percentile_approx(f"d_{s}", share, ACCURACY).alias(f"limit_{s}") for s in distances)
        ),
        "quality-limits",
    )
    sums = []
    for s in distances:
        near = F.col(f"d_{s}") <= F.col(f"limit_{s}")
        sums.append(F.sum(near.cast("double")).alias(f"n_{s}"))
        sums += [F.sum(F.when(near, F.col(f"z{i}")).otherwise(0.0)).alias(f"s_{s}_{i}") for i in range(P)]
        sums += [
            F.sum(F.when(near, F.col(f"z{i}") * F.col(f"z{j}")).otherwise(0.0)).alias(f"s_{s}_{i}_{j}")
            for i, j in PAIRS
        ]
    summed = measured.join(limits, "_g").groupBy("_g").agg(*sums)
    columns = []
    for s in distances:
        mean = [F.col(f"s_{s}_{i}") / F.col(f"n_{s}") for i in range(P)]
        covariance = F.array(
            *(
                F.col(f"s_{s}_{min(i, j)}_{max(i, j)}") / F.col(f"n_{s}")
                - mean[i] * mean[j]
                + F.lit(RIDGE if i == j else 0.0)
                for i in range(P)
                for j in range(P)
            )
        )
        columns += [F.array(*mean).alias(f"mean_{s}"), _inverse(covariance).alias(f"inverse_{s}")]
    return stored(summed.select("_g", *columns), "quality-estimates")


def _groups(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """Add ``_g``: language and source, or the pool of the language, or null where both have too few rows."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    keyed = rows.withColumn("_pool", part(lang)).withColumn("_own", F.concat("_pool", F.lit("\x01"), part(source)))
    used = F.sum((~F.col("base_failed")).cast("long"))
    counts = stored(keyed.groupBy("_own", "_pool").agg(used.alias("_n")), "quality-groups")
    small = F.sum(F.when(F.col("_n") < MIN_ROWS, F.col("_n")).otherwise(0))
    pools = counts.groupBy("_pool").agg(small.alias("_pooled"))
    pooled = F.when(F.col("_pooled") >= MIN_ROWS, F.concat("_pool", F.lit("\x01*")))
    mapped = counts.join(pools, "_pool").select(
        "_own", F.when(F.col("_n") >= MIN_ROWS, F.col("_own")).otherwise(pooled).alias("_g")
    )
    return keyed.join(stored(mapped, "quality-keys"), "_own").drop("_own", "_pool")


def judged(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source"
) -> DataFrame:
    """Per document its counts, whether it fails the plain limits, its squared distance, and whether it is kept."""
    base = docs.select(
        F.col(doc_id).alias("_id"), F.col(lang).alias("_lang"), F.col(source).alias("_source"), F.col(text).alias("_text")
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    counted = text_statistics(base, "_text").drop("_text").withColumn("base_failed", failed)
    rows = stored(counted, "quality-counts")
    keyed = _groups(rows, "_lang", "_source")
    grouped = stored(
        keyed.where(~F.col("base_failed") & F.col("_g").isNotNull()).select(
            "_g", *(x.cast("double").alias(f"x{i}") for i, x in enumerate(_vector()))
        ),
        "quality-vectors",
    )
    middles = stored(
        grouped.groupBy("_g").agg(*(F.percentile_approx(f"x{i}", 0.5, ACCURACY).alias(f"m{i}") for i in range(P))),
        "quality-middles",
    )
    off = grouped.join(middles, "_g").select(
        "_g", *((F.col(f"x{i}") - F.col(f"m{i}")).alias(f"o{i}") for i in range(P))
    )
    scales = stored(
        off.groupBy("_g").agg(
            *(
                F.greatest(1.4826 * F.percentile_approx(F.abs(f"o{i}"), 0.5, ACCURACY), F.lit(least)).alias(f"c{i}")
                for i, least in enumerate(STATISTICS.values())
            )
        ),
        "quality-scales",
    )
    scaled = stored(
        off.join(scales, "_g").select("_g", *((F.col(f"o{i}") / F.col(f"c{i}")).alias(f"z{i}") for i in range(P))),
        "quality-scaled",
    )
    z = [F.col(f"z{i}") for i in range(P)]
    starts = {"sum": total([x * x for x in z]), "max": F.greatest(*(F.abs(x) for x in z))}
    found = _estimates(scaled, starts, 0.5)
    for _ in range(STEPS):
        found = _estimates(scaled.join(found, "_g"), {s: _distance(s) for s in starts}, SHARE)
    better = F.element_at("inverse_sum", -1) <= F.element_at("inverse_max", -1)
    best = found.select(
        "_g",
        *(F.when(better, F.col(f"{c}_sum")).otherwise(F.col(f"{c}_max")).alias(f"{c}_best") for c in ("mean", "inverse")),
    )
    # The nearest share can be too narrow; distances are scaled so that their median is not above that of normal vectors.
    middle = (
        scaled.join(best, "_g").groupBy("_g").agg(F.percentile_approx(_distance("best"), 0.5, ACCURACY).alias("_middle"))
    )
    fitted = stored(middles.join(scales, "_g").join(best, "_g").join(middle, "_g"), "quality-fitted")
    scale = F.greatest(F.col("_middle") / chi_squared(0.0, P), F.lit(1.0))
    z = [((x - F.col(f"m{i}")) / F.col(f"c{i}")).alias(f"z{i}") for i, x in enumerate(_vector())]
    placed = keyed.join(fitted, "_g", "left").select("*", *z)
    distance = F.when(~F.col("base_failed"), _distance("best") / scale)
    return placed.select(
        F.col("_id").alias(doc_id),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        distance.alias("distance"),
        (~F.col("base_failed") & ~F.coalesce(distance > chi_squared(NORMAL_QUANTILE, P), F.lit(False))).alias("kept"),
    )
