"""Counts and reports over element tables.

All are hash aggregates of counts: each task adds up its own rows first, and only one row per group and task moves.
Where a report needs the name of a parent, counts are taken per parent id before the join, so that the join never sees
the leaves themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeledger.functions.names import label
from treeledger.operators.tree import parents_of
from treeledger.schema import TYPES


def _n(condition: Column | None = None) -> Column:
    return F.count(F.lit(1) if condition is None else F.when(condition, 1))


def _type_counts(kinds: list[str] = TYPES) -> list[Column]:
    return [_n(F.col("TYPE") == k).alias(f"n_{k.lower()}") for k in kinds]


def _known_total() -> Column:
    return sum((F.col(f"n_{k.lower()}") for k in TYPES[1:]), F.col(f"n_{TYPES[0].lower()}"))


def count_by(elements: DataFrame, *columns: str) -> DataFrame:
    return elements.groupBy(*columns).agg(_n().alias("n"))


def project_type_matrix(elements: DataFrame) -> DataFrame:
    """Counts of the four types per project, and their sum (other types are not counted)."""
    return elements.groupBy("PROJECT_ID").agg(*_type_counts()).withColumn("n_total", _known_total())


def one_pass_counts(elements: DataFrame) -> DataFrame:
    """Counts by type, by project and by both from one scan: ``PROJECT_ID, TYPE, n, level``.

    A single aggregate over GROUPING SETS; ``level`` is 2 for rows by type, 1 for rows by project and 0 for rows by
    both.  Each task adds up its own rows for all three sets before one shuffle.
    """
    sets = [[F.col("TYPE")], [F.col("PROJECT_ID")], [F.col("PROJECT_ID"), F.col("TYPE")]]
    return elements.groupingSets(sets, "PROJECT_ID", "TYPE").agg(_n().alias("n"), F.grouping_id().alias("level"))


def reports_from_counts(counts: DataFrame, labels: DataFrame) -> dict[str, DataFrame]:
    """``by_type``, ``by_project`` and ``matrix`` out of :func:`one_pass_counts`; they read only its few rows."""
    by_type = counts.where("level = 2").select("TYPE", "n")
    per_project = counts.where("level = 1").select("PROJECT_ID", "n")
    by_project = per_project.join(labels.select("PROJECT_ID", "PLOT_NAME"), "PROJECT_ID", "left").select(
        "PROJECT_ID",
        label("PLOT_NAME", "PROJECT_ID").alias("label"),
        F.coalesce("PLOT_NAME", F.lit("Unknown")).alias("label_or_unknown"),
        "n",
    )
    both = counts.where("level = 0")
    kinds = [F.sum(F.when(F.col("TYPE") == k, F.col("n")).otherwise(0)).alias(f"n_{k.lower()}") for k in TYPES]
    matrix = both.groupBy("PROJECT_ID").agg(*kinds).withColumn("n_total", _known_total())
    return {"by_type": by_type, "by_project": by_project, "matrix": matrix}


def labelled_projects(elements: DataFrame, labels: DataFrame) -> DataFrame:
    """Number of elements per project with a display name from ``labels`` (PROJECT_ID, PLOT_NAME)."""
    counts = count_by(elements, "PROJECT_ID")
    return counts.join(labels.select("PROJECT_ID", "PLOT_NAME"), "PROJECT_ID", "left").select(
        "PROJECT_ID",
        label("PLOT_NAME", "PROJECT_ID").alias("label"),
        F.coalesce("PLOT_NAME", F.lit("Unknown")).alias("label_or_unknown"),
        "n",
    )


def target_summary(elements: DataFrame, targets: DataFrame) -> DataFrame:
    """Counts per target project, zeros included.  ``n_total`` counts every type."""
    counts = elements.groupBy("PROJECT_ID").agg(_n().alias("n_total"), *_type_counts())
    numbers = ["n_total"] + [f"n_{k.lower()}" for k in TYPES]
    return targets.join(counts, "PROJECT_ID", "left").select(
        "PROJECT_ID", "PLOT_NAME", *[F.coalesce(c, F.lit(0)).alias(c) for c in numbers]
    )


def block_breakdown(elements: DataFrame, order: list[str]) -> DataFrame:
    """TABLE and INVERTER counts per project and parent name; equally named parents of a project are added up."""
    leaves = elements.where(F.col("TYPE").isin("TABLE", "INVERTER"))
    per_parent = leaves.groupBy("PROJECT_ID", "PARENT_ID").agg(*_type_counts(TYPES[2:]))
    parents = parents_of(elements, order, per_parent)
    named = per_parent.join(
        parents.select(F.col("ID").alias("PARENT_ID"), F.col("NAME").alias("block_name")), "PARENT_ID"
    )
    return named.groupBy("PROJECT_ID", "block_name").agg(
        F.sum("n_table").alias("n_table"),
        F.sum("n_inverter").alias("n_inverter"),
        (F.sum("n_table") + F.sum("n_inverter")).alias("n_total"),
    )


def rows_per_file(files: DataFrame, rows: DataFrame) -> DataFrame:
    """Number of sheet rows of each file, with a flag for files that have none."""
    counts = rows.groupBy("folder_name", "file_name").agg(_n().alias("n"))
    return files.join(counts, ["folder_name", "file_name"], "left").select(
        "folder_name",
        "file_name",
        F.coalesce("n", F.lit(0)).alias("n_rows"),
        F.col("n").isNull().alias("is_empty"),
    )


def lookup_stats(plots_by_name: DataFrame, survivors: DataFrame) -> DataFrame:
    """Sizes of the lookups: plots, element keys, projects as spelled, projects and ids ignoring case.

    Distinct values are spread over all tasks before they are counted, in one pass over the survivors.
    """
    return survivors.agg(
        plots_by_name.agg(_n()).scalar().alias("n_plots"),
        _n().alias("n_keys"),
        F.count_distinct("PROJECT_ID").alias("n_projects"),
        F.count_distinct(F.lower("PROJECT_ID")).alias("n_projects_nocase"),
        F.count_distinct(F.lower("ID")).alias("n_ids"),
    )


def project_elements(survivors: DataFrame) -> DataFrame:
    """Set of element ids of each project, as rows.

    The set stays in long form on purpose: an array per project would put a project of any size into one row.
    """
    return survivors.select("PROJECT_ID", "ID").distinct()


def reconcile(before: DataFrame, added: DataFrame, after: DataFrame) -> DataFrame:
    """Expected and actual number of rows after an append."""
    zero = F.lit(0).cast("bigint")
    sides = (
        before.agg(_n().alias("n_before")).select("n_before", zero.alias("n_added"), zero.alias("n_after"))
        .unionByName(added.agg(_n().alias("n_added")).select(zero.alias("n_before"), "n_added", zero.alias("n_after")))
        .unionByName(after.agg(_n().alias("n_after")).select(zero.alias("n_before"), zero.alias("n_added"), "n_after"))
    )
    return sides.agg(*[F.sum(c).alias(c) for c in sides.columns]).select(
        "n_before",
        "n_added",
        (F.col("n_before") + F.col("n_added")).alias("n_expected"),
        "n_after",
        (F.col("n_after") - F.col("n_before") - F.col("n_added")).alias("difference"),
        (F.col("n_after") == F.col("n_before") + F.col("n_added")).alias("passed"),
    )


def plot_presence(elements: DataFrame, targets: DataFrame) -> DataFrame:
    """PLOT rows found per target, and the overall advice.

    The advice is REUSE when the number of PLOT rows in target projects equals the number of targets, else CREATE.
    """
    found = elements.where("TYPE = 'PLOT'").groupBy("PROJECT_ID").agg(_n().alias("n_found"))
    per_target = targets.join(found, "PROJECT_ID", "left").select(
        "PROJECT_ID", "PLOT_NAME", F.coalesce("n_found", F.lit(0)).alias("n_found")
    )
    totals = per_target.agg(F.sum("n_found").alias("found"), _n().alias("wanted"))
    verdict = totals.select(F.when(F.col("found") == F.col("wanted"), "REUSE").otherwise("CREATE")).scalar()
    missing = totals.select(F.col("wanted") - F.col("found")).scalar()
    return per_target.withColumns(
        {"is_present": F.col("n_found") > 0, "advice": verdict, "n_to_create": missing}
    )


def summary_long(elements: DataFrame, targets: DataFrame) -> DataFrame:
    """The verification summary as (section, item, n): the total, counts by type, counts by target.

    All three come from the counts per project and type, so the elements are read and shuffled once.
    """
    base = count_by(elements, "PROJECT_ID", "TYPE")
    total = base.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    total = total.select(F.lit("total").alias("section"), F.lit("rows").alias("item"), "n")
    by_type = base.groupBy("TYPE").agg(F.sum("n").alias("n"))
    by_type = by_type.select(F.lit("type").alias("section"), F.col("TYPE").alias("item"), "n")
    measures = {"n_total": F.lit(True)} | {f"n_{k.lower()}": F.col("TYPE") == k for k in TYPES}
    per_target = (
        targets.join(base, "PROJECT_ID", "left")
        .groupBy("PLOT_NAME")
        .agg(*[F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).alias(m) for m, c in measures.items()])
        .unpivot(["PLOT_NAME"], list(measures), "measure", "n")
    )
    by_target = per_target.select(
        F.lit("target").alias("section"), F.concat_ws(":", "PLOT_NAME", "measure").alias("item"), "n"
    )
    return total.unionByName(by_type).unionByName(by_target)


def compare_new_master(new: DataFrame, master: DataFrame, targets: DataFrame) -> DataFrame:
    """Counts per target project and type among the new elements and in the master."""
    def side(df: DataFrame, n: str) -> DataFrame:
        counts = df.groupBy("PROJECT_ID", "TYPE").agg(_n().alias(n))
        return counts.join(targets.select("PROJECT_ID").distinct(), "PROJECT_ID", "left_semi")

    both = side(new, "n_new").join(side(master, "n_master"), ["PROJECT_ID", "TYPE"], "full")
    return both.select(
        "PROJECT_ID",
        "TYPE",
        F.coalesce("n_new", F.lit(0)).alias("n_new"),
        F.coalesce("n_master", F.lit(0)).alias("n_master"),
        F.col("n_new").isNotNull().alias("in_new"),
        F.col("n_master").isNotNull().alias("in_master"),
    )
