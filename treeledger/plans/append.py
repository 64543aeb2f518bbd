"""Append to the master with reconciliation and reports, and repair of a master."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from treeledger.operators import repair, rollups, verify
from treeledger.schema import VISIT_ORDER
from treeledger.sources import sinks
from treeledger.streaming import incremental


@dataclass(frozen=True)
class AppendReport:
    """Tables that describe one append."""

    reconciliation: DataFrame
    by_type: DataFrame
    by_project: DataFrame
    matrix: DataFrame
    blocks: DataFrame
    issues: DataFrame


def report(new: DataFrame, order: list[str], labels: DataFrame, work: str | None = None) -> dict[str, DataFrame]:
    """Counts and checks of new elements.  Pass a written table, since the checks read it.

    Counts by type, by project and by both come from one scan of ``new``; with ``work`` given, that scan is written
    there once, so the three reports read a table of one row per group.
    """
    counts = rollups.one_pass_counts(new)
    if work is not None:
        counts = sinks.handoff(counts, work)
    return {
        **rollups.reports_from_counts(counts, labels),
        "blocks": rollups.block_breakdown(new, order),
        "issues": verify.hierarchy_issues(new),
    }


def append_and_report(
    spark: SparkSession, new: DataFrame, store_path: str, work: str, labels: DataFrame, stamp: str
) -> AppendReport:
    """Snapshot the master table, append ``new`` to it as its next batch, compare the counts and report.

    ``new`` has the elements with the place where they were met, as the extraction gives them.  Appending twice adds the
    rows twice: uniqueness is the extraction's task.
    """
    fresh = sinks.handoff(new, f"{work}/new-{stamp}")
    kept = sinks.snapshot(incremental.read_store(spark, store_path), f"{work}/snapshots", stamp)
    before = spark.read.parquet(kept)
    incremental.append(spark, fresh, store_path)
    after = incremental.read_store(spark, store_path)
    counts = f"{work}/counts-{stamp}"
    return AppendReport(rollups.reconcile(before, fresh, after), **report(fresh, VISIT_ORDER, labels, counts))


def repair_and_publish(spark: SparkSession, base: str, plot_name: str, work: str, stamp: str) -> int | None:
    """Restore a lost root row of the versioned master at ``base``; returns the new version, or None if all is well."""
    current = sinks.read_current(spark, base)
    repaired = repair.restore_missing_plot(current, plot_name)
    added = repaired.join(current.select("ID"), "ID", "left_anti")
    if added.isEmpty():
        return None
    sinks.snapshot(current, f"{work}/snapshots", stamp)
    return sinks.rewrite(repaired, base)
