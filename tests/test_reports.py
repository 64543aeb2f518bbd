"""Counts by type, by project and by both from one scan."""

from conftest import rows

from treeledger.operators import rollups
from treeledger.session import scratch_path

ELEMENTS = [
    ("a", "P1", "PLOT"), ("b", "P1", "BLOCK"), ("c", "P1", "TABLE"), ("d", "P1", "TABLE"), ("e", "P2", "INVERTER"),
    ("f", None, "TABLE"), ("g", "P2", None), ("h", "P2", "OTHER"), ("h", "P2", "OTHER"),
]


def test_one_scan_gives_all_three(spark):
    path = scratch_path(spark, "report-elements")
    spark.createDataFrame(ELEMENTS, "ID string, PROJECT_ID string, TYPE string").write.parquet(path)
    new = spark.read.parquet(path)
    labels = spark.createDataFrame([("P1", "Plot one")], "PROJECT_ID string, PLOT_NAME string")
    counts = rollups.one_pass_counts(new)
    made = rollups.reports_from_counts(counts, labels)
    assert rows(made["by_type"]) == rows(rollups.count_by(new, "TYPE"))
    assert rows(made["by_project"]) == rows(rollups.labelled_projects(new, labels))
    assert rows(made["matrix"]) == rows(rollups.project_type_matrix(new))
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Expand" in plan
