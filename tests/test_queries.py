"""Every registered query against its SQL on the smallest data folder."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

from treeledger.plans.catalog import QUERIES
from treeledger.plans.oracle import ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, sf_dir, name):
    assert difference(entry.queries()[name](spark, sf_dir), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).columns == ["ID", "PROJECT_ID", "NAME", "TYPE", "PARENT_ID"]


def test_no_plan_crosses_or_runs_python_on_rows(spark, sf_dir):
    """Only reading spreadsheet files and listing folders need Python."""
    reads_sheets = {"extract_workbooks", "workbook_run_stats", "workbook_run_status", "scan_sheet_files", "scan_sheet_rows", "scan_sheet_cells", "workbook_errors", "empty_folders"}
    for name in sorted(set(QUERIES) - {"incremental_extract", "incremental_errors"}):
        plan = entry.queries()[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
        assert name in reads_sheets or not any(w in plan for w in ("Python", "MapInArrow")), name
