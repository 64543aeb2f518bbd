"""Incremental runs kept by a ledger of files: waves, a crash before the commit, a large ledger, hidden files."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from test_extract import FILES, MASTER, PLOTS, grids, named_parents, simulate
from treeledger.plans.workbooks import pack, sheet_xml
from treeledger.session import scratch_path
from treeledger.streaming import incremental, ledger

SCHEMA = "ord int, ID string, PROJECT_ID string, NAME string, TYPE string, PARENT_ID string"


def put(root, tables, wave):
    for folder, name in wave:
        (root / folder).mkdir(exist_ok=True)
        (root / folder / name).write_bytes(pack({"DWG Data": sheet_xml([["T", "I"], *tables[folder, name]])}))


@pytest.fixture()
def setup(spark, tmp_path):
    store = scratch_path(spark, "store")
    incremental.create_store(spark.createDataFrame(MASTER, SCHEMA), store)
    return store, spark.createDataFrame(PLOTS, "k_plot string, PROJECT_ID string"), grids(8)


def new_rows(spark, store):
    return incremental.read_store(spark, store).where("batch_id >= 0")


def test_waves_equal_one_run(spark, tmp_path, setup):
    store, plots, tables = setup
    numbers = []
    for wave in (sorted(FILES)[:3], sorted(FILES)[3:]):
        put(tmp_path, tables, wave)
        numbers.append(ledger.run(spark, str(tmp_path), store, plots))
    assert numbers == [0, 1]
    found = new_rows(spark, store)
    assert named_parents(found.collect()) == simulate(tables, False)
    # Nothing new: no batch, nothing written.
    before = rows(found)
    assert ledger.run(spark, str(tmp_path), store, plots) is None
    assert rows(new_rows(spark, store)) == before
    assert ledger.read_ledger(spark, store).count() == len(FILES)


def test_crash_before_the_commit_adds_nothing_twice(spark, tmp_path, setup):
    store, plots, tables = setup
    put(tmp_path, tables, sorted(FILES))
    from treeledger.sources import sheets

    # A run that wrote errors and rows and stopped before its ledger entry.
    incremental.upsert(store, plots)(sheets.scan_files(spark, str(tmp_path)), 0)
    half = rows(new_rows(spark, store).drop("batch_id"))
    errors = rows(incremental.read_errors(spark, store).drop("batch_id"))
    assert ledger.run(spark, str(tmp_path), store, plots) == 1
    assert rows(new_rows(spark, store).drop("batch_id")) == half
    assert rows(incremental.read_errors(spark, store).drop("batch_id")) == errors
    assert named_parents(new_rows(spark, store).collect()) == simulate(tables, False)


def test_a_large_ledger_stays_a_table(spark, tmp_path, setup):
    """A million seen files: the new ones are found by a join, and the driver gets none of the old ones."""
    store, plots, tables = setup
    seen = spark.range(1_000_000).select(
        F.concat(F.lit("file:/elsewhere/"), F.col("id").cast("string")).alias("path"),
        F.col("id").alias("length"),
        F.current_timestamp().alias("modificationTime"),
        F.lit(-5).cast("bigint").alias("batch_id"),
    )
    seen.write.parquet(ledger.ledger_of(store))
    put(tmp_path, tables, sorted(FILES)[:2])
    assert ledger.run(spark, str(tmp_path), store, plots) == 0
    assert ledger.read_ledger(spark, store).count() == 1_000_002
    plan = ledger.pending(spark, spark.read.parquet(ledger.ledger_of(store)).select(*ledger.KEYS), store)
    assert "Join" in plan._jdf.queryExecution().executedPlan().toString()


def test_hidden_files_seen_at_every_run(spark, tmp_path, setup):
    store, plots, tables = setup
    first, second = sorted(FILES)[:1], sorted(FILES)[1:2]
    put(tmp_path, tables, first)
    assert ledger.run(spark, str(tmp_path), store, plots) == 0
    folder, name = second[0]
    (tmp_path / folder).mkdir(exist_ok=True)
    (tmp_path / folder / f"_{name}").write_bytes(pack({"DWG Data": sheet_xml([["T", "I"], *tables[folder, name]])}))
    assert ledger.run(spark, str(tmp_path), store, plots) == 1
    assert {r.path.rsplit("/", 1)[-1] for r in ledger.read_ledger(spark, store).collect()} >= {f"x_{name}"} | {
        n for _, n in first
    }
