"""Incremental runs: waves of files, replays, and equality with one batch."""

import os
import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from test_extract import FILES, MASTER, PLOTS, grids, named_parents, simulate
from treeledger.plans.workbooks import pack, sheet_xml
from treeledger.session import scratch_path
from treeledger.sources import sheets
from treeledger.streaming import incremental


@pytest.mark.parametrize("allow_duplicates", [False, True])
def test_waves_equal_one_run_and_a_replay_adds_nothing(spark, tmp_path, allow_duplicates):
    tables = grids(8)
    store = scratch_path(spark, "store")
    master = spark.createDataFrame(MASTER, "ord int, ID string, PROJECT_ID string, NAME string, TYPE string, PARENT_ID string")
    incremental.create_store(master, store)
    plots = spark.createDataFrame(PLOTS, "k_plot string, PROJECT_ID string")
    checkpoint, shadow = scratch_path(spark, "progress"), scratch_path(spark, "shadow")

    def run(progress):
        stream = incremental.file_stream(spark, str(tmp_path), shadow)
        incremental.start(stream, store, plots, progress, allow_duplicates).awaitTermination()
        return incremental.read_store(spark, store).where("batch_id >= 0")

    for wave in (sorted(FILES)[:3], sorted(FILES)[3:]):
        for folder, name in wave:
            (tmp_path / folder).mkdir(exist_ok=True)
            (tmp_path / folder / name).write_bytes(pack({"DWG Data": sheet_xml([["T", "I"], *tables[folder, name]])}))
        found = run(checkpoint)
    assert named_parents(found.collect()) == simulate(tables, allow_duplicates)
    before = rows(found)
    # A lost checkpoint replays every file at once.
    assert rows(run(scratch_path(spark, "progress"))) == before
    assert found.select(F.max("batch_id")).first()[0] == 1


def test_no_file_is_passed_over_without_a_trace(spark, tmp_path):
    """Old files, unreadable files, unknown folders, hidden names, files that are too long."""
    store, shadow, checkpoint = (scratch_path(spark, n) for n in ("store", "shadow", "progress"))
    schema = "ord int, ID string, PROJECT_ID string, NAME string, TYPE string, PARENT_ID string"
    incremental.create_store(spark.createDataFrame([], schema), store)
    plots = spark.createDataFrame([("A-16A", "007"), ("A-17A", "x1")], "k_plot string, PROJECT_ID string")
    sheet = lambda name: pack({"DWG Data": sheet_xml([["T", "I"], [name, None]])})

    def put(folder, name, content, age_days=0):
        (tmp_path / folder).mkdir(exist_ok=True)
        path = tmp_path / folder / name
        path.write_bytes(content)
        moment = time.time() - 86400 * age_days
        os.utime(path, (moment, moment))

    def run():
        stream = incremental.file_stream(spark, str(tmp_path), shadow)
        incremental.start(stream, store, plots, checkpoint).awaitTermination()

    put("A16a - 5 MW", "x-A16a-BL01-R0.xlsx", sheet("R1"))
    run()
    put("A16a - 5 MW", "x-A16a-BL02-R0.xlsx", sheet("R2"), age_days=400)
    put("A16a - 5 MW", "x-A16a-BL03-R0.xlsx", b"no workbook")
    put("A16a - 5 MW", "_x-A16a-BL04-R0.xlsx", sheet("R4"))
    put("Z99z - 5 MW", "x-Z99z-BL05-R0.xlsx", sheet("R5"))
    put(".hidden", "x-A16a-BL06-R0.xlsx", sheet("R6"))
    put("A17a - 5 MW", "x-A17a-BL07-R0.xlsx", sheet("R7"))
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "20000")
    try:
        put("A17a - 5 MW", "x-A17a-BL08-R0.xlsx", b"0" * 20001)
        run()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    found = incremental.read_store(spark, store)
    assert {r.NAME for r in found.where("TYPE = 'TABLE'").collect()} == {"R1", "R2", "R4", "R7"}
    # Project ids stay texts, numbers with leading zeros too.
    assert {r.PROJECT_ID for r in found.collect()} == {"007", "x1"}
    errors = incremental.read_errors(spark, store).collect()
    assert {(r.kind, r.folder_name, r.file_name) for r in errors} == {
        ("sheet_error", "A16a - 5 MW", "x-A16a-BL03-R0.xlsx"),
        ("sheet_error", "A17a - 5 MW", "x-A17a-BL08-R0.xlsx"),
        ("no_project", "Z99z - 5 MW", None),
        ("folder_name", ".hidden", None),
    }
    assert all(r.detail for r in errors if r.kind == "sheet_error") and {r.batch_id for r in errors} == {1}
    # A new checkpoint goes on counting batches, so later rows stay behind earlier ones.
    put("A16a - 5 MW", "x-A16a-BL09-R0.xlsx", sheet("R9"))
    checkpoint = scratch_path(spark, "progress")
    run()
    assert {r.batch_id for r in incremental.read_store(spark, store).where("NAME = 'R9'").collect()} == {2}
    # The same files in one batch.
    names = {r.file_name for r in sheets.scan_files(spark, str(tmp_path)).select("file_name").collect()}
    assert len(names) == 9
