"""Comma-separated sources and the sinks."""

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from treeledger.operators.lookups import plot_projects
from treeledger.plans.append import append_and_report, repair_and_publish
from treeledger.schema import ELEMENT, ELEMENT_FIELDS
from treeledger.session import scratch_path
from treeledger.sources import sinks, tables
from treeledger.streaming import incremental


def put(tmp_path, text, name="t.csv"):
    (tmp_path / name).write_text(text, newline="")
    return str(tmp_path / name)


def test_columns_go_by_header_and_missing_ones_are_empty(spark, tmp_path):
    path = put(tmp_path, "NAME,EXTRA,ID,PROJECT_ID,TYPE\n n ,x,1,p,T\n\nm,,2,,\n")
    assert rows(tables.read_elements(spark, path)) == [("1", "p", " n ", "T", ""), ("2", "", "m", "", "")]


def test_quotes_and_line_breaks(spark, tmp_path):
    path = put(tmp_path, 'ID,PROJECT_ID,NAME,TYPE,PARENT_ID\n1,p,"a ""q"", b","T\nU",\n2,p,x,T,1')
    assert rows(tables.read_elements(spark, path, multi_line=True)) == [("1", "p", 'a "q", b', "T\nU", ""), ("2", "p", "x", "T", "1")]


def test_master_is_stripped_and_last_row_wins(spark, tmp_path):
    text = "ID,PROJECT_ID,NAME,TYPE,PARENT_ID\n 1 ,p,n,T,a\n2, P\t,N ,t,b\n3,p,other,T,\n"
    for multi_line in (True, False):
        got = tables.read_design_elements(spark, put(tmp_path, text), multi_line=multi_line)
        assert rows(got) == [("2", "P", "N", "t", "b"), ("3", "p", "other", "T", "")]


def test_row_order_spans_split_files(spark, tmp_path):
    n = 4000
    lines = "".join(f"{i},p,n{i % 50},T,{'x' * 20}\n" for i in range(n))
    path = put(tmp_path, "ID,PROJECT_ID,NAME,TYPE,PARENT_ID\n" + lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        master = tables.read_master(spark, path, multi_line=False)
        assert master.rdd.getNumPartitions() > 4
        assert sorted(int(r.ID) for r in tables.read_design_elements(spark, path, multi_line=False).collect()) == list(range(n - 50, n))
        ordered = master.orderBy("pos").select("ID").collect()
        assert [int(r.ID) for r in ordered] == list(range(n))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_plot_tables(spark, tmp_path):
    pp = put(tmp_path, "ID,PROJECT_ID,PLOT_ID,PLOT_NAME\n1, p1 ,x,A-1a\n2,p2,x, A-1b", "pp.csv")
    read = tables.read_plots_projects(spark, pp)
    assert rows(plot_projects(read.withColumnRenamed("pos", "ord"))) == [("A-1B", "x", "A-1b", "p2")]
    plots = put(tmp_path, "ID,LOCATION_ID,NAME\n x ,l1,A\nx,l2,B\n", "plots.csv")
    assert rows(tables.read_plots(spark, plots).drop("pos")) == [("x", "l2", "B", "")]
    projects = put(tmp_path, "ID,SPV_ID,NAME,TYPE,CATEGORY,RFI_COUNT,NC_COUNT\n1,s,J&K (x),Solar,PPA,5,bad\n", "projects.csv")
    assert rows(tables.read_projects(spark, projects)) == [("1", "s", "J&K (x)", "Solar", "PPA", 5, None)]


def elements(spark, *data):
    return spark.createDataFrame(data, ELEMENT)


def test_elements_go_out_and_come_back(spark):
    path = scratch_path(spark, "t")
    odd = elements(spark, ("1", "p", ' a "b", c ', "TABLE", ""), ("2", "p", "x\ny", "TABLE", "1"))
    assert sinks.write_elements(odd.withColumn("more", F.lit(1)), path, scratch_path(spark, "w"), "csv")
    assert rows(tables.read_elements(spark, path, multi_line=True)) == rows(odd)
    assert not sinks.write_elements(odd.limit(0), scratch_path(spark, "none"), scratch_path(spark, "w"))


def test_snapshot_never_overwrites(spark):
    base = scratch_path(spark, "s")
    df = elements(spark, ("1", "p", "n", "T", ""))
    stamp = spark.range(1).select(sinks.snapshot_stamp(F.lit("2025-11-14 01:02:03").cast("timestamp"))).first()[0]
    assert stamp == "20251114_010203"
    kept = sinks.snapshot(df, base, stamp)
    assert rows(spark.read.parquet(kept)) == rows(df)
    with pytest.raises(AnalysisException):
        sinks.snapshot(df, base, stamp)


def test_rewrite_publishes_versions(spark):
    base = scratch_path(spark, "v")
    one, two = elements(spark, ("1", "p", "n", "T", "")), elements(spark, ("2", "p", "n", "T", ""))
    assert sinks.current_version(spark, base) is None
    assert sinks.rewrite(one, base) == 1
    # Data that was written but never published is not seen.
    two.write.parquet(f"{base}/data/version=2-lost")
    assert rows(sinks.read_current(spark, base)) == rows(one)
    assert sinks.rewrite(sinks.read_current(spark, base).unionByName(two), base) == 2
    assert len(rows(sinks.read_current(spark, base))) == 2


def test_of_two_writers_of_a_version_one_fails(spark, monkeypatch):
    base = scratch_path(spark, "v")
    one, two = elements(spark, ("1", "p", "n", "T", "")), elements(spark, ("2", "p", "n", "T", ""))
    assert sinks.rewrite(one, base) == 1
    assert sinks.rewrite(one, base) == 2
    # The second writer began when version 1 was current.
    monkeypatch.setattr(sinks, "current_version", lambda *_: 1)
    with pytest.raises(FileExistsError):
        sinks.rewrite(two, base)
    assert rows(sinks.read_current(spark, base)) == rows(one)


def test_order_of_several_files_has_to_be_stated(spark, tmp_path):
    folder = tmp_path / "m"
    folder.mkdir()
    header = "ID,PROJECT_ID,NAME,TYPE,PARENT_ID\n"
    (folder / "part-99999-b.csv").write_text(header + "old,p,n,T,\n")
    (folder / "part-100000-a.csv").write_text(header + "new,p,n,T,\n")
    with pytest.raises(ValueError):
        tables.read_design_elements(spark, str(folder))
    read = lambda files: [r.ID for r in tables.read_design_elements(spark, str(folder), files=files).collect()]
    assert read("parts") == ["new"]
    assert read(["part-100000-a.csv", "part-99999-b.csv"]) == ["old"]
    with pytest.raises(ValueError):
        read(["part-100000-a.csv"])
    (folder / "part-99999-c.csv").write_text(header + "other,p,n,T,\n")  # a second write
    with pytest.raises(ValueError):
        read("parts")


def test_append_and_report(spark):
    path, work = scratch_path(spark, "m"), scratch_path(spark, "w")
    incremental.create_store(elements(spark, ("p0", "x", "A-1a", "PLOT", "")).withColumn("ord", F.lit(1)), path)
    new = elements(
        spark,
        ("b1", "x", "BL1", "BLOCK", "p0"),
        ("t1", "x", "R1-S1", "TABLE", "b1"),
        ("t2", "x", "R1-S2", "TABLE", "nowhere"),
        ("i1", "x", "I1", "INVERTER", ""),
    ).selectExpr("*", "'f' as folder_name", "'g' as file_name", "2L as row_idx", "1 as col_idx")
    labels = spark.createDataFrame([("x", "A-1a")], "PROJECT_ID string, PLOT_NAME string")
    for before in (1, 5):
        got = append_and_report(spark, new, path, work, labels, f"stamp{before}")
        assert tuple(got.reconciliation.first()) == (before, 4, before + 4, before + 4, 0, True)
    assert rows(got.by_type) == [("BLOCK", 1), ("INVERTER", 1), ("TABLE", 2)]
    assert rows(got.by_project, "label", "n") == [("A-1a", 4)]
    assert tuple(got.matrix.first()) == ("x", 0, 1, 2, 1, 4)
    assert rows(got.blocks) == [("x", "BL1", 1, 0, 1)]
    assert rows(got.issues, "kind", "NAME") == [
        ("empty_parent", "I1"), ("parent_not_found", "BL1"), ("parent_not_found", "R1-S2")
    ]
    assert spark.read.parquet(f"{work}/snapshots").count() == 1 + 5
    assert {r.batch_id for r in incremental.read_store(spark, path).collect()} == {-1, 0, 1}


def test_repair_and_publish_is_idempotent(spark):
    base, work = scratch_path(spark, "r"), scratch_path(spark, "w")
    broken = elements(spark, ("b1", "x", "BL1", "BLOCK", "lost")).withColumn("ord", F.lit(7))
    sinks.rewrite(broken, base)
    assert repair_and_publish(spark, base, "A-1a", work, "one") == 2
    assert rows(sinks.read_current(spark, base), *ELEMENT_FIELDS) == [
        ("b1", "x", "BL1", "BLOCK", "lost"), ("lost", "x", "A-1a", "PLOT", "")
    ]
    assert repair_and_publish(spark, base, "A-1a", work, "two") is None
