"""Checks and repairs on small trees."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from treeledger.operators import repair, rollups, tree, verify
from treeledger.schema import ELEMENT_FIELDS

IDS = [c * 8 + "-0000-0000-0000-" + c * 12 for c in "abcdef"]
DDL = "ord int, ID string, PROJECT_ID string, NAME string, TYPE string, PARENT_ID string"


def frame(spark, *data):
    return spark.createDataFrame([(i, *d) for i, d in enumerate(data)], DDL)


def test_hierarchy_issues(spark):
    new = frame(
        spark,
        ("p", "x", "P", "PLOT", "odd"),
        ("b", "x", "B", "BLOCK", "p"),
        ("t", "x", "T", "TABLE", "old"),
        ("u", "x", "U", "TABLE", "none"),
        ("i", "x", "I", "INVERTER", ""),
        ("z", "x", "Z", "OTHER", ""),
    )
    own = rows(verify.hierarchy_issues(new), "kind", "ID")
    assert own == [("empty_parent", "i"), ("parent_not_found", "t"), ("parent_not_found", "u"), ("plot_has_parent", "p")]
    master = frame(spark, ("old", "x", "O", "BLOCK", ""))
    assert ("parent_not_found", "t") not in rows(verify.hierarchy_issues(new, master), "kind", "ID")
    issues = verify.hierarchy_issues(new)
    assert rows(verify.issue_summary(issues, issues)) == [("empty_parent", 2), ("parent_not_found", 4), ("plot_has_parent", 2)]
    assert rows(verify.first_issues(issues, 3), "kind", "ID", "n_more") == [
        ("empty_parent", "i", 1), ("parent_not_found", "t", 1), ("parent_not_found", "u", 1)
    ]


def test_tree_operators(spark):
    e = frame(
        spark,
        ("p", "x", "A-1a", "PLOT", ""),
        ("b", "x", "BL1", "BLOCK", "p"),
        ("b", "x", "BL2", "BLOCK", "p"),
        ("t", "x", "R1-S1", "TABLE", "b"),
        ("q", "x", "R2-S1", "TABLE", "gone"),
        ("i", "x", "I1", "INVERTER", "b"),
    )
    assert rows(tree.children_with_parent(e, ["ord"]), "ID", "parent_name") == [("i", "BL1"), ("t", "BL1")]
    assert rows(tree.element_paths(e, ["ord"]), "path", "depth") == [
        ("A-1a", 1), ("A-1a/BL1", 2), ("A-1a/BL1/I1", 3), ("A-1a/BL1/R1-S1", 3), ("A-1a/BL2", 2), ("R2-S1", 1)
    ]
    assert tuple(tree.sample_chain(e, ["ord"]).first()) == ("p", "A-1a", "b", "BL1", "t", "R1-S1", "i", "I1")
    assert tuple(tree.sample_chain(e.where("TYPE = 'PLOT'"), ["ord"]).first()) == ("p", "A-1a", *[None] * 6)
    assert rows(rollups.block_breakdown(e, ["ord"])) == [("x", "BL1", 1, 1, 2)]


def test_presence_advice(spark):
    e = frame(spark, ("p", "x", "A", "PLOT", ""))
    targets = spark.createDataFrame([("x", "A"), ("y", "B")], "PROJECT_ID string, PLOT_NAME string")
    assert rows(rollups.plot_presence(e, targets), "PROJECT_ID", "n_found", "advice", "n_to_create") == [
        ("x", 1, "CREATE", 1), ("y", 0, "CREATE", 1)
    ]
    assert rows(rollups.plot_presence(e, targets.where("PROJECT_ID = 'x'")), "advice", "n_to_create") == [("REUSE", 0)]


def record(i, parent=""):
    return ",".join([IDS[i], "proj", f"n{i}", "TABLE", parent])


@pytest.mark.parametrize(
    "line, want",
    [
        (record(0), [(IDS[0], "n0", "")]),
        (record(0, IDS[5]) + record(1), [(IDS[0], "n0", IDS[5]), (IDS[1], "n1", "")]),
        (record(0) + record(1, IDS[5]) + record(2), [(IDS[0], "n0", ""), (IDS[1], "n1", IDS[5]), (IDS[2], "n2", "")]),
        (f'{IDS[0]},proj,"a, ""b""",TABLE,', [(IDS[0], 'a, "b"', "")]),
        (f'{IDS[0]},proj,"a,b",TABLE,{IDS[5]}' + record(1), [(IDS[0], "a,b", IDS[5]), (IDS[1], "n1", "")]),
        ("only,two", [("only", "", "")]),
        ("", [("", "", "")]),
    ],
)
def test_split_glued_lines(spark, line, want):
    lines = spark.createDataFrame([(1, line)], "line_no bigint, value string")
    got = repair.split_glued_lines(lines).orderBy("part").collect()
    assert [(r.ID, r.NAME, r.PARENT_ID) for r in got] == want


def test_truncate_and_detect(spark):
    lines = spark.createDataFrame([(1, record(0, IDS[5]) + record(1)), (2, record(2))], "line_no bigint, value string")
    assert rows(repair.glued_lines(lines), "line_no", "n_commas") == [(1, 8)]
    assert rows(repair.truncate_glued_lines(lines), "line_no", "ID", "PARENT_ID") == [(1, IDS[0], IDS[5] + IDS[1]), (2, IDS[2], "")]


def test_restore_missing_plot(spark):
    e = frame(
        spark,
        ("b1", "x", "B1", "BLOCK", "lost1"),
        ("b2", "y", "B2", "BLOCK", "lost2"),
        ("b3", "z", "B3", "BLOCK", "lost2"),
        ("b4", "w", "B4", "BLOCK", "lost1"),
        ("t", "w", "T", "TABLE", "lost3"),
    )
    fixed = repair.restore_missing_plot(e, "A-1a")
    # Both lost parents have two blocks; the first one seen is taken, with the project of its first block.
    assert rows(fixed.where("TYPE = 'PLOT'")) == [(5, "lost1", "x", "A-1a", "PLOT", "")]
    assert rows(repair.restore_missing_plot(fixed, "A-1a")) == rows(fixed)
    assert tuple(repair.verify_repair(fixed, "lost1").first()) == (6, 1, "x", "A-1a", "PLOT", "")
    assert tuple(repair.verify_repair(e, "lost1").first())[:2] == (5, 0)
    blank = e.withColumn("PROJECT_ID", F.lit(""))
    assert rows(repair.restore_missing_plot(blank, "A-1a")) == rows(blank.select("ord", *ELEMENT_FIELDS))
    assert rows(repair.restore_missing_plot(e.limit(0), "A-1a")) == []


def test_column_samples_look_past_the_header_rows_only(spark):
    data = [("f", "x", "s", r, 1, v) for r, v in enumerate(["title", "MMS", " ", *[f"R{i}-T{i}" for i in range(30)]], 1)]
    data += [("f", "x", "s", 3, 2, "B01-I5"), ("f", "x", "s", 9, 40, "I1")]
    cells = spark.createDataFrame(data, "folder_name string, file_name string, sheet_name string, row_idx bigint, col_idx int, value string")
    # Rows 1, 2, 3, 4 and 5 hold something, so sampling starts at row 6.
    assert rows(verify.header_candidates(cells), "row_idx", "n_cells") == [(1, 1), (2, 1), (3, 1), (4, 1), (5, 1)]
    got = verify.column_samples(cells)
    assert [r.sample for r in got.orderBy("rank").collect()] == [f"R{i}-T{i}" for i in range(2, 12)]
    assert rows(verify.column_patterns(cells), "col_idx", "has_table", "has_inverter", "has_block", "n_samples", "n_table_tags") == [
        (1, True, False, False, 10, 10)
    ]


def test_block_flag_and_table_tag_differ(spark):
    data = [("f", "x", "s", 1, 1, "h"), ("f", "x", "s", 2, 1, "B01-R42-S01"), ("f", "x", "s", 3, 1, "B01-I7")]
    cells = spark.createDataFrame(data * 1, "folder_name string, file_name string, sheet_name string, row_idx bigint, col_idx int, value string")
    more = cells.unionByName(cells.where("row_idx > 1").withColumn("row_idx", F.col("row_idx") + 4))
    row = verify.column_patterns(more).first()
    assert (row.has_table, row.has_inverter, row.has_block, row.n_table_tags, row.n_inverter_tags) == (False, True, True, 1, 1)


CELLS = "folder_name string, file_name string, sheet_name string, row_idx bigint, col_idx bigint, value string, is_blank boolean"


def test_zeros_are_no_samples_and_headers_are_compared_by_column(spark):
    def sheet(name, *grid):
        return [
            ("f", "x.xlsx", name, r, c, v, v in ("0", "False", ""))
            for r, row in enumerate(grid, 1)
            for c, v in enumerate(row, 1)
            if v is not None
        ]

    body = [["0", "R1-T1"] for _ in range(7)] + [["I-1", "R2-T1"]]
    one = sheet("one", ["a", None, "b"], [" sub ", "0"], *body)
    cells = spark.createDataFrame(one + sheet("two", ["a", "b"], ["x"]), CELLS)
    samples = verify.column_samples(cells).where("sheet_name = 'one' and col_idx = 1").collect()
    assert [r.sample for r in samples] == ["I-1"]  # the first five rows are headers, and the zeros do not count
    profile = {r.sheet_name: r for r in verify.sheet_profile(cells).collect()}
    assert profile["one"].header == profile["two"].header == "a|b" and not profile["one"].same_header
    assert profile["one"].max_col == 3 and profile["two"].max_row == 2
    headers = {(r.sheet_name, r.col_idx): r.header for r in verify.column_headers(cells).collect()}
    assert headers["one", 1] == "a | sub" and headers["one", 2] == "R1-T1" and headers["one", 3] == "b"
    no_text = spark.createDataFrame([("f", "x", "s", 1, 2, "0", True)], CELLS)
    assert verify.column_headers(no_text).first().header == "Col2"


def test_every_sheet_of_a_workbook_is_profiled(spark, tmp_path):
    from treeledger.plans.workbooks import pack, sheet_xml
    from treeledger.sources import sheets

    (tmp_path / "A16a - 5 MW").mkdir()
    book = {"DWG Data": sheet_xml([["T", "I"], ["R1-T1", "I-1"]]), "Notes": sheet_xml([["Remark"], ["B-1"], ["more"]])}
    (tmp_path / "A16a - 5 MW" / "x-A16a-BL01-R0.xlsx").write_bytes(pack(book))
    cells = sheets.sheet_cells(sheets.scan_files(spark, str(tmp_path)))
    profile = {r.sheet_name: (r.max_row, r.max_col, r.header) for r in verify.sheet_profile(cells).collect()}
    assert profile == {"DWG Data": (2, 2, "T|I"), "Notes": (3, 1, "Remark")}
    assert {(r.sheet_name, r.col_idx) for r in verify.column_headers(cells).collect()} == {("DWG Data", 1), ("DWG Data", 2), ("Notes", 1)}
