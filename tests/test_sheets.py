"""Reading spreadsheet files that are packed here."""

import pytest
from conftest import rows

from treeledger.plans import workbooks
from treeledger.plans.workbooks import MAIN, pack, sheet_xml
from treeledger.sources import sheets

HEADER = ["MMS Table Names", "Inverter Names"]


def frame(spark, content, folder="A16a - 50 MW", name="x-A16a-BL01-R0.xlsx"):
    return spark.createDataFrame([(folder, name, bytearray(content))], "folder_name string, file_name string, content binary")


def read(spark, content):
    found = sheets.sheet_rows(frame(spark, content)).select("row_idx", "table_raw", "inverter_raw", "error").collect()
    return [tuple(r) for r in found]


def raw(*row_xml, dimension=None):
    dim = f'<dimension ref="{dimension}"/>' if dimension else ""
    return f'<worksheet xmlns="{MAIN}">{dim}<sheetData>{"".join(row_xml)}</sheetData></worksheet>'


@pytest.mark.parametrize("shared", [None, {}])
def test_texts_inline_and_shared(spark, shared):
    grid = [HEADER, [" B01-R1-S1 ", "B01-I1"], ["a<&b", None], [None, None]]
    got = read(spark, pack({"DWG Data": sheet_xml(grid, shared)}, shared))
    assert got == [(2, " B01-R1-S1 ", "B01-I1", None), (3, "a<&b", None, None), (4, None, None, None)]


def test_typed_cells(spark):
    cells = [
        ("", "7"), ("", "7.0"), ("", "1e3"), ("", "0"), ("", "0.0"), ('t="b"', "1"), ('t="b"', "0"), ('t="e"', "#N/A"), ('t="str"', "f"),
    ]
    body = [f'<row r="{i}"><c r="A{i}" {t}><v>{v}</v></c><c r="B{i}"/></row>' for i, (t, v) in enumerate(cells, start=2)]
    got = [r[1] for r in read(spark, pack({"s": raw(*body)})) if r[0] > 1]
    assert got == ["7", "7.0", "1000.0", None, None, "True", None, "#N/A", "f"]


def test_rich_text_without_phonetics(spark):
    item = "<si><r><t>B01-</t></r><r><t>I5</t></r><rPh><t>x</t></rPh></si>"
    book = pack({"s": raw('<row r="2"><c r="A2" t="s"><v>0</v></c><c r="B2"/></row>')}, {"placeholder": 0})
    import io
    import zipfile

    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(book)) as old, zipfile.ZipFile(out, "w") as new:
        for name in old.namelist():
            new.writestr(name, f'<sst xmlns="{MAIN}">{item}</sst>' if name.endswith("sharedStrings.xml") else old.read(name))
    assert read(spark, out.getvalue()) == [(2, "B01-I5", None, None)]


def test_row_of_other_width_ends_the_file(spark):
    grid = [HEADER, ["a", "b"], ["c", "d", "extra"], ["e", "f"]]
    got = read(spark, pack({"s": sheet_xml(grid)}))
    assert got[0] == (2, "a", "b", None)
    assert got[1][0] is None and "row 3 has 3 columns" in got[1][3] and len(got) == 2


def test_declared_width_fills_and_cuts_rows(spark):
    two = raw('<row r="1"/>', '<row r="2"><c r="A2" t="str"><v>a</v></c></row>', '<row r="4"><c r="C4" t="str"><v>z</v></c></row>', dimension="A1:B4")
    assert read(spark, pack({"s": two})) == [(2, "a", None, None), (3, None, None, None), (4, None, None, None)]
    three = raw('<row r="2"><c r="A2" t="str"><v>a</v></c></row>', dimension="A1:C2")
    assert "3 columns" in read(spark, pack({"s": three}))[0][3]


def test_gap_without_declared_width_is_an_error(spark):
    sheet = raw('<row r="3"><c r="A3" t="str"><v>a</v></c><c r="B3" t="str"><v>b</v></c></row>')
    assert "row 2 has 0 columns" in read(spark, pack({"s": sheet}))[0][3]


def test_cells_without_references(spark):
    sheet = raw("<row><c t='str'><v>h</v></c><c/></row>", "<row><c t='str'><v>a</v></c><c t='str'><v>b</v></c></row>")
    assert read(spark, pack({"s": sheet})) == [(2, "a", "b", None)]


def test_only_the_active_sheet_gives_rows_but_all_give_cells(spark):
    book = pack({"one": sheet_xml([HEADER, ["a", None]]), "two": sheet_xml([HEADER, ["b", None]])}, active=1)
    assert read(spark, book) == [(2, "b", None, None)]
    cells = sheets.sheet_cells(frame(spark, book))
    assert rows(cells.where("row_idx = 2"), "sheet_name", "is_active", "value") == [("one", False, "a"), ("two", True, "b")]


def test_bad_file_gives_one_error_and_spares_the_others(spark):
    good = frame(spark, pack({"s": sheet_xml([HEADER, ["a", "b"]])}))
    both = good.unionByName(frame(spark, b"junk", name="bad.xlsx"))
    found = sheets.sheet_rows(both)
    assert rows(sheets.readable(found), "table_raw") == [("a",)]
    assert rows(sheets.row_errors(found), "file_name") == [("bad.xlsx",)]


def test_many_rows_leave_in_several_batches(spark):
    n = sheets.BATCH + 5
    found = sheets.sheet_rows(frame(spark, pack({"s": sheet_xml([HEADER] + [[f"r{i}", None] for i in range(n)])})))
    assert found.count() == n and found.where(f"row_idx = {n + 1}").first()["table_raw"] == f"r{n - 1}"


def test_scan_takes_files_of_direct_subfolders_only(spark, tmp_path):
    book = pack({"s": sheet_xml([HEADER, ["a", None]])})
    for path in ["A16a - 50 MW/1.xlsx", "A16a - 50 MW/deep/2.xlsx", "B1 [x]/3.xlsx", "4.xlsx", "B1 [x]/note.txt"]:
        target = tmp_path / path
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(book)
    files = sheets.scan_files(spark, str(tmp_path))
    assert rows(files, "folder_name", "file_name") == [("A16a - 50 MW", "1.xlsx"), ("B1 [x]", "3.xlsx")]
    plan = files.select("folder_name")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema" in plan and "content" not in plan.split("ReadSchema")[-1]


def test_scan_without_folders_fails(spark, tmp_path):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException):
        sheets.scan_files(spark, str(tmp_path))


def test_packing_holds_one_workbook_as_objects(spark, tmp_path, monkeypatch):
    """However many workbooks a task packs, the rows of one at a time are Python objects."""

    def held(sheets, shared=None, active=0):
        import gc

        found = [o for o in gc.get_objects() if type(o) is list and o and type(o[0]) is dict and "table_raw" in o[0]]
        return str(len(found)).encode()

    monkeypatch.setattr(workbooks, "pack", held)
    rows = spark.range(120).selectExpr(
        "'A12a - 50 MW' as folder_name", "concat('f', id % 40, '.xlsx') as file_name", "id as o_orderkey",
        "'R1' as table_raw", "cast(null as string) as inverter_raw", "false as is_bad",
    ).coalesce(1)
    assert workbooks.write_workbooks(rows, str(tmp_path), ("T", "I")) == 40
    counts = [int(p.read_bytes()) for p in tmp_path.rglob("*.xlsx")]
    assert len(counts) == 40 and max(counts) <= 2


def test_each_file_is_opened_by_one_scan(spark, tmp_path):
    """Listing names opens no file twice: the scan for files that are too long gets only those."""
    for i in range(5):
        (tmp_path / "A12a - 50 MW").mkdir(exist_ok=True)
        (tmp_path / "A12a - 50 MW" / f"f{i}.xlsx").write_bytes(b"0" * (10 + i))
    files = sheets.scan_files(spark, str(tmp_path))
    assert files.select("file_name").rdd.getNumPartitions() <= 5 and files.count() == 5
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", "12")
    try:
        found = sheets.scan_files(spark, str(tmp_path)).select("file_name", "length", "content").collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    assert sorted((r.file_name, r.length, r.content is None) for r in found) == [
        (f"f{i}.xlsx", 10 + i, i > 2) for i in range(5)
    ]
