"""Packing rows into spreadsheet files, so that the file sources have files to read."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
# A worker gets this many workbooks at once, and has the rows of one of them as Python objects.
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_FILES = 16
LINKS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"


def sheet_xml(rows: list[list[str | None]], shared: dict[str, int] | None = None, dimension: str | None = None) -> str:
    """One sheet.  Texts go inline, or by number if ``shared`` is given (it is filled on the way)."""
    from xml.sax.saxutils import escape

    out = [f'<worksheet xmlns="{MAIN}">', f'<dimension ref="{dimension}"/>' if dimension else "", "<sheetData>"]
    for i, row in enumerate(rows, start=1):
        out.append(f'<row r="{i}">')
        for letter, value in zip("ABCDEFGH", row):
            if value is None:
                out.append(f'<c r="{letter}{i}"/>')
            elif shared is None:
                out.append(f'<c r="{letter}{i}" t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>')
            else:
                out.append(f'<c r="{letter}{i}" t="s"><v>{shared.setdefault(value, len(shared))}</v></c>')
        out.append("</row>")
    return "".join([*out, "</sheetData></worksheet>"])


def pack(sheets: dict[str, str], shared: dict[str, int] | None = None, active: int = 0) -> bytes:
    """A workbook of the given sheets (name to XML)."""
    import io
    import zipfile
    from xml.sax.saxutils import escape

    names = list(sheets)
    parts = {
        "[Content_Types].xml": f'<Types xmlns="{PACKAGE}/content-types"/>',
        "_rels/.rels": f'<Relationships xmlns="{PACKAGE}/relationships">'
        f'<Relationship Id="rId1" Type="{LINKS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{LINKS}"><bookViews><workbookView activeTab="{active}"/></bookViews><sheets>'
        + "".join(f'<sheet name="{escape(n)}" sheetId="{i}" r:id="rId{i}"/>' for i, n in enumerate(names, 1))
        + "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE}/relationships">'
        + "".join(
            f'<Relationship Id="rId{i}" Type="{LINKS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1)
        )
        + "</Relationships>",
    }
    for i, name in enumerate(names, 1):
        parts[f"xl/worksheets/sheet{i}.xml"] = sheets[name]
    if shared is not None:
        items = "".join(f'<si><t xml:space="preserve">{escape(t)}</t></si>' for t in shared)
        parts["xl/sharedStrings.xml"] = f'<sst xmlns="{MAIN}">{items}</sst>'
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, text)
    return buffer.getvalue()


def _records(batch: pa.RecordBatch) -> Iterator[dict]:
    """The rows of a batch as Python objects, one at a time."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _written(counts: DataFrame) -> int:
    """Run a task function that writes files from small batches; the sum of its column ``n``."""
    conf = counts.sparkSession.conf
    before = conf.get(BATCH_SETTING, None)
    conf.set(BATCH_SETTING, str(BATCH_FILES))
    try:
        return counts.agg(F.sum("n")).first()[0] or 0
    finally:
        conf.unset(BATCH_SETTING) if before is None else conf.set(BATCH_SETTING, before)


def write_workbooks(rows: DataFrame, root: str, header: tuple[str, str]) -> int:
    """Write rows (folder_name, file_name, o_orderkey, table_raw, inverter_raw, is_bad) as workbooks; returns how many.

    The caller bounds the rows of a file.  A bad row gets a third cell.  Files go through the file system of ``root``,
    and a task that runs again writes the same bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for record in _records(batch):
                shared = {} if len(record["cells"]) % 2 else None
                grid = [list(header)]
                grid += [[c["table_raw"], c["inverter_raw"]] + (["extra"] if c["is_bad"] else []) for c in record["cells"]]
                sheet = sheet_xml(grid, shared)
                folder = f"{base}/{record['folder_name']}"
                system.create_dir(folder, recursive=True)
                with system.open_output_stream(f"{folder}/{record['file_name']}") as out:
                    out.write(pack({"DWG Data": sheet}, shared))
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["n"])

    books = rows.groupBy("folder_name", "file_name").agg(
        F.array_sort(F.collect_list(F.struct("o_orderkey", "table_raw", "inverter_raw", "is_bad"))).alias("cells")
    )
    return _written(books.mapInArrow(run, "n bigint"))


def write_files(files: DataFrame, root: str) -> int:
    """Write files (folder_name, file_name, content) below ``root`` as they are; returns how many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for record in _records(batch):
                folder = f"{base}/{record['folder_name']}"
                system.create_dir(folder, recursive=True)
                with system.open_output_stream(f"{folder}/{record['file_name']}") as out:
                    out.write(record["content"])
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return _written(files.mapInArrow(run, "n bigint"))


def make_folders(folders: DataFrame, root: str) -> int:
    """Create the folders named in column ``d`` below ``root``, empty; returns how many rows were seen."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(root)
        for batch in batches:
            for name in batch.column("d").to_pylist():
                system.create_dir(f"{base}/{name}", recursive=True)
            yield pa.record_batch([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return folders.select("d").mapInArrow(run, "n bigint").agg(F.sum("n")).first()[0] or 0
