"""Spreadsheet files: finding them with a file scan and reading their cells inside the tasks."""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger.functions.names import path_parts
from treeledger.session import scratch_path

# Tasks get the functions of this module by value, so the package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CELLS = (
    "folder_name string, file_name string, sheet_name string, is_active boolean, row_idx bigint, col_idx bigint,"
    " value string, is_blank boolean, width bigint, error string"
)
ROWS = "folder_name string, file_name string, row_idx bigint, table_raw string, inverter_raw string, error string"
BATCH = 8192
LAST_ROW = 1 << 20  # of the file format


def scan_files(spark: SparkSession, root: str, pattern: str = "*.xlsx", folders: str = "*") -> DataFrame:
    """Files right inside the direct sub-folders of ``root``: path, length, content, folder_name, file_name.

    A missing or empty root raises.  The content is only read if a later step asks for it, and never that of a file
    that is longer than Spark can hold as one value: its content is null, which readers report as an error.  The driver
    holds the list of files, so a tree of very many files is read in slices of ``folders``, or by incremental runs.
    """
    files = load_files(spark.read, root, pattern, folders)
    hidden = hidden_files(spark, root, pattern, folders)
    if not hidden:
        return files
    shadow = scratch_path(spark, "hidden")
    mirror(spark, hidden, shadow)
    return files.unionByName(load_files(spark.read, shadow, pattern="*", mirrored=True))


def load_files(reader, root: str, pattern: str, folders: str = "*", mirrored: bool = False) -> DataFrame:
    """The files that ``reader``, for a batch or a stream, sees below ``root``."""
    found = reader.format("binaryFile").option("pathGlobFilter", pattern)
    if hasattr(reader, "table") and "Stream" in type(reader).__name__:
        found = found.schema("path string, modificationTime timestamp, length bigint, content binary")
    found = found.load(folders_of(root, folders))
    limit = int(found.sparkSession.conf.get("spark.sql.sources.binaryFile.maxLength"))
    # The listed length sorts files out before tasks are made, so each file is opened by one of the two scans, and the
    # content of a longer file is not asked for.
    fits = F.col("_metadata.file_size") <= limit
    longer = with_names(found.where(~fits), root).withColumn("content", F.lit(None).cast("binary"))
    files = with_names(found.where(fits), root).unionByName(longer)
    if mirrored:
        files = files.withColumns({c: F.expr(f"substr({c}, 2)") for c in ("folder_name", "file_name")})
    return files


def hidden_files(spark: SparkSession, root: str, pattern: str = "*.xlsx", folders: str = "*") -> list:
    """Files whose name or folder begins with ``_`` or ``.``; Spark's own listing leaves them out."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    base = root.rstrip("/")
    system = fs_path(base).getFileSystem(spark._jsc.hadoopConfiguration())

    def hidden(glob: str) -> list[str]:
        return [f"[_.]{glob}"] if glob[:1] == "*" else [glob] if glob[:1] in "_." else []

    globs = [f"{base}/{folders}/{p}" for p in hidden(pattern)] + [f"{base}/{f}/{pattern}" for f in hidden(folders)]
    found = {}
    for glob in globs:
        for status in system.globStatus(fs_path(glob)) or []:
            if status.isFile():
                found[status.getPath().toString()] = status
    return [found[k] for k in sorted(found)]


def mirror(spark: SparkSession, hidden: list, shadow: str) -> None:
    """Copy hidden files to ``shadow`` under names that Spark lists: folder and file get a letter in front.

    Such files are few, and a file that is there already with its length is not copied again.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for status in hidden:
        source = status.getPath()
        target = jvm.org.apache.hadoop.fs.Path(f"{shadow}/x{source.getParent().getName()}/x{source.getName()}")
        system = target.getFileSystem(conf)
        if not system.exists(target) or system.getFileStatus(target).getLen() != status.getLen():
            from_system = source.getFileSystem(conf)
            jvm.org.apache.hadoop.fs.FileUtil.copy(from_system, source, system, target, False, True, conf)


def folders_of(root: str, folders: str = "*") -> str:
    """The pattern of the sub-folders; Spark lists the matching folders in parallel."""
    return f"{root.rstrip('/')}/{folders}/"


def with_names(files: DataFrame, root: str) -> DataFrame:
    """Add folder and file name; files that lie in ``root`` itself match the folder pattern too and are left out."""
    plain = re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", root) if ":" in root else os.path.abspath(root)
    depth = len([part for part in plain.split("/") if part]) + 2
    folder, name = path_parts("path")
    inside = files.where(F.col("path").rlike(rf"^(?:[A-Za-z][\w+.-]*:)?(?://[^/]*)?(?:/+[^/]+){{{depth}}}\z"))
    return inside.select("path", "modificationTime", "length", "content", folder.alias("folder_name"), name.alias("file_name"))


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _column_number(reference: str) -> int:
    number = 0
    for ch in reference:
        if not ch.isalpha():
            break
        number = number * 26 + ord(ch.upper()) - 64
    return number


def _text(node) -> str:
    """Text of a string item: plain and rich runs, without phonetic hints."""
    parts = []
    for child in node:
        if _local(child.tag) == "t":
            parts.append(child.text or "")
        elif _local(child.tag) == "r":
            parts.extend(t.text or "" for t in child if _local(t.tag) == "t")
    return "".join(parts)


def _cell(node, shared: list[str]) -> tuple[str | None, bool]:
    """Text of a cell and whether the value counts as blank.  Zero and FALSE count as blank."""
    kind = node.get("t", "n")
    value = next((c for c in node if _local(c.tag) == "v"), None)
    if kind == "inlineStr":
        inline = next((c for c in node if _local(c.tag) == "is"), None)
        text = None if inline is None else _text(inline)
        return text, not text
    raw = None if value is None else value.text
    if raw is None:
        return None, True
    if kind == "s":
        text = shared[int(raw)]
        return text, not text
    if kind == "b":
        return ("True", False) if raw.strip() == "1" else ("False", True)
    if kind == "n":
        number = float(raw) if any(c in raw for c in ".eE") else int(raw)
        return str(number), number == 0
    return raw, not raw


def _sheets(book) -> list[tuple[str, str, bool]]:
    """(name, part, is_active) of the worksheets of an open archive."""
    from xml.etree import ElementTree as ET

    targets = {r.get("Id"): r.get("Target") for r in ET.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    names, active = [], 0
    for node in ET.fromstring(book.read("xl/workbook.xml")).iter():
        if _local(node.tag) == "workbookView":
            active = int(node.get("activeTab", 0))
        elif _local(node.tag) == "sheet":
            rid = next(v for k, v in node.attrib.items() if _local(k) == "id")
            target = targets[rid]
            names.append((node.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
    return [(name, part, i == active) for i, (name, part) in enumerate(names)]


def _sheet_rows(book, part: str, shared: list[str]) -> Iterator[tuple[int, int, dict[int, tuple[str | None, bool]]]]:
    """(row number, row width, cells by column) of every row up to the last one, gaps included, one at a time."""
    from xml.etree import ElementTree as ET

    width = None
    expected = 1
    column = 0
    data = None
    with book.open(part) as stream:
        for event, node in ET.iterparse(stream, events=("start", "end")):
            tag = _local(node.tag)
            if event == "start":
                data = node if tag == "sheetData" else data
                continue
            if tag == "dimension":
                width = _column_number(node.get("ref", "A1").rsplit(":", 1)[-1]) or None
            elif tag == "row":
                number = int(node.get("r", expected))
                if not 0 < number <= LAST_ROW:
                    raise ValueError(f"row number {number} is not one of the format")
                cells, column = {}, 0
                for c in node:
                    column = _column_number(c.get("r", "")) or column + 1
                    cells[column] = _cell(c, shared)
                for gap in range(expected, number):
                    yield gap, width or 0, {}
                expected = number + 1
                yield number, width or (max(cells) if cells else 0), cells
                node.clear() if data is None else data.clear()


def _open(content: bytes | None):
    import io
    import zipfile
    from xml.etree import ElementTree as ET

    if content is None:
        raise ValueError("the file is too long to be read")
    book = zipfile.ZipFile(io.BytesIO(content))
    shared: list[str] = []
    if "xl/sharedStrings.xml" in book.namelist():
        root = ET.fromstring(book.read("xl/sharedStrings.xml"))
        # Fixed rule of the file format's usual readers: an escaped underscore loses its escape.
        shared = [_text(si).replace("x005F_", "") for si in root if _local(si.tag) == "si"]
    return book, shared


def _read_cells(folder: str, name: str, content: bytes) -> Iterator[tuple]:
    """Cell tuples of all sheets of one file; a failure ends the file with one tuple that carries the error."""
    try:
        book, shared = _open(content)
        for sheet, part, active in _sheets(book):
            for row, width, cells in _sheet_rows(book, part, shared):
                for column, (value, blank) in cells.items():
                    if value is not None and column <= (width or column):
                        yield folder, name, sheet, active, row, column, value, blank, width, None
    except Exception as e:  # the file is bad, not the job
        yield folder, name, None, None, None, None, None, None, None, f"{type(e).__name__}: {e}"


def _read_rows(folder: str, name: str, content: bytes) -> Iterator[tuple]:
    """Data rows of the active sheet of one file.  A row that is not two wide ends the file with an error."""
    row = 1
    try:
        book, shared = _open(content)
        part = next(part for _, part, active in _sheets(book) if active)
        for row, width, cells in _sheet_rows(book, part, shared):
            if row == 1:
                continue
            if width != 2:
                raise ValueError(f"row {row} has {width} columns instead of 2")
            pair = [None if blank else value for value, blank in (cells.get(c, (None, True)) for c in (1, 2))]
            yield folder, name, row, pair[0], pair[1], None
    except Exception as e:
        yield folder, name, None, None, None, f"{type(e).__name__}: {e}"


def _in_batches(read, schema: pa.Schema):
    """A task function: files in, record batches of bounded size out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending: list[tuple] = []
        for batch in batches:
            folders, files, contents = (batch.column(c) for c in ("folder_name", "file_name", "content"))
            for i in range(batch.num_rows):
                for record in read(folders[i].as_py(), files[i].as_py(), contents[i].as_py()):
                    pending.append(record)
                    if len(pending) == BATCH:
                        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*pending), schema.types)], schema=schema)
                        pending = []
        if pending:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*pending), schema.types)], schema=schema)

    return run


def _parse(files: DataFrame, read, ddl: str) -> DataFrame:
    kinds = {"string": pa.string(), "bigint": pa.int64(), "boolean": pa.bool_()}
    schema = pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(","))])
    return files.select("folder_name", "file_name", "content").mapInArrow(_in_batches(read, schema), ddl)


def sheet_rows(files: DataFrame) -> DataFrame:
    """Data rows of the active sheet: row_idx, table_raw, inverter_raw.

    A file that cannot be read, or a row that is not exactly two wide, gives one row with ``error`` set and a null
    row_idx; the rows before it are kept.
    """
    return _parse(files, _read_rows, ROWS)


def sheet_cells(files: DataFrame) -> DataFrame:
    """Non-empty cells of all sheets, header included.  ``is_blank`` marks values that count as empty."""
    return _parse(files, _read_cells, CELLS)


def row_errors(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("error").isNotNull()).select("folder_name", "file_name", "error")


def readable(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("error").isNull()).drop("error")


def unpivot_cells(rows: DataFrame, sheet_name: Column | None = None) -> DataFrame:
    """Cells of two-column rows, in the shape of :func:`sheet_cells`, for rows that do not come from files."""
    name = F.lit(None).cast("string") if sheet_name is None else sheet_name
    pair = F.inline(
        F.array(
            F.struct(F.lit(1).alias("col_idx"), F.col("table_raw").alias("value")),
            F.struct(F.lit(2).alias("col_idx"), F.col("inverter_raw").alias("value")),
        )
    )
    return rows.select("folder_name", "file_name", name.alias("sheet_name"), "row_idx", pair).where("value is not null")
