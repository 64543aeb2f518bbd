"""Comma-separated tables.  Columns are taken by header name; types are never inferred, every field is text."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger.functions.names import strip
from treeledger.operators.filters import to_schema
from treeledger.operators.order import keep_last
from treeledger.functions.keys import with_keys
from treeledger.schema import ELEMENT_FIELDS, KEY, PLOT_FIELDS, PLOT_PROJECT_FIELDS, PROJECT


def read_raw(
    spark: SparkSession,
    path: str,
    fields: list[str],
    multi_line: bool = False,
    positioned: bool = False,
    files: str | list[str] | None = None,
) -> DataFrame:
    """The named columns as they stand in the file; empty fields and missing columns give empty text.

    ``multi_line`` is needed for line breaks inside quotes and makes a file the unit of reading; without it Spark splits
    files.  ``positioned`` adds ``pos``, which sorts the rows as they stand in the files: by file, by place of the split
    in the file, by row of the split.  Several files have no order of their own: ``files`` names them in order, or says
    ``"parts"`` for the numbers of one write of Spark.
    """
    reader = spark.read.options(header=True, enforceSchema=False, escape='"', multiLine=multi_line)
    df = reader.csv(path)
    if not positioned:
        return to_schema(df, fields)
    # monotonically_increasing_id grows with the split, and the splits of a file with their place in it.
    place = F.struct(
        _file_number(df, files).alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return to_schema(df.select("*", place.alias("pos")), fields, keep=["pos"])


def _file_number(df: DataFrame, files: str | list[str] | None) -> Column:
    """Number of the file of a row in the order that ``files`` states."""
    names = [unquote(f).rstrip("/").rsplit("/", 1)[-1] for f in df.inputFiles()]
    if len(names) < 2:
        return F.lit(0)
    if files is None:
        raise ValueError(f"{len(names)} files have no order; pass files=[...], or files='parts' for one write of Spark")
    if files == "parts":
        numbers = [re.match(r"part-(\d+)", n) for n in names]
        if not all(numbers) or len({int(m[1]) for m in numbers}) < len(names):
            raise ValueError("the files are not the parts of one write; pass files=[...]")
        return F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("bigint")
    listed = [f.rsplit("/", 1)[-1] for f in files]
    if sorted(listed) != sorted(names) or len(set(names)) < len(names):
        raise ValueError("files has to name every file once, by names that differ")
    return F.array_position(F.lit(listed), F.col("_metadata.file_name"))


def _stripped(df: DataFrame, fields: list[str]) -> DataFrame:
    return df.withColumns({c: strip(c) for c in fields})


def read_plots_projects(spark: SparkSession, path: str, **options) -> DataFrame:
    """Which plot belongs to which project; ``pos`` holds the row order that decides between repeated plots."""
    return _stripped(read_raw(spark, path, PLOT_PROJECT_FIELDS, positioned=True, **options), PLOT_PROJECT_FIELDS)


def read_plots(spark: SparkSession, path: str, **options) -> DataFrame:
    """Plots; the last row of an ID counts, and ``DESIGN_ELEMENT_ID`` may be missing."""
    rows = _stripped(read_raw(spark, path, PLOT_FIELDS, positioned=True, **options), PLOT_FIELDS)
    return keep_last(rows, ["ID"], ["pos"])


def read_master(spark: SparkSession, path: str, **options) -> DataFrame:
    """The element master with stripped fields and the row order in ``pos``."""
    return _stripped(read_raw(spark, path, ELEMENT_FIELDS, positioned=True, **options), ELEMENT_FIELDS)


def read_design_elements(spark: SparkSession, path: str, **options) -> DataFrame:
    """The element master as it is looked up: the last row of each key."""
    return keep_last(with_keys(read_master(spark, path, **options)), KEY, ["pos"]).select(*ELEMENT_FIELDS)


def read_elements(spark: SparkSession, path: str, **options) -> DataFrame:
    """Elements exactly as written: nothing stripped, nothing dropped."""
    return read_raw(spark, path, ELEMENT_FIELDS, **options)


def read_projects(spark: SparkSession, path: str, **options) -> DataFrame:
    """Project dimension."""
    raw = read_raw(spark, path, PROJECT.fieldNames(), **options)
    return raw.select(
        *[
            (F.expr(f"try_cast({f.name} as int)") if f.dataType.typeName() == "integer" else F.col(f.name)).alias(f.name)
            for f in PROJECT.fields
        ]
    )


def read_lines(spark: SparkSession, path: str, header: str = ",".join(ELEMENT_FIELDS)) -> DataFrame:
    """Physical lines of text files without their header; ``line_no`` tells lines apart but is not dense."""
    lines = spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), "value")
    return lines.where(F.col("value") != header)
