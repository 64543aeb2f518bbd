"""Row filters over element tables.  Types are compared exactly here; only keys ignore case."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.schema import ELEMENT_FIELDS


def of_type(elements: DataFrame, *types: str) -> DataFrame:
    return elements.where(F.col("TYPE").isin(*types))


def in_projects(elements: DataFrame, targets: DataFrame) -> DataFrame:
    """Elements whose project is one of the targets."""
    return elements.join(targets.select("PROJECT_ID").distinct(), "PROJECT_ID", "left_semi")


def named(elements: DataFrame, name: str, kind: str) -> DataFrame:
    """Elements of one exact name and type, in any project."""
    return elements.where((F.col("NAME") == name) & (F.col("TYPE") == kind))


def to_schema(df: DataFrame, fields: list[str] = ELEMENT_FIELDS, keep: list[str] | None = None) -> DataFrame:
    """Only the given fields, in order, as text; extra columns are dropped and missing values become empty text.

    Columns in ``keep`` follow unchanged.
    """
    present = set(df.columns)
    filled = [F.coalesce(F.col(c).cast("string"), F.lit("")) if c in present else F.lit("") for c in fields]
    return df.select(*[value.alias(c) for value, c in zip(filled, fields)], *(keep or []))
