"""Helpers that several operators share."""

from __future__ import annotations

import string
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger.session import scratch_path

# Words are runs of characters other than ASCII white space.
SPACES = "[\\x20\\x09-\\x0D]+"


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write once to the shared scratch folder and read again.

    Cuts the lineage in a way that survives lost executors, and gives the planner the true size of the table, so that
    it broadcasts the table only while it is small.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once per row, also where a lambda inside the body uses it."""
    return F.transform(F.array(value), body)[0]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the table does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder_of_id(doc_id: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % modulus


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)
