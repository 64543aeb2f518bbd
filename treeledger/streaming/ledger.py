"""Incremental runs whose progress is a table: a ledger of the files that earlier runs used.

A run lists the files below the root (hidden names included, at every run), takes those that the ledger does not hold
with the same path, length and time of change by an anti join, extracts them as one batch against the store, and
appends them to the ledger last.  The ledger is a Parquet table beside the store, so nothing of what was seen stays on
the driver and its size does not matter: it is joined, not collected.

Writing the ledger last is the commit.  A run that stops before it is repeated whole by the next run, and adds nothing
twice: the extraction drops ids that the store already has, and the errors of a file count once however often they
were written (see :func:`treeledger.streaming.incremental.read_errors`).  A file that changes is taken again; its new
elements are appended, as in a stream.

Two runs at once on one store may take the same batch number; their rows then sort by folder, file and place inside
that batch, as rows of one batch do.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger.session import scratch_path
from treeledger.sources import sheets
from treeledger.streaming import incremental

LEDGER_SCHEMA = "path string, length bigint, modificationTime timestamp, batch_id bigint"
KEYS = ["path", "length", "modificationTime"]


def ledger_of(store_path: str) -> str:
    return f"{store_path.rstrip('/')}-files"


def read_ledger(spark: SparkSession, store_path: str) -> DataFrame:
    """The files that committed runs used; empty before the first."""
    try:
        found = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_of(store_path))
        found.limit(0).collect()
        return found
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def pending(spark: SparkSession, files: DataFrame, store_path: str) -> DataFrame:
    """Listed files that no committed run used with this path, length and time of change."""
    return files.join(read_ledger(spark, store_path).select(*KEYS), KEYS, "left_anti")


def run(
    spark: SparkSession, root: str, store_path: str, plots: DataFrame, allow_duplicates: bool = False
) -> int | None:
    """One incremental run over the files below ``root``; the number of its batch, or None when nothing was new."""
    files = sheets.scan_files(spark, root)
    # The names of the new files are written first, so the batch, the store and the ledger see the same ones.
    names = pending(spark, files.select(*KEYS), store_path)
    todo_path = scratch_path(spark, "ledger-todo")
    names.write.parquet(todo_path)
    todo = spark.read.schema("path string, length bigint, modificationTime timestamp").parquet(todo_path)
    if todo.limit(1).count() == 0:
        return None
    batch = files.join(todo, KEYS, "left_semi")
    number = incremental.upsert(store_path, plots, allow_duplicates)(batch, 0)
    todo.withColumn("batch_id", F.lit(number).cast("bigint")).write.mode("append").parquet(ledger_of(store_path))
    return number
