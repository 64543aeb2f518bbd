"""Incremental extraction: files arrive, new elements are appended to the master table.

Each micro-batch is one extraction against the master as it stands, so elements of one batch exist for the next.  Ids
are digests of keys, and a batch drops ids that the master already has before it appends, so a batch that is replayed
after a failure adds nothing twice, not even when every occurrence is created.

No file is passed over: files count however old they are and whatever their name begins with, and what keeps a file or
folder from being used is written to a table of errors beside the store.  Batches are numbered by the store, not by the
checkpoint, so the order of rows holds when a checkpoint is lost.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from treeledger.plans.extract import extract_located, extraction_errors, read_inputs, usable_files
from treeledger.schema import ELEMENT_FIELDS, VISIT_ORDER
from treeledger.session import scratch_path
from treeledger.sources import sheets, sinks

# Master rows are ordered by batch, then by the place where they were met.
STORE_ORDER = ["batch_id", *VISIT_ORDER]
STORE_FIELDS = [*ELEMENT_FIELDS, *STORE_ORDER, "k_project"]
# Given, not inferred: a project id that looks like a number stays a text.
STORE_SCHEMA = (
    ", ".join(f"{c} string" for c in ELEMENT_FIELDS)
    + ", batch_id bigint, folder_name string, file_name string, row_idx bigint, col_idx int, k_project string"
)
# The source forgets files older than this, counted from the newest: never.
ANY_AGE = "365000d"


def to_store(elements: DataFrame, batch_id: int) -> DataFrame:
    """Elements in the shape of the master table, which is partitioned by project."""
    return elements.withColumns(
        {"batch_id": F.lit(batch_id).cast("bigint"), "k_project": F.lower("PROJECT_ID")}
    ).select(*STORE_FIELDS)


def _placed(master: DataFrame, order: str) -> DataFrame:
    """Rows that come from no sheet, placed by a column of their own."""
    return master.withColumns(
        {
            "folder_name": F.lit(""), "file_name": F.lit(""),
            "row_idx": F.col(order).cast("bigint"), "col_idx": F.lit(0),
        }
    )


def create_store(master: DataFrame, path: str, order: str = "ord") -> None:
    """Write an initial master as the master table; its rows come before those of every batch."""
    _write(to_store(_placed(master, order), -1), path, "errorifexists")


def append(spark: SparkSession, elements: DataFrame, path: str, order: str | None = None) -> int:
    """Append elements to the master table as its next batch, behind all rows there are; returns the batch number.

    Elements of an extraction carry the place where they were met; others name the column that holds their ``order``.
    """
    number = _next_batch(spark, path)
    _write(to_store(_placed(elements, order) if order else elements, number), path, "append")
    return number


def _write(df: DataFrame, path: str, mode: str) -> None:
    # Rebalancing by project gives each project few files and splits a project that is too large for one task.
    df.hint("rebalance", "k_project").write.mode(mode).partitionBy("k_project").parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORE_SCHEMA).parquet(path)


def errors_of(store_path: str) -> str:
    """Where the errors of a store are: beside it, as the store's own folders are its projects."""
    return f"{store_path.rstrip('/')}-errors"


def read_errors(spark: SparkSession, store_path: str) -> DataFrame:
    """kind, folder_name, file_name, detail and batch_id of everything that was not used, with its first batch."""
    schema = "kind string, folder_name string, file_name string, detail string, batch_id bigint"
    found = spark.read.schema(schema).parquet(errors_of(store_path))
    first = F.min(F.struct("batch_id", "detail")).alias("first")
    return found.groupBy("kind", "folder_name", "file_name").agg(first).select(
        "kind", "folder_name", "file_name", "first.detail", "first.batch_id"
    )


def _next_batch(spark: SparkSession, store_path: str) -> int:
    """Take the next number of the store's log of batches."""
    log = f"{store_path.rstrip('/')}-batches"
    number = sinks.highest(spark, log, "batch_id")
    number = 0 if number is None else number + 1
    spark.range(1).select(F.lit(number).cast("bigint").alias("batch_id")).write.mode("append").parquet(log)
    return number


def file_stream(
    spark: SparkSession, root: str, shadow: str, pattern: str = "*.xlsx", folders: str = "*", **options
) -> DataFrame:
    """Sheet files as they arrive in the sub-folders of ``root``.

    ``shadow`` is a folder that stays the same from run to run; files that Spark would not list are copied there when
    the stream is built.  Options go to the source; ``maxFilesPerTrigger`` bounds a batch.
    """
    conf = spark._jsc.hadoopConfiguration()
    place = spark._jvm.org.apache.hadoop.fs.Path(shadow)
    place.getFileSystem(conf).mkdirs(place)
    sheets.mirror(spark, sheets.hidden_files(spark, root, pattern, folders), shadow)

    def stream():
        return spark.readStream.options(**({"maxFileAge": ANY_AGE} | options))

    return sheets.load_files(stream(), root, pattern, folders).unionByName(
        sheets.load_files(stream(), shadow, "*", mirrored=True)
    )


def upsert(store_path: str, plots: DataFrame, allow_duplicates: bool = False) -> Callable[[DataFrame, int], int]:
    """The ``foreachBatch`` function; it returns the number that the store gave the batch."""

    def run(batch: DataFrame, _: int) -> int:
        spark = batch.sparkSession
        number = _next_batch(spark, store_path)
        # The names are read from the files once; the errors, the projects and the elements come from the written ones.
        files = sinks.handoff(batch.select("folder_name", "file_name"), scratch_path(spark, "batch-files"))
        # Only the partitions of the projects in this batch are read: the join prunes by the partition column.
        projects = usable_files(files, plots).select(F.lower("PROJECT_ID").alias("k_project")).distinct()
        master = read_store(spark, store_path).join(projects, "k_project", "left_semi").drop("k_project")
        work = scratch_path(spark, "batch-rows")
        inputs, failed = read_inputs(batch, plots, master, tuple(STORE_ORDER), work)
        inputs = replace(inputs, files=files)
        errors = extraction_errors(files, plots, failed).join(
            failed.groupBy("folder_name", "file_name").agg(F.min("error").alias("detail")),
            ["folder_name", "file_name"],
            "left",
        )
        errors = errors.select("kind", "folder_name", "file_name", "detail", F.lit(number).cast("bigint").alias("batch_id"))
        errors.write.mode("append").parquet(errors_of(store_path))
        new = extract_located(inputs, allow_duplicates).join(master.select("ID"), "ID", "left_anti")
        _write(to_store(new, number), store_path, "append")
        return number

    return run


def start(
    files: DataFrame, store_path: str, plots: DataFrame, checkpoint: str, allow_duplicates: bool = False
) -> StreamingQuery:
    """Process all files that have arrived since the last run and stop."""
    return (
        files.writeStream.foreachBatch(upsert(store_path, plots, allow_duplicates))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
