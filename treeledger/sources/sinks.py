"""Writing tables: new elements, appends, snapshots, versioned rewrites.

A plan never writes to a path that it reads, except by append.  ``rebalance`` lets AQE size the output files: small
partitions are merged and skewed ones are split, so neither many tiny files nor one huge task appears.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger.functions.keys import with_keys
from treeledger.operators.filters import to_schema
from treeledger.schema import KEY


def write_elements(elements: DataFrame, path: str, work: str, fmt: str = "parquet") -> bool:
    """Write the five fields in order, replacing the target.  Nothing is written when there are no elements.

    The elements are computed once, into the folder ``work``; looking whether there are any then costs nothing.
    """
    out = handoff(to_schema(elements), work)
    if out.isEmpty():
        return False
    writer = out.hint("rebalance").write.mode("overwrite").format(fmt)
    if fmt == "csv":
        # The writer strips fields unless told not to.
        writer = writer.options(
            header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        )
    writer.save(path)
    return True


def handoff(df: DataFrame, path: str) -> DataFrame:
    """Write a result once and read it back, for plans that use it several times.

    The files are in the shared folder, so a lost executor costs nothing and the lineage is cut.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_elements(new: DataFrame, path: str) -> DataFrame:
    """Append to a master table and return the table.  New part files are added, so no record can run into another."""
    new.hint("rebalance").write.mode("append").parquet(path)
    return new.sparkSession.read.parquet(path)


def save_bucketed(elements: DataFrame, table: str, buckets: int, mode: str = "overwrite") -> None:
    """Save a master as a catalog table that is bucketed by element key and stores the key columns.

    Every run compares its leaves with the master by key.  With this layout the master stays where it is and only the
    new keys are shuffled, as long as there are at least as many buckets as initial shuffle partitions.
    """
    keyed = with_keys(elements)
    # One task per bucket writes one file per bucket.
    writer = keyed.repartition(buckets, *KEY).write.mode(mode).bucketBy(buckets, *KEY).sortBy(*KEY)
    writer.saveAsTable(table)


def snapshot_stamp(moment: Column) -> Column:
    return F.date_format(moment, "yyyyMMdd_HHmmss")


def snapshot(df: DataFrame, base: str, stamp: str) -> str:
    """Copy a table aside under a time stamp; an existing snapshot is never replaced."""
    path = f"{base.rstrip('/')}/snapshot={stamp}"
    df.write.mode("errorifexists").parquet(path)
    return path


def rewrite(df: DataFrame, base: str) -> int:
    """Write a full new version of a table beside the old ones, then publish it.

    The data goes to a folder of its own name; number and name are published together, by a file of the number that can
    be made only once.  So readers see the old version or the new one, a failed write leaves the old one in place, and of
    two writers that began with the same version one fails.
    """
    spark = df.sparkSession
    version = (current_version(spark, base) or 0) + 1
    name = f"version={version}-{uuid.uuid4().hex}"
    df.hint("rebalance").write.mode("errorifexists").parquet(f"{base}/data/{name}")
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    claim = fs_path(f"{base}/claims/{version}")
    system = claim.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.createNewFile(claim):
        raise FileExistsError(f"version {version} of {base} was written by another writer")
    entry = spark.range(1).select(F.lit(version).cast("bigint").alias("version"), F.lit(name).alias("name"))
    entry.write.mode("append").parquet(f"{base}/log")
    return version


def highest(spark: SparkSession, path: str, column: str) -> int | None:
    """The highest number in a small table, or None where there is no table yet."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(f"{column} bigint").parquet(path).agg(F.max(column)).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current_version(spark: SparkSession, base: str) -> int | None:
    """The highest published version, or None for a table that was never written."""
    return highest(spark, f"{base}/log", "version")


def read_current(spark: SparkSession, base: str) -> DataFrame:
    log = spark.read.schema("version bigint, name string").parquet(f"{base}/log")
    return spark.read.parquet(f"{base}/data/{log.agg(F.max_by('name', 'version')).first()[0]}")


def write_summary(summary: DataFrame, path: str, fmt: str = "json") -> None:
    """Persist a summary table (a few rows per project)."""
    summary.write.mode("overwrite").format(fmt).save(path)

