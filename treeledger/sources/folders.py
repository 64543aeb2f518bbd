"""Folders and files below a root, listed inside tasks by a Python data source.

``spark.read.format("treeledger_folders").option("path", root).load()`` gives one row per file right inside a direct
sub-folder of the root, and one row with a null file for each such folder without matching files.  Names that Spark's
own file listing hides (``_x``, ``.x``) are rows like any other.

The read has ``parts`` partitions (option, 64 by default).  Each task lists the root's names (one directory, no
contents) and takes the folders whose CRC-32 of the name falls to it, then lists those folders.  So the driver holds no
list of files or folders, a large tree is listed by many tasks at once, and a lost task lists its share again.  Files
are opened by nobody here; reading them is a later step.
"""

from __future__ import annotations

import fnmatch
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from treeledger.functions.names import plot_from_folder

SCHEMA = "folder_name string, file_name string, path string, length bigint, modificationTime timestamp"
PARTS = 64


class FolderListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "treeledger_folders"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> DataSourceReader:
        return _Reader(self.options)


class _Reader(DataSourceReader):
    def __init__(self, options) -> None:
        self.root = options["path"]
        self.pattern = options.get("pattern", "*.xlsx")
        self.parts = int(options.get("parts", PARTS))

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(i) for i in range(self.parts)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        from pyarrow import fs

        system, base = fs.FileSystem.from_uri(self.root)
        scheme = self.root.split("://", 1)[0] + "://" if "://" in self.root else "file://"
        for folder in system.get_file_info(fs.FileSelector(base)):
            if folder.type != fs.FileType.Directory:
                continue
            if zlib.crc32(folder.base_name.encode()) % self.parts != partition.value:
                continue
            files = [
                f
                for f in system.get_file_info(fs.FileSelector(folder.path))
                if f.type == fs.FileType.File and fnmatch.fnmatchcase(f.base_name, self.pattern)
            ]
            if not files:
                yield (folder.base_name, None, None, None, None)
            for f in sorted(files, key=lambda f: f.base_name):
                path = f.path if "://" in f.path else scheme + f.path
                yield (folder.base_name, f.base_name, path, f.size, f.mtime)


def list_folders(spark: SparkSession, root: str, pattern: str = "*.xlsx", parts: int = PARTS) -> DataFrame:
    """The listing of :class:`FolderListing` below ``root``."""
    spark.dataSource.register(FolderListing)
    return (
        spark.read.format(FolderListing.name())
        .option("path", root)
        .option("pattern", pattern)
        .option("parts", str(parts))
        .load()
    )


def empty_folders(listing: DataFrame) -> DataFrame:
    """``folder_name`` of the folders without a matching file."""
    return listing.where("file_name is null").select("folder_name")


def folder_status(empty: DataFrame, plots: DataFrame) -> DataFrame:
    """``folder_name, kind`` of folders without workbooks: ``folder_name`` (no plot in the name), ``no_project`` (a plot
    without project) or ``no_files`` (a usable folder with nothing in it, which a run counts as a success)."""
    named = empty.withColumn("k_plot", F.upper(plot_from_folder("folder_name")))
    known = plots.where("PROJECT_ID <> ''").select("k_plot", "PROJECT_ID").dropDuplicates(["k_plot"])
    found = named.join(known, "k_plot", "left")
    kind = F.when(F.col("k_plot").isNull(), "folder_name").when(F.col("PROJECT_ID").isNull(), "no_project").otherwise("no_files")
    return found.select("folder_name", kind.alias("kind"))
