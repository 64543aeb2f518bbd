"""Checks of the tree, of the sheets and of the file names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from treeledger.functions import names as N


def absent_parents(children: DataFrame, known: DataFrame) -> DataFrame:
    """The non-empty parent ids of ``children`` that are no ID in ``known``.

    Distinct parents first: a block with millions of leaves sends one row per task into the join.
    """
    return without_row(children.where("PARENT_ID <> ''").select("PARENT_ID").distinct(), known)


def without_row(asked: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of ``asked`` whose PARENT_ID is no ID in ``known``.

    The ids that do exist are found first, with the few parents on the side that can be broadcast or turned into a
    runtime filter.  A direct anti-join would have to move every id of ``known``.
    """
    wanted = asked.select("PARENT_ID")
    present = known.select(F.col("ID").alias("PARENT_ID")).join(wanted, "PARENT_ID", "left_semi")
    return asked.join(present, "PARENT_ID", "left_anti")


def hierarchy_issues(elements: DataFrame, master: DataFrame | None = None) -> DataFrame:
    """Rows with a wrong parent link; rows of unknown type are not looked at.

    Parents are looked for among ``elements`` only, unless a ``master`` is given.  Without it, a child of an element
    that was reused from the master counts as an issue.
    """
    known = elements.select("ID") if master is None else elements.select("ID").unionByName(master.select("ID"))
    child = F.col("TYPE").isin("BLOCK", "TABLE", "INVERTER")
    columns = ["kind", "TYPE", "NAME", "ID", "PROJECT_ID", "PARENT_ID"]
    local = elements.withColumn(
        "kind",
        F.when((F.col("TYPE") == "PLOT") & (F.col("PARENT_ID") != ""), "plot_has_parent").when(
            child & (F.col("PARENT_ID") == ""), "empty_parent"
        ),
    ).where("kind is not null")
    children = elements.where(child)
    dangling = children.join(absent_parents(children, known), "PARENT_ID", "left_semi").withColumn(
        "kind", F.lit("parent_not_found")
    )
    return local.select(*columns).unionByName(dangling.select(*columns))


def issue_summary(*issues: DataFrame) -> DataFrame:
    """Number of issues of each kind, over any number of issue tables."""
    kinds = issues[0].select("kind")
    for more in issues[1:]:
        kinds = kinds.unionByName(more.select("kind"))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def first_issues(issues: DataFrame, limit: int = 10) -> DataFrame:
    """The first issues by kind, type, name and id, each with the number of issues that are not shown."""
    total = issues.agg(F.count(F.lit(1))).scalar()
    return (
        issues.orderBy("kind", "TYPE", "NAME", "ID")
        .limit(limit)
        .withColumn("n_more", F.greatest(total - limit, F.lit(0)).cast("bigint"))
    )


def file_audit(files: DataFrame) -> DataFrame:
    """What each file would become: plot by folder, plot by file name, block, whether the two plots agree."""
    plot, other, block = N.plot_from_folder("folder_name"), N.plot_from_file("file_name"), N.block_from_file("file_name")
    return files.select(
        "folder_name",
        "file_name",
        plot.alias("plot_name"),
        other.alias("file_plot_name"),
        block.alias("block_name"),
        N.same_plot(plot, other).alias("is_consistent"),
        F.concat(plot, F.lit("/"), block).alias("hierarchy"),
    )


def files_top(files: DataFrame, n: int = 2) -> DataFrame:
    """The first ``n`` files of each folder and how many more there are.

    The rank filter is pushed below the shuffle (window group limit), and the totals are a separate aggregate, so a
    folder that holds a third of all files sends few rows to its task.
    """
    ranked = files.withColumn("rank", F.row_number().over(W.partitionBy("folder_name").orderBy("file_name")))
    totals = files.groupBy("folder_name").agg(F.count(F.lit(1)).alias("total"))
    return (
        ranked.where(F.col("rank") <= n)
        .join(totals, "folder_name")
        .select(
            "folder_name",
            F.col("rank").cast("bigint").alias("rank"),
            "file_name",
            F.greatest(F.col("total") - n, F.lit(0)).cast("bigint").alias("n_more"),
        )
    )


# Sheet checks work on cells: (folder_name, file_name, sheet_name, row_idx, col_idx, value), empty cells left out.


def sheet_profile(cells: DataFrame) -> DataFrame:
    """Per sheet: size, header and rows 2 to 5, and whether all sheets of the folder share one header.

    Headers are compared cell by cell with their columns, so a gap or a separator inside a value makes a difference.
    The header (row 1) and the sample rows are picked by conditional aggregates, so only the counts see every cell.
    """
    sheet = ["folder_name", "file_name", "sheet_name"]
    few = F.when(F.col("row_idx") <= 5, F.struct("row_idx", "col_idx", "value"))
    per_sheet = cells.groupBy(*sheet).agg(
        F.max("row_idx").cast("bigint").alias("max_row"),
        F.max("col_idx").cast("bigint").alias("max_col"),
        F.array_sort(F.collect_list(few)).alias("few"),
    )

    def row(i: int):
        in_row = F.filter("few", lambda c: c["row_idx"] == i)
        return F.array_join(F.transform(in_row, lambda c: c["value"]), "|")

    rows = {1: "header", 2: "row_2", 3: "row_3", 4: "row_4", 5: "row_5"}
    named = F.transform(F.filter("few", lambda c: c["row_idx"] == 1), lambda c: F.struct(c["col_idx"], c["value"]))
    profiled = per_sheet.select(
        *sheet, "max_row", "max_col", *[row(i).alias(n) for i, n in rows.items()], F.xxhash64(named).alias("cells")
    )
    alike = profiled.groupBy("folder_name").agg((F.min("cells") == F.max("cells")).alias("same_header"))
    return profiled.join(alike, "folder_name").select(*sheet, "max_row", "max_col", *rows.values(), "same_header")


def header_candidates(cells: DataFrame, depth: int = 5) -> DataFrame:
    """Number of non-empty cells in each of the first rows of a sheet; rows without any are left out."""
    filled = cells.where((F.col("row_idx") <= depth) & N.clean_cell("value").isNotNull())
    return filled.groupBy("folder_name", "file_name", "sheet_name", F.col("row_idx").cast("bigint").alias("row_idx")).agg(
        F.count(F.lit(1)).alias("n_cells")
    )


def column_samples(cells: DataFrame, rows: int = 20, samples: int = 10, columns: int = 29) -> DataFrame:
    """The first non-empty values of each column after the header rows, each with a tag.

    Header rows are the non-empty ones among the first five.  At most ``rows`` rows of a sheet are looked at, so the
    window holds that many rows per column however long the sheet is.
    """
    sheet = ["folder_name", "file_name", "sheet_name"]
    headers = (
        header_candidates(cells).groupBy(*sheet).agg((F.count(F.lit(1)) + 1).alias("start"))
    )
    top = cells.where((F.col("row_idx") <= rows + 5) & (F.col("col_idx") <= columns))
    if "is_blank" in cells.columns:  # zero and FALSE are no samples
        top = top.where(~F.col("is_blank"))
    top = top.withColumn("sample", N.clean_cell("value")).where("sample is not null")
    near = (
        top.join(headers, sheet)
        .where((F.col("row_idx") >= F.col("start")) & (F.col("row_idx") < F.col("start") + rows))
        .withColumn("rank", F.row_number().over(W.partitionBy(*sheet, "col_idx").orderBy("row_idx")))
        .where(F.col("rank") <= samples)
    )
    s = F.col("sample")
    tag = F.when(s.contains("R") & (s.contains("T") | s.contains("S")), "TABLE").when(
        s.startswith("I") | s.contains("-I"), "INVERTER"
    )
    return near.select(*sheet, "col_idx", F.col("rank").cast("bigint").alias("rank"), "sample", tag.alias("tag"))


def column_patterns(cells: DataFrame) -> DataFrame:
    """Per column: which patterns its sampled values show, and how many values carry each tag."""
    s = F.col("sample")
    return (
        column_samples(cells)
        .groupBy("folder_name", "file_name", "sheet_name", F.col("col_idx").cast("bigint").alias("col_idx"))
        .agg(
            F.bool_or(s.contains("R") & s.contains("T")).alias("has_table"),
            F.bool_or(s.startswith("I") | s.contains("-I")).alias("has_inverter"),
            F.bool_or(s.contains("B") & s.contains("-")).alias("has_block"),
            F.count(F.lit(1)).alias("n_samples"),
            F.count(F.when(F.col("tag") == "TABLE", 1)).alias("n_table_tags"),
            F.count(F.when(F.col("tag") == "INVERTER", 1)).alias("n_inverter_tags"),
        )
    )


def column_headers(cells: DataFrame, rows: int = 3, columns: int = 29) -> DataFrame:
    """The header of each column: its values in the first rows, joined, or its number where there are none."""
    filled = F.col("value") != ""
    if "is_blank" in cells.columns:  # zero and FALSE are no headers
        filled &= ~F.col("is_blank")
    top = F.when((F.col("row_idx") <= rows) & filled, F.struct("row_idx", N.strip("value").alias("text")))
    named = (
        cells.where(F.col("col_idx") <= columns)
        .groupBy("folder_name", "file_name", "sheet_name", F.col("col_idx").cast("bigint").alias("col_idx"))
        .agg(F.array_sort(F.collect_list(top)).alias("top"))
    )
    joined = F.array_join(F.transform("top", lambda c: c["text"]), " | ")
    header = F.when(F.size("top") > 0, joined).otherwise(F.concat(F.lit("Col"), F.col("col_idx").cast("string")))
    return named.withColumn("header", header).drop("top")


def sheet_head(cells: DataFrame, rows: int = 10, columns: int = 19) -> DataFrame:
    """The first rows and columns of each sheet, long values cut for display."""
    return cells.where((F.col("row_idx") <= rows) & (F.col("col_idx") <= columns)).select(
        "folder_name",
        "file_name",
        "sheet_name",
        F.col("row_idx").cast("bigint").alias("row_idx"),
        F.col("col_idx").cast("bigint").alias("col_idx"),
        N.shorten("value").alias("value"),
    )
