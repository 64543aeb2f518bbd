"""Full extraction: sheet files and their rows in, new elements out.

Inputs
    files       folder_name, file_name                       one row per sheet file
    rows        folder_name, file_name, row_idx, table_raw, inverter_raw
    plots       result of ``plot_projects``
    master      existing elements, with the columns of ``order`` that give their row order

How the plan scales.  Plot, block and project of a row follow from its own folder and file name and the small plot map,
so rows are never joined to files.  Ids are digests of keys, so a child names its parent without a join; only parents
that the master already holds need one, and it runs on the rows that are left after de-duplication.  The one large
shuffle is the first-wins aggregate, whose map side keeps one row per key and task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from treeledger.functions import names as N
from treeledger.functions.keys import element_id, with_keys
from treeledger.operators.identity import default_id, known_keys, occurrence_id
from treeledger.operators.order import keep_first, keep_last
from treeledger.schema import ELEMENT_FIELDS, KEY, VISIT_ORDER
from treeledger.sources import sheets, sinks

MASTER_ORDER = ["ord"]
SMALL_MAP = 200_000  # plots


def resolve_projects(named: DataFrame, plots: DataFrame) -> DataFrame:
    """Add PROJECT_ID by ``plot_name``, ignoring case; rows whose plot is unknown drop out."""
    known = plots.where("PROJECT_ID <> ''").select("k_plot", "PROJECT_ID")
    return named.withColumn("k_plot", F.upper("plot_name")).join(known, "k_plot").drop("k_plot")


def name_files(files: DataFrame) -> DataFrame:
    """Add plot (by folder), plot (by file name) and block."""
    return files.select(
        "folder_name",
        "file_name",
        N.plot_from_folder("folder_name").alias("plot_name"),
        N.plot_from_file("file_name").alias("file_plot_name"),
        N.block_from_file("file_name").alias("block_name"),
    )


def usable_files(files: DataFrame, plots: DataFrame) -> DataFrame:
    """Files that have a project and a block; these create or reuse a PLOT and a BLOCK even if they hold no rows."""
    return resolve_projects(name_files(files).where("plot_name is not null and block_name is not null"), plots)


def extraction_errors(files: DataFrame, plots: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """What the run reports, once per folder or file.  ``plot_mismatch`` is a warning: such a file is still used.

    ``failed`` holds the files that could not be read to the end (``row_errors``); they count if they were usable.
    """
    named = name_files(files).withColumn("k_plot", F.upper("plot_name"))
    known = plots.where("PROJECT_ID <> ''").select("k_plot", "PROJECT_ID")
    # Files without a plot have no key; joined, they would all meet in one task.
    unnamed = named.where("k_plot is null").withColumn("PROJECT_ID", F.lit(None).cast("string"))
    checked = named.where("k_plot is not null").join(known, "k_plot", "left").unionByName(unnamed)
    no_folder = F.col("plot_name").isNull()
    no_project = F.col("PROJECT_ID").isNull()
    no_block = F.col("block_name").isNull()
    kind = (
        F.when(no_folder, "folder_name")
        .when(no_project, "no_project")
        .when(no_block, "no_block")
        .when(~N.same_plot("plot_name", "file_plot_name"), "plot_mismatch")
    )
    found = checked.withColumn("kind", kind).where("kind is not null")
    per_folder = found.where("kind in ('folder_name', 'no_project')").select(
        "kind", "folder_name", F.lit(None).cast("string").alias("file_name")
    )
    per_file = found.where("kind in ('no_block', 'plot_mismatch')").select("kind", "folder_name", "file_name")
    errors = per_folder.distinct().unionByName(per_file)
    if failed is None:
        return errors
    opened = failed.select("folder_name", "file_name").distinct()
    unread = usable_files(opened, plots).select(F.lit("sheet_error").alias("kind"), "folder_name", "file_name")
    return errors.unionByName(unread)


def run_status(errors: DataFrame) -> DataFrame:
    """How a run ended: ok, warnings (only mismatched plot names) or errors; with the number of each."""
    warning = F.col("kind") == "plot_mismatch"
    counts = errors.agg(
        F.count(F.when(warning, 1)).alias("n_warnings"), F.count(F.when(~warning, 1)).alias("n_errors")
    )
    status = F.when(F.col("n_errors") > 0, "errors").when(F.col("n_warnings") > 0, "warnings").otherwise("ok")
    return counts.withColumn("status", status)


def unpivot_leaves(rows: DataFrame) -> DataFrame:
    """Each row as up to two leaves; the type is that of the column, whatever the name looks like.

    ``table_raw`` and ``inverter_raw`` are replaced by ``col_idx``, ``TYPE`` and ``NAME``; other columns stay.
    """
    pair = F.stack(
        F.lit(2),
        F.lit(1), F.lit("TABLE"), N.leaf_name("table_raw"),
        F.lit(2), F.lit("INVERTER"), N.leaf_name("inverter_raw"),
    ).alias("col_idx", "TYPE", "NAME")
    kept = [c for c in rows.columns if c not in ("table_raw", "inverter_raw")]
    return rows.select(*kept, pair).where("NAME is not null")


def label_leaves(rows: DataFrame, plots: DataFrame) -> DataFrame:
    """All leaves of usable files, with plot, block and project.  Rows of other files drop out before the unpivot."""
    named = rows.withColumns(
        {"plot_name": N.plot_from_folder("folder_name"), "block_name": N.block_from_file("file_name")}
    )
    return unpivot_leaves(resolve_projects(named.where("plot_name is not null and block_name is not null"), plots))


def known_parents(master: DataFrame, order: list[str] = MASTER_ORDER) -> DataFrame:
    """The PLOT and BLOCK elements of the master, the last row of each key: k_project, k_name, k_type, known_id.

    They are a small share of the master, so filtering it by type is enough; leaves of the master are not moved.
    """
    upper = with_keys(master).where(F.col("k_type").isin("PLOT", "BLOCK"))
    return keep_last(upper.select(*KEY, F.col("ID").alias("known_id"), *order), KEY, order).drop(*order)


def id_of(children: DataFrame, parents: DataFrame, kind: str, name: str, target: str) -> DataFrame:
    """Set ``target`` to the id of the ``kind`` element called like column ``name`` in the row's project.

    The id of the master is used if it has the element; otherwise the id that the element gets when it is created.
    """
    known = parents.where(F.col("k_type") == kind).select(
        F.col("k_project").alias("p_project"), F.col("k_name").alias("p_name"), "known_id"
    )
    keyed = children.withColumns({"p_project": F.lower("PROJECT_ID"), "p_name": F.upper(name)})
    created = element_id(F.lit(kind), "PROJECT_ID", name)
    return (
        keyed.join(known, ["p_project", "p_name"], "left")
        .withColumns({target: F.coalesce("known_id", created), f"{target}_is_new": F.col("known_id").isNull()})
        .drop("p_project", "p_name", "known_id")
    )


def _first_files(usable: DataFrame, kind: str, name: str) -> DataFrame:
    """One row per element that the files name, with the first file that does."""
    named = usable.select(
        "PROJECT_ID", F.col(name).alias("NAME"), F.lit(kind).alias("TYPE"), "plot_name", "folder_name", "file_name"
    )
    return keep_first(with_keys(named), KEY, ["folder_name", "file_name"])


def plot_elements(usable: DataFrame, parents: DataFrame) -> DataFrame:
    """One row per plot of the usable files: ID (reused or new), ID_is_new and an empty PARENT_ID."""
    plots = id_of(_first_files(usable, "PLOT", "plot_name"), parents, "PLOT", "NAME", "ID")
    return plots.withColumn("PARENT_ID", F.lit(""))


def block_elements(usable: DataFrame, parents: DataFrame) -> DataFrame:
    """One row per (project, block): a block named in two plots of a project is a child of the first one."""
    blocks = id_of(_first_files(usable, "BLOCK", "block_name"), parents, "BLOCK", "NAME", "ID")
    return id_of(blocks, parents, "PLOT", "plot_name", "PARENT_ID")


def leaf_elements(
    leaves: DataFrame, master: DataFrame, parents: DataFrame, allow_duplicates: bool = False
) -> DataFrame:
    """New TABLE and INVERTER elements.

    By default a name exists once per project and type, whatever its block, and not at all if the master has it.  The
    aggregate comes before the anti-join: both use the same key, so the join reuses its partitioning and sees few rows.
    With ``allow_duplicates`` every occurrence is created and nothing is looked up but the parents.
    """
    if allow_duplicates:
        new = leaves.withColumn("ID", occurrence_id())
    else:
        places = leaves.select("PROJECT_ID", "NAME", "TYPE", "block_name", *VISIT_ORDER)
        first = keep_first(with_keys(places), KEY, VISIT_ORDER)
        new = first.join(known_keys(master, "TABLE", "INVERTER"), KEY, "left_anti").withColumn("ID", default_id())
    return id_of(new, parents, "BLOCK", "block_name", "PARENT_ID")


@dataclass(frozen=True)
class Inputs:
    """What an extraction reads."""

    files: DataFrame
    rows: DataFrame
    plots: DataFrame
    master: DataFrame
    order: tuple[str, ...] = ("ord",)


def read_inputs(
    scanned: DataFrame, plots: DataFrame, master: DataFrame, order: tuple[str, ...] = ("ord",), work: str | None = None
) -> tuple[Inputs, DataFrame]:
    """Inputs from scanned sheet files, and the files that could not be read.

    Files whose folder or name gives no plot or block are never opened, nor those whose plot has no project while the
    plot map is small enough to be sent to all tasks (``SMALL_MAP`` rows); a larger one would have to be joined in a way
    that moves the files' content, so then such files are read and left out later.  With a folder ``work`` the parsed rows are written there, so that the rows and the
    errors come from one reading.
    """
    named = N.plot_from_folder("folder_name").isNotNull() & N.block_from_file("file_name").isNotNull()
    usable = scanned.where(named)
    known = plots.where("PROJECT_ID <> ''").select("k_plot").distinct()
    if known.limit(SMALL_MAP + 1).count() <= SMALL_MAP:
        here = F.upper(N.plot_from_folder("folder_name")) == F.col("k_plot")
        usable = usable.join(F.broadcast(known), here, "left_semi")
    parsed = sheets.sheet_rows(usable)
    if work:
        parsed = sinks.handoff(parsed, work)
    files = scanned.select("folder_name", "file_name")
    return Inputs(files, sheets.readable(parsed), plots, master, order), sheets.row_errors(parsed)


def extract_located(inputs: Inputs, allow_duplicates: bool = False) -> DataFrame:
    """New elements of all levels, each with the place where it was first met."""
    usable = usable_files(inputs.files, inputs.plots)
    parents = known_parents(inputs.master, list(inputs.order))

    def shaped(df: DataFrame, row: Column, column: Column) -> DataFrame:
        return df.select(
            *ELEMENT_FIELDS, "folder_name", "file_name", row.cast("bigint").alias("row_idx"), column.alias("col_idx")
        )

    plots = plot_elements(usable, parents).where("ID_is_new")
    blocks = block_elements(usable, parents).where("ID_is_new")
    leaves = leaf_elements(label_leaves(inputs.rows, inputs.plots), inputs.master, parents, allow_duplicates)
    return (
        shaped(plots, F.lit(0), F.lit(0))
        .unionByName(shaped(blocks, F.lit(0), F.lit(1)))
        .unionByName(shaped(leaves, F.col("row_idx"), F.col("col_idx")))
    )


def extract_elements(inputs: Inputs, allow_duplicates: bool = False) -> DataFrame:
    """New elements: ID, PROJECT_ID, NAME, TYPE, PARENT_ID."""
    return extract_located(inputs, allow_duplicates).select(*ELEMENT_FIELDS)


COUNTERS = [f"{level}_{what}" for level in ("plots", "blocks") for what in ("processed", "created", "skipped")] + [
    f"{level}_{what}" for level in ("tables", "inverters") for what in ("extracted", "created", "skipped")
]


def run_stats(inputs: Inputs, allow_duplicates: bool = False) -> DataFrame:
    """The twelve counters of a run and their totals, as one row.

    Plots and blocks count files: ``processed`` the usable ones, ``skipped`` those whose plot or block is in the
    master.  Leaves count rows, and extracted = created + skipped.
    """
    def counted(df: DataFrame, **measures: Column) -> DataFrame:
        zero = F.lit(0).cast("bigint")
        sums = df.agg(*[F.coalesce(m, zero).alias(k) for k, m in measures.items()])
        return sums.select(*[F.col(c) if c in measures else zero.alias(c) for c in COUNTERS])

    def files_per(kind: str, name: str, level: str) -> DataFrame:
        usable = usable_files(inputs.files, inputs.plots)
        keyed = with_keys(usable.select("PROJECT_ID", F.col(name).alias("NAME"), F.lit(kind).alias("TYPE")))
        per_key = keyed.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
        flagged = per_key.join(
            known_keys(inputs.master, kind).distinct().withColumn("known", F.lit(True)), KEY, "left"
        )
        return counted(
            flagged,
            **{
                f"{level}_processed": F.sum("n"),
                f"{level}_created": F.count(F.when(F.col("known").isNull(), 1)),
                f"{level}_skipped": F.sum(F.when(F.col("known"), F.col("n"))),
            },
        )

    leaves = label_leaves(inputs.rows, inputs.plots)
    # One row per key carries how often it was met, so extracted and created come from a single pass over the rows.
    per_key = with_keys(leaves).groupBy(*KEY).agg(F.count(F.lit(1)).alias("n"))
    known = known_keys(inputs.master, "TABLE", "INVERTER").distinct().withColumn("known", F.lit(True))
    made = F.col("n") if allow_duplicates else F.when(F.col("known").isNull(), 1).otherwise(0)
    flagged = per_key.join(known, KEY, "left").withColumn("made", made)
    measures = {}
    for kind, level in (("TABLE", "tables"), ("INVERTER", "inverters")):
        mine = F.col("k_type") == kind
        measures[f"{level}_extracted"] = F.sum(F.when(mine, F.col("n")))
        measures[f"{level}_created"] = F.sum(F.when(mine, F.col("made")))
        measures[f"{level}_skipped"] = F.sum(F.when(mine, F.col("n") - F.col("made")))
    parts = (
        files_per("PLOT", "plot_name", "plots")
        .unionByName(files_per("BLOCK", "block_name", "blocks"))
        .unionByName(counted(flagged, **measures))
    )
    one = parts.agg(*[F.sum(c).alias(c) for c in COUNTERS])

    def total(what: str) -> Column:
        parts = [F.col(c) for c in COUNTERS if c.endswith(what)]
        return sum(parts[1:], parts[0]).alias(f"total_{what}")

    return one.select(*COUNTERS, total("extracted"), total("created"), total("skipped"))
