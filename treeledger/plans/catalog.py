"""Every operator as a query over the stand-in inputs: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from treeledger.functions import names as N
from treeledger.functions.keys import element_id, with_keys
from treeledger.operators import filters, identity, lookups, repair, rollups, tree, verify
from treeledger.plans import extract, standins, workbooks
from treeledger.plans.append import AppendReport, append_and_report
from treeledger.plans.append import repair_and_publish as publish_repair
from treeledger.plans.standins import Views
from treeledger.schema import ELEMENT_FIELDS, PLOT_FIELDS, PLOT_PROJECT_FIELDS, VISIT_ORDER
from treeledger.session import scratch_path
from treeledger.sources import folders, sheets, sinks, tables
from treeledger.streaming import incremental, ledger

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
MASTER_ORDER = ["ord"]
RESTORED_PLOT = "B-13a"


def query(build: Callable[[Views], DataFrame]) -> Callable[[Views], DataFrame]:
    """Register a query under the name of its function."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Views(spark, sf_dir))
    return build


def scratch(v: Views, label: str) -> str:
    return scratch_path(v.spark, label)


def written_new(v: Views) -> DataFrame:
    """New elements written once, for reports that read them several times."""
    return sinks.handoff(v.new_located, scratch(v, "new"))


# --- sources and sinks -----------------------------------------------------------------------------------------------


def packed(v: Views, rows: DataFrame | None = None, root: str | None = None) -> str:
    root = root or scratch(v, "sheets")
    workbooks.write_workbooks(v.workbook_rows if rows is None else rows, root, standins.HEADER)
    return root


def _as_csv(v: Views, df: DataFrame, fields: list[str], pad: bool = True) -> str:
    """Write fields, padded with white space, to CSV files whose order is that of ``ord``."""
    path = scratch(v, "csv")
    padded = [F.concat(F.lit("  "), F.col(c), F.lit(" \t")).alias(c) if pad else F.col(c) for c in fields]
    df.sort("ord").select(*padded).write.options(
        header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


@query
def scan_sheet_files(v: Views) -> DataFrame:
    return sheets.scan_files(v.spark, packed(v)).select("folder_name", "file_name")


@query
def scan_sheet_rows(v: Views) -> DataFrame:
    rows = sheets.sheet_rows(sheets.scan_files(v.spark, packed(v)))
    return rows.select("folder_name", "file_name", "row_idx", "table_raw", "inverter_raw", F.col("error").isNotNull().alias("is_error"))


@query
def scan_sheet_cells(v: Views) -> DataFrame:
    cells = sheets.sheet_cells(sheets.scan_files(v.spark, packed(v)))
    return cells.select("folder_name", "file_name", "sheet_name", "is_active", "row_idx", "col_idx", "value")


@query
def load_plots_projects(v: Views) -> DataFrame:
    path = _as_csv(v, v.plots_projects, PLOT_PROJECT_FIELDS)
    return tables.read_plots_projects(v.spark, path, files="parts").select(*PLOT_PROJECT_FIELDS)


@query
def load_plots(v: Views) -> DataFrame:
    # The optional last column is left out of the file.
    return tables.read_plots(v.spark, _as_csv(v, v.plots, PLOT_FIELDS[:-1]), files="parts").select(*PLOT_FIELDS)


@query
def load_design_elements(v: Views) -> DataFrame:
    return tables.read_design_elements(v.spark, _as_csv(v, v.design_elements, ELEMENT_FIELDS), files="parts")


@query
def load_raw_elements(v: Views) -> DataFrame:
    return tables.read_elements(v.spark, _as_csv(v, v.design_elements, ELEMENT_FIELDS))


@query
def append_elements(v: Views) -> DataFrame:
    path = scratch(v, "master")
    v.design_elements.select(*ELEMENT_FIELDS).write.parquet(path)
    return sinks.append_elements(v.new_elements, path)


@query
def snapshot_roundtrip(v: Views) -> DataFrame:
    kept = sinks.snapshot(v.design_elements, scratch(v, "snapshots"), "20250101_000000")
    return v.spark.read.parquet(kept)


@query
def staged_rewrite(v: Views) -> DataFrame:
    base = scratch(v, "versioned")
    sinks.rewrite(v.design_elements, base)
    sinks.rewrite(repair.restore_missing_plot(sinks.read_current(v.spark, base), RESTORED_PLOT), base)
    return sinks.read_current(v.spark, base)


@query
def summary_long(v: Views) -> DataFrame:
    path = scratch(v, "summary")
    sinks.write_summary(rollups.summary_long(v.design_elements, v.targets), path)
    return v.spark.read.schema("section string, item string, n bigint").json(path)


# --- projections -----------------------------------------------------------------------------------------------------


@query
def plot_from_folder(v: Views) -> DataFrame:
    return v.files.select("folder_name", "file_name", N.plot_from_folder("folder_name").alias("plot_name"))


@query
def plot_from_folder_strict(v: Views) -> DataFrame:
    return v.files.select("folder_name", "file_name", N.plot_from_folder_strict("folder_name").alias("plot_name"))


@query
def block_from_file(v: Views) -> DataFrame:
    return v.files.select("file_name", N.block_from_file("file_name").alias("block_name"))


@query
def plot_from_file(v: Views) -> DataFrame:
    return v.files.select("file_name", N.plot_from_file("file_name").alias("plot_name"))


@query
def parse_paths(v: Views) -> DataFrame:
    paths = v.files.select(F.concat(F.lit("c:\\data\\"), "folder_name", F.lit("\\"), "file_name").alias("path"))
    folder, name = N.path_parts("path")
    parts = paths.select("path", folder.alias("folder_name"), name.alias("file_name"))
    return parts.select(
        "*",
        N.plot_from_folder_strict("folder_name").alias("plot_name"),
        N.plot_from_file("file_name").alias("file_plot_name"),
        N.block_from_file("file_name").alias("block_name"),
    )


@query
def clean_names(v: Views) -> DataFrame:
    return v.sheet_rows.select("file_name", "row_idx", N.strip_block_prefix("table_raw").alias("name"))


@query
def classify_names(v: Views) -> DataFrame:
    name = F.coalesce(N.leaf_name("inverter_raw"), N.leaf_name("table_raw"), F.lit("?"))
    named = v.sheet_rows.select("file_name", "row_idx", name.alias("name"))
    return named.select(
        "*", N.classify("name").alias("type_or_default"), N.classify("name", strict=True).alias("type_or_null")
    )


@query
def clean_cells(v: Views) -> DataFrame:
    return v.sheet_rows.select(
        "file_name", "row_idx", N.clean_cell("table_raw").alias("table_cell"), N.clean_cell("inverter_raw").alias("inverter_cell")
    )


@query
def table_inverter_pairs(v: Views) -> DataFrame:
    return v.sheet_rows.select(
        "file_name", "row_idx", N.leaf_name("table_raw").alias("table_name"), N.leaf_name("inverter_raw").alias("inverter_name")
    )


@query
def validate_names(v: Views) -> DataFrame:
    files, rows = v.files, v.sheet_rows
    parts = [
        files.select(N.plot_from_folder("folder_name").alias("name")),
        files.select(N.block_from_file("file_name").alias("name")),
        rows.select(N.leaf_name("table_raw").alias("name")),
        rows.select(N.leaf_name("inverter_raw").alias("name")),
    ]
    names = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3]).where("name is not null")
    return names.select(
        "name",
        N.is_plot("name").alias("is_plot"),
        N.is_block("name").alias("is_block"),
        N.is_table("name").alias("is_table"),
        N.is_inverter("name").alias("is_inverter"),
    )


@query
def element_keys(v: Views) -> DataFrame:
    return with_keys(v.design_elements).select("ID", "k_project", "k_name", "k_type")


@query
def element_ids(v: Views) -> DataFrame:
    return extract.label_leaves(v.sheet_rows, v.plot_projects).select(
        *VISIT_ORDER,
        identity.default_id().alias("default_id"),
        identity.occurrence_id().alias("occurrence_id"),
        element_id(F.lit("BLOCK"), "PROJECT_ID", "block_name").alias("block_id"),
    )


@query
def project_to_schema(v: Views) -> DataFrame:
    return filters.to_schema(v.design_elements.drop("PARENT_ID"))


@query
def project_labels(v: Views) -> DataFrame:
    return rollups.labelled_projects(v.design_elements, v.targets)


# --- filters and lookups ---------------------------------------------------------------------------------------------


@query
def plot_consistency(v: Views) -> DataFrame:
    named = extract.name_files(v.files)
    return named.select(
        "folder_name", "file_name", "plot_name", "file_plot_name", N.same_plot("plot_name", "file_plot_name").alias("is_consistent")
    )


@query
def elements_of_type(v: Views) -> DataFrame:
    return filters.of_type(v.design_elements, "PLOT", "TABLE")


@query
def target_elements(v: Views) -> DataFrame:
    return filters.in_projects(v.design_elements, v.targets).select("ord", *ELEMENT_FIELDS)


@query
def find_by_name(v: Views) -> DataFrame:
    return filters.named(v.design_elements, "R21-S3", "TABLE")


@query
def lookup_plots(v: Views) -> DataFrame:
    return lookups.lookup_plots(v.plot_requests, v.plot_map)


@query
def lookup_elements(v: Views) -> DataFrame:
    return lookups.lookup_elements(v.element_requests, v.design_elements, MASTER_ORDER)


@query
def lookup_by_id(v: Views) -> DataFrame:
    return lookups.lookup_by_id(v.id_requests, v.design_elements, MASTER_ORDER)


@query
def detect_glued_rows(v: Views) -> DataFrame:
    return repair.glued_lines(v.raw_lines)


# --- joins -----------------------------------------------------------------------------------------------------------


@query
def resolve_projects(v: Views) -> DataFrame:
    named = v.files.select("folder_name", "file_name", N.plot_from_folder("folder_name").alias("plot_name"))
    return extract.resolve_projects(named, v.plot_projects)


@query
def unresolved_folders(v: Views) -> DataFrame:
    return extract.extraction_errors(v.files, v.plot_projects).where("kind in ('folder_name', 'no_project')").drop("file_name")


@query
def plot_info(v: Views) -> DataFrame:
    return v.plot_map.drop("k_plot")


@query
def new_only(v: Views) -> DataFrame:
    leaves = with_keys(extract.label_leaves(v.sheet_rows, v.plot_projects))
    return identity.only_new(leaves, v.design_elements).select(*VISIT_ORDER, "PROJECT_ID", "TYPE", "NAME")


@query
def already_present(v: Views) -> DataFrame:
    leaves = with_keys(extract.label_leaves(v.sheet_rows, v.plot_projects))
    return identity.already_known(leaves, v.design_elements).select(*VISIT_ORDER, "PROJECT_ID", "TYPE", "NAME")


@query
def resolve_ids(v: Views) -> DataFrame:
    leaves = with_keys(extract.label_leaves(v.sheet_rows, v.plot_projects))
    return identity.resolve_ids(leaves, v.design_elements, MASTER_ORDER, identity.default_id()).select(*VISIT_ORDER, "ID", "is_new")


@query
def assign_parents(v: Views) -> DataFrame:
    leaves = extract.label_leaves(v.sheet_rows, v.plot_projects)
    placed = extract.id_of(leaves, extract.known_parents(v.design_elements), "BLOCK", "block_name", "PARENT_ID")
    return placed.select(*VISIT_ORDER, "block_name", "PARENT_ID")


@query
def children_with_parent(v: Views) -> DataFrame:
    return tree.children_with_parent(written_new(v), VISIT_ORDER)


@query
def sample_chain(v: Views) -> DataFrame:
    return tree.sample_chain(sinks.handoff(v.final_master, scratch(v, "final")), incremental.STORE_ORDER)


@query
def element_paths(v: Views) -> DataFrame:
    return tree.element_paths(sinks.handoff(v.final_master, scratch(v, "final")), incremental.STORE_ORDER)


@query
def compare_new_master(v: Views) -> DataFrame:
    return rollups.compare_new_master(v.new_elements, v.design_elements, v.targets)


# --- de-duplication and extraction -----------------------------------------------------------------------------------


@query
def dedupe_last(v: Views) -> DataFrame:
    return lookups.surviving(v.design_elements, MASTER_ORDER).select("ord", *ELEMENT_FIELDS)


@query
def plot_map_last_wins(v: Views) -> DataFrame:
    return v.plot_projects.select("k_plot", "PLOT_ID", "PLOT_NAME", "PROJECT_ID")


@query
def dedupe_first(v: Views) -> DataFrame:
    first = identity.first_by_key(extract.label_leaves(v.sheet_rows, v.plot_projects))
    return first.select(*VISIT_ORDER, "PROJECT_ID", "TYPE", "NAME", "block_name")


def _known(v: Views) -> tuple[DataFrame, DataFrame]:
    return extract.usable_files(v.files, v.plot_projects), extract.known_parents(v.design_elements)


@query
def get_or_create_plots(v: Views) -> DataFrame:
    return extract.plot_elements(*_known(v)).select(*ELEMENT_FIELDS, F.col("ID_is_new").alias("is_new"))


@query
def get_or_create_blocks(v: Views) -> DataFrame:
    return extract.block_elements(*_known(v)).select(*ELEMENT_FIELDS, F.col("ID_is_new").alias("is_new"))


def _leaves(v: Views, allow_duplicates: bool) -> DataFrame:
    leaves = extract.label_leaves(v.sheet_rows, v.plot_projects)
    new = extract.leaf_elements(leaves, v.design_elements, extract.known_parents(v.design_elements), allow_duplicates)
    return new.select(*ELEMENT_FIELDS)


@query
def create_leaves(v: Views) -> DataFrame:
    return _leaves(v, allow_duplicates=False)


@query
def create_leaves_allow_dups(v: Views) -> DataFrame:
    return _leaves(v, allow_duplicates=True)


@query
def unpivot_leaves(v: Views) -> DataFrame:
    return extract.unpivot_leaves(v.sheet_rows)


@query
def extract_elements(v: Views) -> DataFrame:
    return extract.extract_elements(v.inputs)


@query
def extract_elements_allow_dups(v: Views) -> DataFrame:
    return extract.extract_elements(v.inputs, allow_duplicates=True)


@query
def new_elements_written(v: Views) -> DataFrame:
    path = scratch(v, "out")
    sinks.write_elements(v.new_elements, path, scratch(v, "new"), "csv")
    return tables.read_elements(v.spark, path)


@query
def duplicate_keys(v: Views) -> DataFrame:
    return identity.duplicate_keys(extract.label_leaves(v.sheet_rows, v.plot_projects))


# --- aggregations ----------------------------------------------------------------------------------------------------


@query
def run_stats(v: Views) -> DataFrame:
    return extract.run_stats(v.inputs)


@query
def run_stats_allow_dups(v: Views) -> DataFrame:
    return extract.run_stats(v.inputs, allow_duplicates=True)


@query
def run_status(v: Views) -> DataFrame:
    return extract.run_status(extract.extraction_errors(v.files, v.plot_projects))


def workbook_inputs(v: Views, root: str | None = None) -> tuple[extract.Inputs, DataFrame]:
    """Inputs and unreadable files from workbooks, each opened once; they are made unless a folder has them."""
    scanned = sheets.scan_files(v.spark, root or packed(v))
    return extract.read_inputs(scanned, v.plot_projects, v.design_elements, work=scratch(v, "parsed"))


@query
def extract_workbooks(v: Views) -> DataFrame:
    """Folders of workbooks to new elements in one run."""
    return extract.extract_elements(workbook_inputs(v)[0])


@query
def workbook_run_stats(v: Views) -> DataFrame:
    return extract.run_stats(workbook_inputs(v)[0])


@query
def workbook_run_status(v: Views) -> DataFrame:
    inputs, failed = workbook_inputs(v)
    return extract.run_status(extract.extraction_errors(inputs.files, v.plot_projects, failed))


@query
def workbook_errors(v: Views) -> DataFrame:
    scanned = sheets.scan_files(v.spark, packed(v))
    inputs, failed = extract.read_inputs(scanned, v.plot_projects, v.design_elements)
    return extract.extraction_errors(inputs.files, v.plot_projects, failed)


def _appended(v: Views) -> AppendReport:
    path = scratch(v, "reported-master")
    incremental.create_store(v.design_elements, path)
    return append_and_report(v.spark, v.new_located, path, scratch(v, "append"), v.targets, "20250101_000000")


@query
def append_report_reconciliation(v: Views) -> DataFrame:
    return _appended(v).reconciliation


@query
def append_report_by_type(v: Views) -> DataFrame:
    return _appended(v).by_type


@query
def append_report_issues(v: Views) -> DataFrame:
    return _appended(v).issues


@query
def append_report_by_project(v: Views) -> DataFrame:
    return _appended(v).by_project


@query
def append_report_matrix(v: Views) -> DataFrame:
    return _appended(v).matrix


@query
def append_report_blocks(v: Views) -> DataFrame:
    return _appended(v).blocks


@query
def repair_and_publish(v: Views) -> DataFrame:
    """A versioned master without one root row, mended and published, with a snapshot of what was there."""
    base = scratch(v, "published")
    sinks.rewrite(v.design_elements, base)
    assert publish_repair(v.spark, base, RESTORED_PLOT, scratch(v, "repair"), "20250101_000000") == 2
    return sinks.read_current(v.spark, base)


@query
def rows_per_file(v: Views) -> DataFrame:
    return rollups.rows_per_file(v.files, v.sheet_rows)


@query
def count_by_type(v: Views) -> DataFrame:
    return rollups.count_by(v.design_elements.select("TYPE").unionAll(v.new_elements.select("TYPE")), "TYPE")


@query
def count_by_project(v: Views) -> DataFrame:
    return rollups.count_by(v.new_elements, "PROJECT_ID")


@query
def project_type_matrix(v: Views) -> DataFrame:
    return rollups.project_type_matrix(v.new_elements)


@query
def target_summary(v: Views) -> DataFrame:
    both = v.design_elements.select(*ELEMENT_FIELDS).unionByName(v.new_elements)
    return rollups.target_summary(both, v.targets)


@query
def block_breakdown(v: Views) -> DataFrame:
    return rollups.block_breakdown(written_new(v), VISIT_ORDER)


@query
def lookup_stats(v: Views) -> DataFrame:
    return rollups.lookup_stats(v.plot_projects, lookups.surviving(v.design_elements, MASTER_ORDER))


@query
def project_element_sets(v: Views) -> DataFrame:
    return rollups.project_elements(lookups.surviving(v.design_elements, MASTER_ORDER))


@query
def reconcile_append(v: Views) -> DataFrame:
    path = scratch(v, "master")
    before = v.design_elements.select(*ELEMENT_FIELDS)
    before.write.parquet(path)
    new = sinks.handoff(v.new_elements, scratch(v, "new"))
    return rollups.reconcile(before, new, sinks.append_elements(new, path))


@query
def plot_presence(v: Views) -> DataFrame:
    return rollups.plot_presence(v.design_elements, v.targets)


@query
def new_plots(v: Views) -> DataFrame:
    plots = extract.plot_elements(*_known(v)).where("ID_is_new")
    return plots.select("ID", "PROJECT_ID", "NAME").withColumn("n_new", plots.agg(F.count(F.lit(1))).scalar())


@query
def issue_summary(v: Views) -> DataFrame:
    return verify.issue_summary(extract.extraction_errors(v.files, v.plot_projects), verify.hierarchy_issues(written_new(v)))


# --- verification and repair -----------------------------------------------------------------------------------------


@query
def extraction_errors(v: Views) -> DataFrame:
    return extract.extraction_errors(v.files, v.plot_projects)


@query
def hierarchy_issues(v: Views) -> DataFrame:
    return verify.hierarchy_issues(written_new(v))


@query
def hierarchy_issues_full(v: Views) -> DataFrame:
    checked = written_new(v).select(*ELEMENT_FIELDS).unionByName(v.bad_elements)
    return verify.hierarchy_issues(sinks.handoff(checked, scratch(v, "checked")), v.design_elements)


@query
def master_issues(v: Views) -> DataFrame:
    return verify.hierarchy_issues(v.design_elements)


@query
def first_issues(v: Views) -> DataFrame:
    return verify.first_issues(verify.hierarchy_issues(written_new(v)))


@query
def sheet_profile(v: Views) -> DataFrame:
    return verify.sheet_profile(v.sheet_cells)


@query
def header_candidates(v: Views) -> DataFrame:
    return verify.header_candidates(v.sheet_cells)


@query
def column_patterns(v: Views) -> DataFrame:
    return verify.column_patterns(v.sheet_cells)


@query
def column_headers(v: Views) -> DataFrame:
    return verify.column_headers(v.sheet_cells)


@query
def column_samples(v: Views) -> DataFrame:
    return verify.column_samples(v.sheet_cells)


@query
def sheet_head(v: Views) -> DataFrame:
    return verify.sheet_head(v.sheet_cells)


@query
def file_audit(v: Views) -> DataFrame:
    return verify.file_audit(v.files)


@query
def files_top2(v: Views) -> DataFrame:
    return verify.files_top(v.files)


@query
def repair_glued_rows(v: Views) -> DataFrame:
    return repair.split_glued_lines(v.raw_lines)


@query
def truncate_glued_rows(v: Views) -> DataFrame:
    return repair.truncate_glued_lines(v.raw_lines)


@query
def repair_glued_file(v: Views) -> DataFrame:
    path = scratch(v, "lines")
    header = v.spark.range(1).select(F.lit(",".join(ELEMENT_FIELDS)).alias("value"))
    header.unionAll(v.raw_lines.select("value")).write.text(path)
    return repair.split_glued_lines(tables.read_lines(v.spark, path)).select(*ELEMENT_FIELDS)


@query
def missing_parents(v: Views) -> DataFrame:
    return repair.missing_parents(v.design_elements)


@query
def restore_missing_plot(v: Views) -> DataFrame:
    return repair.restore_missing_plot(v.design_elements, RESTORED_PLOT)


@query
def verify_repair(v: Views) -> DataFrame:
    restored = sinks.handoff(repair.restore_missing_plot(v.design_elements, RESTORED_PLOT), scratch(v, "repaired"))
    wanted = restored.where((F.col("NAME") == RESTORED_PLOT) & (F.col("TYPE") == "PLOT"))
    return repair.verify_repair(restored, wanted.agg(F.min("ID")).scalar())


# --- streaming -------------------------------------------------------------------------------------------------------


def _arrivals(v: Views, odd: bool = False) -> str:
    """Workbooks arrive in two waves; each is one run of the stream; the store."""
    root, shadow, store, checkpoint = (scratch(v, n) for n in ("arrivals", "shadow", "store", "progress"))
    incremental.create_store(v.design_elements, store)
    plots = sinks.handoff(v.plot_projects, scratch(v, "plots"))
    early = F.substring("folder_name", 1, 1) < "C"
    for wave in (v.workbook_rows.where(early), v.workbook_rows.where(~early)):
        packed(v, wave, root)
        if odd:
            workbooks.write_files(v.odd_files, root)
        stream = incremental.file_stream(v.spark, root, shadow)
        incremental.start(stream, store, plots, checkpoint).awaitTermination()
    return store


@query
def incremental_extract(v: Views) -> DataFrame:
    """New elements of a stream that runs twice, the second time against the master left by the first."""
    return incremental.read_store(v.spark, _arrivals(v)).where("batch_id >= 0").select(*ELEMENT_FIELDS)


@query
def incremental_errors(v: Views) -> DataFrame:
    """What these runs could not use, with unreadable files, hidden names and hidden folders among the workbooks."""
    return incremental.read_errors(v.spark, _arrivals(v, odd=True)).select("kind", "folder_name", "file_name")


def _ledger_arrivals(v: Views, odd: bool = False) -> str:
    """The same two waves, each one run kept by the ledger of files in place of a stream's checkpoint."""
    root, store = scratch(v, "arrivals"), scratch(v, "store")
    incremental.create_store(v.design_elements, store)
    plots = sinks.handoff(v.plot_projects, scratch(v, "plots"))
    early = F.substring("folder_name", 1, 1) < "C"
    for wave in (v.workbook_rows.where(early), v.workbook_rows.where(~early)):
        packed(v, wave, root)
        if odd:
            workbooks.write_files(v.odd_files, root)
        ledger.run(v.spark, root, store, plots)
    return store


@query
def ledger_extract(v: Views) -> DataFrame:
    """New elements of two runs kept by the ledger of files."""
    return incremental.read_store(v.spark, _ledger_arrivals(v)).where("batch_id >= 0").select(*ELEMENT_FIELDS)


@query
def ledger_errors(v: Views) -> DataFrame:
    """What runs kept by the ledger could not use, with unreadable files, hidden names and hidden folders."""
    return incremental.read_errors(v.spark, _ledger_arrivals(v, odd=True)).select("kind", "folder_name", "file_name")


def _with_empty_folders(v: Views) -> str:
    """The workbooks, and for every region two folders without workbooks: one named for a plot, one hidden."""
    root = packed(v)
    named = F.expr(f"{standins.REGION_CODE.replace('n_regionkey', 'r_regionkey')} - 0 MW'")
    folders = v.table("region").select(F.explode(F.array(named, F.concat(F.lit("_empty"), F.col("r_regionkey")))).alias("d"))
    workbooks.make_folders(folders, root)
    return root


@query
def empty_folders(v: Views) -> DataFrame:
    """Folders without workbooks, listed inside tasks, and what a run makes of each: success or an error."""
    listing = folders.list_folders(v.spark, _with_empty_folders(v))
    return folders.folder_status(folders.empty_folders(listing), v.plot_projects)


@query
def append_then_dedupe(v: Views) -> DataFrame:
    """Two appends with the keys that the master has; the rows of the last one survive."""
    path = scratch(v, "ordered-master")
    incremental.create_store(v.design_elements, path)
    for name in ("first", "second"):
        again = v.design_elements.withColumn("ID", F.concat("ID", F.lit(f"-{name}")))
        incremental.append(v.spark, again, path, "ord")
    master = incremental.read_store(v.spark, path)
    return lookups.surviving(master, incremental.STORE_ORDER).select(*ELEMENT_FIELDS, "batch_id")
