"""Extraction from a folder of workbooks against a step-by-step simulation, and its invariants."""

import random
import re

import pytest
from conftest import rows
from pyspark.sql import functions as F

from treeledger.operators.identity import first_by_key, known_keys
from treeledger.operators.verify import hierarchy_issues
from treeledger.plans.extract import Inputs, extract_elements, extract_located, extraction_errors, label_leaves, read_inputs, run_stats, run_status
from treeledger.plans.workbooks import pack, sheet_xml
from treeledger.schema import ELEMENT, ELEMENT_FIELDS, KEY
from treeledger.sources import sheets, sinks

PLOTS = [("A-16A", "pA"), ("A-16B", "pA"), ("B-02", "pB"), ("C-03C", "")]
MASTER = [
    (1, "m1", "PA", "a-16a", "PLOT", ""),
    (2, "m2", "pA", "BL01", "BLOCK", "m1"),
    (3, "m3", "pA", "bl01", "Block", "m1"),
    (4, "m4", "pA", "r1-s1", "table", "m3"),
]
FILES = [
    ("A16a - 50 MW", "x-A16a-BL01-R0.xlsx"),
    ("A16a - 50 MW", "x-A16a-BL02-R0.xlsx"),
    ("A16a - 50 MW", "x A16a-BL03-R0.xlsx"),  # warning only
    ("A16a - 50 MW", "x-A16a-R0.xlsx"),  # no block
    ("A16b", "x-A16b-BL02-R0.xlsx"),  # same project and block as in the first folder
    ("A16b", "x-A16b-bl04-R0.xlsx"),
    ("B02 - 9", "x-B02-BL01-R0.xlsx"),
    ("C03c - 1", "x-C03c-BL01-R0.xlsx"),  # plot without a project
    ("Notes", "x-A16a-BL01-R0.xlsx"),  # folder without a plot
]


def grids(seed):
    rng = random.Random(seed)

    def cell(prefix):
        name = f"{prefix}{rng.randint(1, 6)}" + (f"-{rng.choice('STst')}{rng.randint(1, 3)}" if prefix in "Rr" else "")
        return rng.choice([None, " ", name, f"B01-{name}", f" bo7-{name}\t"])

    out = {}
    for f in FILES:
        grid = [[cell(rng.choice("Rr")), cell(rng.choice("Ii"))] for _ in range(rng.randint(0, 25))]
        if rng.random() < 0.4 and len(grid) > 3:
            grid[rng.randint(1, len(grid) - 1)].append("third")
        out[f] = grid
    return out


def clean(value):
    value = (value or "").strip()
    hit = re.match(r"(?i)BO?\d+-(.+)\Z", value)
    return hit[1] if hit else value


def simulate(tables, allow_duplicates):
    """The run as a sequence of steps; elements are (project, name, type, parent), with the parent by name or id."""
    projects = dict(PLOTS)
    known = {(p.lower(), n.upper(), t.upper()): i for _, i, p, n, t, _ in MASTER}
    made, seen = [], {}

    def obtain(project, name, kind, parent):
        key = (project.lower(), name.upper(), kind)
        if key not in known and key not in seen:
            seen[key] = f"{kind} {project} {name}".upper()
            made.append((project, name, kind, parent))
        return known.get(key) or seen[key]

    for folder, name in sorted(tables):
        plot = re.fullmatch(r"(?i)([a-z])(\d+)([a-z]?)", folder.split("-")[0].strip())
        block = re.search(r"(?i)-bl(\d+)-", name)
        plot = plot and f"{plot[1].upper()}-{plot[2]}{plot[3].lower()}"
        project = projects.get((plot or "").upper())
        if not (project and block):
            continue
        above = obtain(project, f"BL{block[1]}", "BLOCK", obtain(project, plot, "PLOT", ""))
        for row in tables[folder, name]:
            if len(row) != 2:
                break
            for kind, value in zip(("TABLE", "INVERTER"), row):
                if leaf := clean(value):
                    key = (project.lower(), leaf.upper(), kind)
                    if allow_duplicates or (key not in known and key not in seen):
                        seen[key] = "leaf"
                        made.append((project, leaf, kind, above))
    return sorted(made)


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    def build(tables):
        root = tmp_path_factory.mktemp("tree")
        for (folder, name), grid in tables.items():
            (root / folder).mkdir(exist_ok=True)
            (root / folder / name).write_bytes(pack({"DWG Data": sheet_xml([["T", "I"], *grid])}))
        scanned = sheets.scan_files(spark, str(root))
        return read_inputs(
            scanned,
            spark.createDataFrame(PLOTS, "k_plot string, PROJECT_ID string"),
            spark.createDataFrame(MASTER, "ord int, ID string, PROJECT_ID string, NAME string, TYPE string, PARENT_ID string"),
        )

    return build


def named_parents(found):
    """(project, name, type, parent), new parents by type, project and name."""
    names = {e.ID: f"{e.TYPE} {e.PROJECT_ID} {e.NAME}".upper() for e in found}
    return sorted((e.PROJECT_ID, e.NAME, e.TYPE, names.get(e.PARENT_ID, e.PARENT_ID)) for e in found)


@pytest.mark.parametrize("allow_duplicates", [False, True])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_the_simulation(inputs, seed, allow_duplicates):
    tables = grids(seed)
    found = extract_elements(inputs(tables)[0], allow_duplicates).collect()
    assert named_parents(found) == simulate(tables, allow_duplicates)
    assert len({e.ID for e in found}) == len(found)


def test_counters_and_errors(inputs):
    tables = grids(4)
    given, failed = inputs(tables)
    found = extract_elements(given).collect()
    stats = run_stats(given).first().asDict()
    made = [e.TYPE for e in found]
    assert (stats["plots_processed"], stats["plots_skipped"]) == (6, 3)
    assert (stats["blocks_processed"], stats["blocks_skipped"]) == (6, 1)
    for level, kind in (("plots", "PLOT"), ("blocks", "BLOCK"), ("tables", "TABLE"), ("inverters", "INVERTER")):
        assert stats[f"{level}_created"] == made.count(kind)
    for level in ("tables", "inverters"):
        assert stats[f"{level}_extracted"] == stats[f"{level}_created"] + stats[f"{level}_skipped"]
    assert stats["total_created"] == len(found)
    again = run_stats(given, allow_duplicates=True).first()
    assert again["tables_created"] == again["tables_extracted"] == stats["tables_extracted"] and again["tables_skipped"] == 0
    bad = [(*f, "sheet_error") for f in tables if any(len(r) != 2 for r in tables[f])]
    usable = {f for f in FILES if f[0][0] in "AB" and "-BL" in f[1].upper()}
    errors = rows(extraction_errors(given.files, given.plots, failed))
    assert run_status(extraction_errors(given.files, given.plots, failed)).first()["status"] == "errors"
    assert errors == sorted(
        [
            ("no_block", "A16a - 50 MW", "x-A16a-R0.xlsx"),
            ("plot_mismatch", "A16a - 50 MW", "x A16a-BL03-R0.xlsx"),
            ("no_project", "C03c - 1", None),
            ("folder_name", "Notes", None),
            *[(kind, folder, name) for folder, name, kind in bad if (folder, name) in usable],
        ],
        key=repr,
    )


def test_second_run_creates_nothing_and_parents_resolve(spark, inputs):
    given = inputs(grids(5))[0]
    new = extract_elements(given)
    grown = given.master.unionByName(new.withColumn("ord", F.lit(99)))
    assert extract_elements(Inputs(given.files, given.rows, given.plots, grown)).isEmpty()
    assert hierarchy_issues(new, given.master).isEmpty()


def test_no_input_gives_no_elements(spark, inputs):
    given = inputs(grids(6))[0]
    empty = Inputs(given.files.limit(0), given.rows.limit(0), given.plots, given.master)
    assert extract_elements(empty).isEmpty()
    assert run_stats(empty).first()["total_extracted"] == 0


def test_hot_name_and_hot_block_keep_every_row(spark):
    """One name fills a third of the rows and one block nearly all of them."""
    n = 6000
    data = spark.range(n).selectExpr(
        "'A16a' as folder_name", "'x-A16a-BL09-R.xlsx' as file_name", "id + 2 as row_idx",
        "case when id % 3 = 0 then 'R0-S1' else 'R'||id||'-S1' end as table_raw", "cast(null as string) as inverter_raw",
    )
    plots = spark.createDataFrame(PLOTS, "k_plot string, PROJECT_ID string")
    none = spark.createDataFrame([], ELEMENT).withColumn("ord", F.lit(0))
    given = Inputs(data.select("folder_name", "file_name").distinct(), data, plots, none)
    default = extract_elements(given)
    assert default.where("TYPE = 'TABLE'").count() == n - n // 3 + 1
    every = extract_elements(given, allow_duplicates=True)
    assert every.where("TYPE = 'TABLE'").count() == n == every.where("TYPE = 'TABLE'").select("ID").distinct().count()


def test_plan_has_no_python_no_cartesian_and_pre_aggregates(spark, inputs):
    given = inputs(grids(7))[0]
    stored = given.rows.limit(0).drop("error")
    plan = extract_located(Inputs(given.files, spark.createDataFrame([], stored.schema), given.plots, given.master))
    text = plan.select(*ELEMENT_FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in text and "NestedLoop" not in text and "Python" not in text and "partial_min_by" in text


def test_bucketed_master_is_not_shuffled(spark, inputs):
    given, _ = inputs(grids(9))
    sinks.save_bucketed(given.master, "bucketed_master", 8)
    stored = Inputs(given.files, given.rows, given.plots, spark.table("bucketed_master"))
    assert rows(extract_elements(stored)) == rows(extract_elements(given))
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(threshold, "-1")
    try:
        leaves = label_leaves(stored.rows, stored.plots)
        new = first_by_key(leaves).join(known_keys(stored.master), KEY, "left_anti")
        plan = new._jdf.queryExecution().executedPlan().toString()
        unmoved = r"\+- Sort .*\n\s*\+- Filter .*\n\s*\+- FileScan parquet \S*bucketed_master.*Bucketed: true"
        assert re.search(unmoved, plan), plan
        assert rows(new.select("NAME")) == rows(
            extract_elements(given).where("TYPE in ('TABLE', 'INVERTER')").select("NAME")
        )
        # Without broadcasts the whole extraction still gives the same rows.
        assert rows(extract_elements(stored)) == rows(extract_elements(given))
    finally:
        spark.conf.unset(threshold)
