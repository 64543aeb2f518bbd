"""Name rules on known inputs."""

import pytest
from pyspark.sql import functions as F

from treeledger.functions import names as N
from treeledger.functions.keys import element_id

# File names and the plot and block they stand for.
DASHED = "603C-LT Cable Routing-A16a-BL01-R0-30032025_DWGData.xlsx"
SPACED = "603C-LT Cable Routing A16a-BL04-R0-30032025_DWGData.xlsx"


def apply(spark, values, *expressions):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [tuple(r) for r in df.orderBy("i").select(*[e(F.col("v")) for e in expressions]).collect()]


def test_plot_from_folder(spark):
    cases = {
        "A16a - 50 MW": ("A-16a", "A-16a"),
        "A16b - 200 MW": ("A-16b", "A-16b"),
        "A16c - 167 MW": ("A-16c", "A-16c"),
        "A16d - 333 MW": ("A-16d", "A-16d"),
        "S05b - 100 MW": ("S-05b", "S-05b"),
        "S08b - 100 MW": ("S-08b", "S-08b"),
        "A16a": ("A-16a", None),
        "a16A-x": ("A-16a", None),
        "A16 - x": ("A-16", None),
        "A-16a - x": (None, None),
        "\t\u2003A16a \u00a0- x \n": ("A-16a", "A-16a"),
        "A16a-": ("A-16a", None),
        "A16a - ": ("A-16a", None),
        "A16a\u2003-\u2003x": ("A-16a", "A-16a"),
        "A16ab - x": (None, None),
        "": (None, None),
        "  ": (None, None),
        "-A16a": (None, None),
        "A16a-b-c": ("A-16a", "A-16a"),
    }
    assert apply(spark, cases, N.plot_from_folder, N.plot_from_folder_strict) == list(cases.values())


def test_block_and_plot_from_file(spark):
    cases = {
        DASHED: ("BL01", "A-16a"),
        SPACED: ("BL04", None),
        DASHED.replace("A16a-BL01", "A16b-BL02"): ("BL02", "A-16b"),
        "x-s05-bl007-BL9-": ("BL007", "S-05"),
        "x-A1-BL-2": (None, "A-1"),
        "BL01-": (None, None),
        "": (None, None),
    }
    assert apply(spark, cases, N.block_from_file, N.plot_from_file) == list(cases.values())


def test_strip_block_prefix(spark):
    cases = {
        "B01-R42-S01": "R42-S01",
        "B02-I45": "I45",
        "BO4-R31-S01": "R31-S01",
        "bo4-x": "x",
        "B03-R40-T01": "R40-T01",
        "R42-S01": "R42-S01",
        "B-R1": "B-R1",
        "B01-": "B01-",
        "B01-a\nb": "B01-a\nb",
        "B01-B02-x": "B02-x",
        "BOO1-x": "BOO1-x",
        "": "",
        "B01-$1\\": "$1\\",
    }
    assert apply(spark, cases, N.strip_block_prefix) == [(v,) for v in cases.values()]


def test_clean_cell_strips_every_kind_of_space(spark):
    around = N.WHITESPACE
    assert len(around) == 29 and all(c.isspace() for c in around)
    cases = {around + "a b" + around: "a b", around: None, "": None, "0": "0", "\u200b": "\u200b"}
    assert apply(spark, cases, N.clean_cell) == [(v,) for v in cases.values()]


def test_leaf_name_keeps_inner_space(spark):
    cases = {" B01- R1 ": " R1", "\u2003B01-R42-S01\n": "R42-S01", "  ": None}
    assert apply(spark, cases, N.leaf_name) == [(v,) for v in cases.values()]


def test_classify(spark):
    cases = {
        "R42-S01": ("TABLE", "TABLE"),
        "R31-T05": ("TABLE", "TABLE"),
        "r40-s02": ("TABLE", "TABLE"),
        "I45": ("INVERTER", "INVERTER"),
        "i41": ("INVERTER", "INVERTER"),
        "X9": ("TABLE", None),
        "I": ("TABLE", None),
        "R1-U2": ("TABLE", None),
    }
    assert apply(spark, cases, N.classify, lambda c: N.classify(c, strict=True)) == list(cases.values())


def test_validators(spark):
    cases = {
        "A-16a": (True, False, False, False),
        "S-08b": (True, False, False, False),
        "a-16a": (False, False, False, False),
        "A-16": (False, False, False, False),
        "BL01": (False, True, False, False),
        "bl99": (False, True, False, False),
        "R42-S01": (False, False, True, False),
        "I41": (False, False, False, True),
        "Invalid": (False, False, False, False),
    }
    assert apply(spark, cases, N.is_plot, N.is_block, N.is_table, N.is_inverter) == list(cases.values())


@pytest.mark.parametrize(
    "a, b, want", [("A-16a", "A-16a", True), ("A-16a", "a-16A", True), ("A-16a", "A-16b", False), ("A-16a", None, False), (None, None, False)]
)
def test_same_plot(spark, a, b, want):
    df = spark.createDataFrame([(a, b)], "a string, b string")
    assert df.select(N.same_plot("a", "b")).first()[0] is want


def test_four_known_pairs_agree(spark):
    pairs = [
        ("A16a - 50 MW", DASHED),
        ("A16b - 200 MW", "603D-LT Cable Routing-A16b-BL01-R0-03042025_DWGData.xlsx"),
        ("A16c - 167 MW", "603E-LT Cable Routing-A16c-BL02-R0-08042025_DWGData.xlsx"),
        ("A16d - 333 MW", "603F-LT Cable Routing-A16d-BL01-R0-24042025_DWGData.xlsx"),
    ]
    df = spark.createDataFrame(pairs, "folder string, file string")
    same = df.select(N.same_plot(N.plot_from_folder("folder"), N.plot_from_file("file")))
    assert [r[0] for r in same.collect()] == [True] * 4


def test_path_parts(spark):
    cases = {
        "c:\\data\\A16a - 50 MW\\" + DASHED: ("A16a - 50 MW", DASHED),
        "file:/x//A16a - 50 MW/" + DASHED: ("A16a - 50 MW", DASHED),
        "f.xlsx": ("", "f.xlsx"),
        "/f.xlsx": ("", "f.xlsx"),
        "a/b/": ("a", "b"),
    }
    assert apply(spark, cases, lambda c: N.path_parts(c)[0], lambda c: N.path_parts(c)[1]) == list(cases.values())


def test_shorten_and_label(spark):
    assert apply(spark, ["x" * 30, "x" * 31], N.shorten) == [("x" * 30,), ("x" * 27 + "...",)]
    df = spark.createDataFrame([(None, "0123456789"), ("A", "0123456789")], "name string, id string")
    assert [r[0] for r in df.select(N.label("name", "id")).collect()] == ["01234567...", "A"]


def test_ids_are_reproducible_and_keep_parts_apart(spark):
    df = spark.createDataFrame([("P", "ab", "c"), ("p", "AB", "C"), ("P", "a", "bc")], "p string, n string, f string")
    first, folded, other = [r[0] for r in df.select(element_id(F.lit("TABLE"), "p", "n")).collect()]
    assert first == folded != other and [len(x) for x in first.split("-")] == [8, 4, 4, 4, 12]
    apart = [r[0] for r in df.select(element_id(F.lit("TABLE"), "p", "n", "f")).collect()]
    assert len(set(apart)) == 3
