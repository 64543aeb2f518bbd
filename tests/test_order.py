"""Picking and numbering rows against plain Python, with a hot key."""

import random

from conftest import rows
from pyspark.sql import functions as F

from treeledger.operators.identity import duplicate_keys, first_by_key, resolve_ids
from treeledger.operators.lookups import lookup_by_id, lookup_elements, lookup_plots, plot_map, plot_projects, surviving
from treeledger.operators.order import keep_first, keep_last, number_rows
from treeledger.functions.keys import with_keys


def test_keep_first_and_last(spark):
    rng = random.Random(1)
    data = [(rng.choice("aaaaabc"), i // 7, i % 7, str(rng.random())) for i in range(500)]
    rng.shuffle(data)
    df = spark.createDataFrame(data, "k string, o1 int, o2 int, v string").repartition(5)
    first, last = {}, {}
    for k, a, b, v in data:
        first[k] = min(first.get(k, (a, b, v)), (a, b, v))
        last[k] = max(last.get(k, (a, b, v)), (a, b, v))
    assert rows(keep_first(df, ["k"], ["o1", "o2"])) == sorted([(k, *t) for k, t in first.items()], key=repr)
    assert rows(keep_last(df, ["k"], ["o1", "o2"])) == sorted([(k, *t) for k, t in last.items()], key=repr)


def test_keep_first_has_one_shuffle_with_partial_aggregation(spark):
    df = spark.createDataFrame([("a", 1, "x")], "k string, o int, v string").repartition(5)
    plan = keep_first(df, ["k"], ["o"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_min_by" in plan


def test_number_rows(spark):
    rng = random.Random(2)
    keys = rng.sample(range(5000), 900)
    data = [("hot" if rng.random() < 0.6 else rng.choice("abc"), k) for k in keys]
    df = spark.createDataFrame(data, "g string, k bigint")
    want = {}
    for g in {g for g, _ in data}:
        for n, k in enumerate(sorted(k for h, k in data if h == g), 1):
            want[g, k] = n
    for width in (7, 64, 1 << 16):
        got = {(r.g, r.k): r.n for r in number_rows(df, ["g"], "k", "n", width).collect()}
        assert got == want
    whole = [(r.k, r.n) for r in number_rows(df, [], "k", "n", 50).orderBy("k").collect()]
    assert whole == [(k, n) for n, k in enumerate(sorted(keys), 1)]


def test_plot_map_follows_first_position_and_last_values(spark):
    data = [
        (1, "r1", "P1", "id1", "A-1a"),
        (2, "r2", "P2", "id2", "a-1A"),
        (3, "r3", "P3", "id1", "A-1A"),  # id1 keeps position 1, so id2 still wins the name
        (4, "r4", "P4", "id4", "B-2b"),
        (5, "r5", "P5", "id4", "C-3c"),  # the name B-2b is gone
    ]
    pp = spark.createDataFrame(data, "ord int, ID string, PROJECT_ID string, PLOT_ID string, PLOT_NAME string")
    assert rows(plot_projects(pp)) == [("A-1A", "id2", "a-1A", "P2"), ("C-3C", "id4", "C-3c", "P5")]
    plots = spark.createDataFrame([(1, "id2", "old"), (2, "id2", "new")], "ord int, ID string, LOCATION_ID string")
    full = plot_map(pp, plots)
    assert rows(full, "k_plot", "LOCATION_ID") == [("A-1A", "new"), ("C-3C", None)]
    asked = spark.createDataFrame([("A-1a",), ("b-2b",)], "requested_plot string")
    assert rows(lookup_plots(asked, full), "requested_plot", "PROJECT_ID") == [("A-1a", "P2"), ("b-2b", None)]


MASTER = [
    (1, "I1", "p", "n1", "TABLE", "x"),
    (2, "I2", "P", "N1", "table", "y"),
    (3, "I1", "p", "n2", "TABLE", "z"),
    (4, "i3", "p", "n3", "BLOCK", ""),
]


def master(spark):
    return spark.createDataFrame(MASTER, "ord int, ID string, PROJECT_ID string, NAME string, TYPE string, PARENT_ID string")


def test_lookups_see_the_last_row_of_a_key(spark):
    m = master(spark)
    assert rows(surviving(m, ["ord"]), "ID", "PARENT_ID") == [("I1", "z"), ("I2", "y"), ("i3", "")]
    asked = spark.createDataFrame([("p", "n1", "Table"), ("p", "n9", "TABLE")], "PROJECT_ID string, NAME string, TYPE string")
    got = rows(lookup_elements(asked, m, ["ord"]), "NAME", "found", "found_id", "found_parent_id")
    assert got == [("n1", True, "I2", "y"), ("n9", False, None, None)]
    by_id = lookup_by_id(spark.createDataFrame([("i1",), ("I3",), ("i9",)], "request_id string"), m, ["ord"])
    assert rows(by_id, "request_id", "NAME") == [("I3", "n3"), ("i1", "n2"), ("i9", None)]


def test_shared_id_gives_the_key_that_was_met_last(spark):
    # k1 is met first but written last; the id still belongs to k2, which was met later.
    data = [(1, "X", "p", "k1", "T", ""), (2, "X", "p", "k2", "T", ""), (3, "X", "p", "K1", "T", "")]
    m = spark.createDataFrame(data, "ord int, ID string, PROJECT_ID string, NAME string, TYPE string, PARENT_ID string")
    assert rows(lookup_by_id(spark.createDataFrame([("x",)], "request_id string"), m, ["ord"]), "NAME") == [("k2",)]


def test_resolve_ids(spark):
    asked = with_keys(spark.createDataFrame([("P", "N3", "Block"), ("P", "N4", "BLOCK")], "PROJECT_ID string, NAME string, TYPE string"))
    got = resolve_ids(asked, master(spark), ["ord"], F.lit("new"))
    assert rows(got, "NAME", "ID", "is_new") == [("N3", "i3", False), ("N4", "new", True)]


def test_first_by_key_and_duplicates(spark):
    data = [
        ("f1", "a", 2, 1, "P", "R1", "TABLE", "B1"),
        ("f1", "a", 3, 1, "p", "r1", "TABLE", "B1"),
        ("f0", "z", 9, 1, "P", "r1", "TABLE", "B2"),
        ("f1", "a", 3, 2, "P", "R1", "INVERTER", "B1"),
    ]
    df = spark.createDataFrame(
        data, "folder_name string, file_name string, row_idx bigint, col_idx int, PROJECT_ID string, NAME string, TYPE string, block_name string"
    )
    assert rows(first_by_key(df), "folder_name", "NAME", "TYPE") == [("f0", "r1", "TABLE"), ("f1", "R1", "INVERTER")]
    assert rows(duplicate_keys(df)) == [("p", "R1", "TABLE", 3, 2)]
