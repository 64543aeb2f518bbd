"""Mixes of sources against targets by hand."""

import pytest

from treeledger.llm import mixing
from treeledger.llm.queries import QUERIES


def targets_by_hand(sizes, weights=(3, 1, 2), share=1.5, limit=2):
    """Share by weight, stop at the limit, share what is over again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), list(order), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if level * weight[s] > limit * sizes[s]]
        if not over:
            return out | {s: level * weight[s] for s in open_}
        for s in over:
            out[s] = limit * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize(
    "sizes",
    [
        {"a": 100, "b": 100, "c": 100},
        {"a": 5, "b": 1000, None: 7, "é": 300, "Z": 0},
        {"x": 1},
        {None: 50},
        {"a": 0, "b": 0},
    ],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "_source string, _source_size long")
    got = {r["_source"]: r["_target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(targets_by_hand(sizes))


def test_query_is_near_its_targets_and_repeats_itself(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = QUERIES["op3_mixing"](spark, sf_dir).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    sizes, taken, targets, longest = {}, {}, {}, {}
    for r in rows:
        source = docs[r.doc_id].source
        assert r["size"] == len((docs[r.doc_id].text or "").split()) and 0 <= r.taken <= 2 * r["size"]
        sizes[source] = sizes.get(source, 0) + r["size"]
        taken[source] = taken.get(source, 0) + r.taken
        longest[source] = max(longest.get(source, 0), r["size"])
        targets[source] = r.target
    assert len(rows) == len(docs) and targets == pytest.approx(targets_by_hand(sizes))
    assert all(abs(taken[s] - targets[s]) <= longest[s] / 2 + 1 for s in sizes)
    assert all(r.source_size == sizes[docs[r.doc_id].source] for r in rows)
    again = {(r.doc_id, r.taken) for r in QUERIES["op3_mixing"](spark, sf_dir).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


def test_odd_rows(spark):
    df = spark.createDataFrame(
        [(1, None, None, 1), (2, "", "a", 1), (3, "one two", "a", 1), (3, "one two", "a", 1), (None, "x " * 30_000, None, 1)],
        "doc_id long, text string, source string, size int",
    )
    got = mixing.mixed(df).collect()
    assert sorted(r["size"] for r in got) == [0, 0, 2, 2, 30_000]
    twice = [r.taken for r in got if r.doc_id == 3]
    assert twice[0] == twice[1]
    kept = mixing.mixed(df, keep=True).collect()
    assert len(kept) == 5 and {r["_row"]["size"] for r in kept} == {1}
    assert mixing.mixed(df.limit(0)).collect() == []


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op3_mixing"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "MapInArrow", "NestedLoop", "Cartesian"))
