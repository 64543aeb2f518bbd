"""Near-duplicate components against brute force."""

import random

import pytest
from compare import connect, difference

from treeledger.llm import near_dedup
from treeledger.llm.components import components
from treeledger.llm.queries import ORACLES, QUERIES


def lower(word):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in word)


def shingles(text, width):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    words = [lower(w) for w in text.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def by_hand(rows, width):
    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    different = {}
    links = []
    for i, s in sets:
        if s:
            links.append((i, different.setdefault(s, i)))
    listed = list(different.items())
    for k, (s, i) in enumerate(listed):
        for t, j in listed[:k]:
            common = len(s & t)
            if 100 * common >= 80 * (len(s) + len(t) - common):
                links.append((i, j))
    return {i: (len(s), c) for (i, s), c in zip(sets, map(least_reachable([i for i, _ in sets], links).get, [i for i, _ in sets]))}


def check(spark, rows, width):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dedup.classes(df, width=width).collect()
    assert len(got) == len(rows)
    want = by_hand(rows, width)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def copies(rng, base, n, changes):
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randrange(changes + 1)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        yield " ".join(words)


@pytest.mark.parametrize("long_", [64, 5])
def test_groups_of_all_sizes(spark, monkeypatch, long_):
    """With a low limit most lists are skipped, and links must be found by pivots and blocks."""
    monkeypatch.setattr(near_dedup, "LONG", long_)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    rng = random.Random(7)
    texts = []
    for n, size in ((60, 120), (2, 40), (3, 30), (25, 80), (1, 9)):
        base = [f"b{rng.randrange(500)}" for _ in range(size)]
        texts += copies(rng, base, n, 6 if n > 10 else 2)
    texts += [None, "", " \t\n", "One two", "one TWO", "one", "a b c", "É x y", "é x y", " ".join(["same"] * 5000)] + ["copy of this text here"] * 30
    rows = list(zip(range(100, 100 + len(texts)), texts))
    rng.shuffle(rows)
    check(spark, [*rows, (None, "copy of this text here"), (None, None)], 4)


def test_repeated_rows_and_empty_tables(spark):
    check(spark, [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f")], 5)
    assert near_dedup.classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    want = by_hand(rows, 4)
    got = QUERIES["op6_near_dedup"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert difference(QUERIES["op6_near_dedup"](spark, sf_dir), connect(sf_dir), ORACLES["op6_near_dedup"]) is None


def test_components(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(200, 400)] + [(rng.randrange(100), rng.randrange(100)) for _ in range(60)] + [(7, 7)]
    nodes = {n for a, b in links if a != b for n in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == least_reachable(nodes, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
