"""The pipeline: each stage against its operator by hand, and odd tables through all of them."""

import os
import subprocess
import sys

import pytest

import corpus_pipeline
from test_bpe_tokens import ids_of
from test_near_dedup import by_hand

from treeledger.llm import toxicity
from treeledger.llm.common import stored


def test_stages_are_named_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_dedup", "pii", "mixing", "bpe"]


@pytest.fixture(scope="module")
def stepwise(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(stored(stage(spark, out[-1], sf_dir), f"test-{name}"))
    return out


def test_columns(stepwise):
    assert all(df.columns == stepwise[0].columns for df in stepwise[:-1])


def test_each_stage(spark, sf_dir, stepwise):
    docs, clean, single, private, mixed, coded = ([tuple(r) for r in df.collect()] for df in stepwise)
    model = toxicity.fit(stepwise[0], spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scores = {r.doc_id: r.score for r in toxicity.scored(stepwise[0], model).collect()}
    assert sorted(clean) == sorted(d for d in docs if scores[d[0]] < 0.5)
    classes = by_hand([d[:2] for d in clean], 5)
    assert sorted(single) == sorted(d for d in clean if classes[d[0]][1] == d[0])
    before = {d[0]: d for d in single}
    assert sorted(d[0] for d in private) == sorted(before)
    for d in private:
        assert d[2:4] == before[d[0]][2:4] and d[4] == len(d[1]) == len(before[d[0]][1]) or d[1] != before[d[0]][1]
    times = {d: 0 for d in private}
    for d in mixed:
        times[d] += 1
    assert max(times.values()) <= 2 and 1.2 < len(mixed) / len(private) < 1.8
    assert sorted(d[:5] for d in coded) == sorted(mixed)
    for d in coded[:100]:
        assert d[5] == ids_of(d[1]) and d[6] == len(d[5])


def test_run_equals_the_stages(spark, sf_dir, stepwise):
    key = lambda df: sorted((r.doc_id, r.n_tokens) for r in df.select("doc_id", "n_tokens").collect())
    assert key(corpus_pipeline.run(spark, sf_dir)) == key(stepwise[-1])


def test_odd_rows_and_empty_tables(spark, sf_dir):
    rows = [(1, None, None, None, None), (2, "", "en", None, 0), (None, "a b c d e f", None, "s", 11), (None, None, "en", "s", 0)]
    rows += [(3, "one two three four five six seven", "en", "s", 33)] * 3
    rows += [(4, "one two three four five six seven", "en", "s", 33), (5, "x " * 40_000 + "97.51.17.173", "en", "t", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = docs.selectExpr("*", "1 as _row", "2 as named", "3 as tox_sum", "4 as copies", "5 as _pii", "6 as toxicity", "7 as size", "8 as kept")
    for df in (docs, clashing, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, df, sf_dir)
            if name != "bpe":
                assert after.columns == df.columns
            if name == "near_dedup" and df.count():
                kept = sorted(r.doc_id for r in after.where("doc_id is not null").collect())
                assert kept == [1, 2, 3, 5] and after.where("doc_id is null").count() == 2
            df = stored(after, f"odd-{name}")
        if "named" in df.columns and df.count():
            assert {r.named for r in df.select("named").collect()} == {2}


def test_the_rest_works_without_these_folders(tmp_path):
    """As it is when the optional folders are deleted."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = (
        "import sys, importlib.abc\n"
        "class Gone(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('treeledger.llm') or name == 'corpus_pipeline': raise ModuleNotFoundError(name)\n"
        "import importlib.util as u; real = u.find_spec\n"
        "u.find_spec = lambda n, p=None: None if n in ('treeledger.llm', 'corpus_pipeline') else real(n, p)\n"
        f"sys.meta_path.insert(0, Gone()); sys.path.insert(0, {root!r})\n"
        "import __spark_entry__ as e\n"
        "assert 'extract_elements' in e.queries() and 'pipeline' not in e.queries() and 'op7_bpe' not in e.queries()\n"
        "e.oracle_sql()\n"
    )
    subprocess.run([sys.executable, "-c", code], check=True, timeout=120)
