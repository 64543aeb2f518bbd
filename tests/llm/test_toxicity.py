"""The pattern grammar, and held-out accuracy of the scores."""

import pytest

from treeledger.llm import toxicity
from treeledger.llm.queries import QUERIES


@pytest.fixture(scope="module")
def scored_clause():
    lexicon = toxicity.Lexicon({"idiot$": 4.0, "achlich": 3.0})
    lexicon.prepare()
    machine = toxicity.grammar()
    return lambda text: [round(machine.score(c), 3) for c in lexicon.clauses(text)]


def test_clauses(scored_clause):
    assert scored_clause("An idiot. All fine; ACHLICHE there!\nidiots idiotic") == [4.0, 3.0]
    assert scored_clause("the idiot wins") == [4.0]
    assert scored_clause("you idiot") == [5.0]  # aimed at a target
    assert scored_clause("idiot, you") == [4.5]
    assert scored_clause("not an idiot") == [1.2]  # negated
    assert scored_clause("not in any way at all an idiot") == [4.0]  # out of the negation's reach
    assert scored_clause("someone wrote idiot there") == [2.0]  # reported
    assert scored_clause("i will kill you") == [3.0] and scored_clause("i will kill time") == [0.0]
    assert scored_clause("") == [] and scored_clause("xidiot machlich") == []


def test_composition_is_that_of_its_parts():
    machine = toxicity.grammar()
    assert len(machine.states()) == (toxicity.NEGATION_REACH + 1) * 2 * 3 * 4
    assert machine.score([("N", 0), ("T", 0), ("I", 2.0)]) == pytest.approx(2.0 * 0.3 * 1.25)


def test_held_out_accuracy(spark):
    """Labels of the larger table that were not learned from; some labels are noise."""
    sf_dir = "/root/testdata/sf0.01"
    scores = QUERIES["op1_toxicity"](spark, sf_dir)
    assert scores.count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    rows = scores.join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)
    clean = [r for r in rows if not r.toxic]
    assert sum(r.predicted for r in clean) <= 0.05 * len(clean)


def test_odd_rows_and_missing_labels(spark):
    docs = spark.createDataFrame(
        [(1, None, 9.0), (2, "", 9.0), (3, "you idiot. you moron", 9.0), (3, "you idiot. you moron", 9.0), (None, "x " * 50_000, 9.0)],
        "doc_id long, text string, tox_sum double",
    )
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one_kind = spark.createDataFrame([(1, 1, 0), (None, 1, 1), (2, 1, None)], "doc_id long, quality int, toxic int")
    for labels in (none, one_kind):
        got = toxicity.scored(docs, toxicity.fit(docs, labels)).collect()
        assert len(got) == 5
        score = {(r.doc_id, r.text): r.score for r in got}
        assert score[3, "you idiot. you moron"] > 0.5 > max(v for (i, _), v in score.items() if i != 3)
    assert toxicity.scored(docs.limit(0), toxicity.fit(docs.limit(0), none)).collect() == []


def test_labels_of_held_out_rows_teach_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    from pyspark.sql import functions as F

    from treeledger.llm.common import remainder_of_id

    flipped = F.when(remainder_of_id("doc_id", 5) == 0, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    one, two = (toxicity.fit(docs, x) for x in (labels, labels.withColumn("toxic", flipped)))
    assert (one.lexicon.insults, one.weights, one.bias) == (two.lexicon.insults, two.weights, two.bias)
