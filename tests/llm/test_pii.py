"""Pseudonyms: format, linkage and reversal."""

import re

import pytest
from pyspark.sql import functions as F

from treeledger.llm import pii
from treeledger.llm.queries import QUERIES


def luhn(digits):
    doubled = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def shape(text):
    return re.sub(r"\d", "9", text)


@pytest.fixture(scope="module")
def changed(spark):
    def run(texts):
        df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
        return [r.text for r in pii.pseudonymised(df).orderBy("id").collect()]

    return run


def test_formats_stay(changed):
    texts = [
        "call +1 (017) 555-7713 or +49 30 1234567, (212) 555-0199",
        "card 4845168114407329, 4845-1681-1440-7329, 4845 1681 1440 7329.",
        "from 97.51.17.173 on 2020-02-29, 29.02.2020 and 02/29/2020",
    ]
    for before, after in zip(texts, changed(texts)):
        assert before != after and shape(re.sub(r"\d+\.\d+\.\d+\.\d+", "IP", before)) == shape(re.sub(r"\d+\.\d+\.\d+\.\d+", "IP", after))
    out = changed(texts)
    cards = [re.sub(r"\D", "", x) for x in re.findall(r"\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{4}", out[1])]
    assert len(set(cards)) == 1 and len(cards) == 3 and luhn(cards[0])
    ip = re.search(r"\d+\.\d+\.\d+\.\d+", out[2]).group()
    assert all(0 <= int(x) < 256 for x in ip.split("."))
    year, month, day = re.search(r"(\d{4})-(\d\d)-(\d\d)", out[2]).groups()
    assert f"{day}.{month}.{year}" in out[2] and f"{month}/{day}/{year}" in out[2]


def test_what_is_not_valid_stays(changed):
    texts = ["4845168114407328", "300.1.1.1 1.2.3.4.5", "31.02.2020 2020-13-01 1850-01-01", "CC BY-NC 4.0.", "", None, "12345 a@b"]
    assert changed(texts) == texts


def test_equal_values_stay_linked_and_others_apart(changed):
    out = changed(["a.b@x.example.com is und.34@mail7.example.com", "mail und.34@mail7.example.com!!", 'token = "0123456789abcdef0123" TOKEN = "0123456789ABCDEF0123"'])
    first, second = re.findall(r"\S+@\S+", out[0]), re.findall(r"[\w.]+@[\w.]+", out[1])
    assert first[1] == second[0] and first[0] != first[1] and "und.34" not in out[0]
    low, high = re.findall(r'"(\w+)"', out[2])
    assert len(low) == len(high) == 20 and low == low.lower() and high == high.upper() and low != "0123456789abcdef0123"


@pytest.mark.parametrize("width", [2, 3, 4])
def test_digits_are_permuted(spark, width):
    df = spark.range(10**width).select(F.lpad("id", width, "0").alias("d"))
    moved = df.withColumn("p", pii.permuted_digits(F.col("d"), "k", "test"))
    back = moved.withColumn("q", pii.permuted_digits(F.col("p"), "k", "test", back=True)).cache()
    assert back.where("q = d").count() == back.select("p").distinct().count() == 10**width
    assert back.where(F.length("p") != width).count() == 0
    other = df.withColumn("p", pii.permuted_digits(F.col("d"), "other key", "test"))
    assert other.join(moved, ["d", "p"]).count() < 10**width / 5


def test_pairs_are_permuted(spark):
    a, b = pii.DAYS
    bounds = (F.lit(a), F.lit(b))
    df = spark.range(a * b).select(F.floor(F.col("id") / b).alias("a"), (F.col("id") % b).alias("b"))
    moved = df.withColumn("p", pii.feistel(F.col("a"), F.col("b"), bounds, "k", "d"))
    assert moved.select("p.a", "p.b").distinct().where((F.col("a") < a) & (F.col("b") < b)).count() == a * b


def test_query_leaves_no_planted_value(spark, sf_dir):
    found = {r.doc_id: r for r in QUERIES["op4_pii"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(found) == len(docs)
    patterns = [r"[\w.+-]+@[\w-]+(?:\.[\w-]+)+", r"\d{1,3}(?:\.\d{1,3}){3}", r"\+1 \(\d{3}\) \d{3}-\d{4}", r"(?i)token = \"(\w+)"]
    for d in docs:
        values = [m for p in patterns for m in re.findall(p, d.text)]
        values += [m for m in re.findall(r"(?<!\d)\d{16}(?!\d)", d.text) if luhn(m)]
        assert not [v for v in values if v in found[d.doc_id].text]
        if not values:
            assert found[d.doc_id].text == d.text
        kept = re.findall(r"(?<!\d)\d{16}(?!\d)", found[d.doc_id].text)
        assert [luhn(m) for m in kept] == [luhn(m) for m in re.findall(r"(?<!\d)\d{16}(?!\d)", d.text)]


def test_clashing_columns_long_texts_and_empty_tables(spark):
    text = "a" * 200_000 + " 97.51.17.173 " + "1" * 50_000 + "@" * 1000
    df = spark.createDataFrame([(1, text, "x", 5)] * 2, "id int, text string, _pii string, n_card int")
    got = pii.pseudonymised(df).collect()
    assert len(got) == 2 and got[0] == got[1] and "97.51.17.173" not in got[0].text and len(got[0].text) > 200_000
    assert got[0].n_ip == 1 and got[0].n_card == 0 and got[0]["_pii"] == "x"
    assert pii.pseudonymised(df.limit(0)).collect() == []


def test_no_python_in_the_plan(spark, sf_dir):
    plan = QUERIES["op4_pii"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "MapInArrow", "Exchange"))
