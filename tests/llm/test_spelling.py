"""Spelling variants against a brute-force version of the contract."""

import random
import zlib
from collections import Counter

import pytest

from conftest import rows
from treeledger.llm import spelling
from treeledger.llm.queries import QUERIES

RUN = r"[A-Za-zÀ-ÿ]+"


def one_edit(a: str, b: str) -> bool:
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    """The contract in plain Python, all pairs of words compared."""
    import regex

    counts = Counter()
    for doc_id, text in docs:
        for run in regex.findall(RUN, text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        f = form[w]
        out.append((w, f, root, n, len(near[w]), words[f] if f else None))
    return sorted(out, key=repr)


def corpus(seed=3, docs=300):
    rng = random.Random(seed)
    bases = ["colourful", "analysed", "ñandúes", "grammar", "aaaaaaa", "ababab", "thinking", "thimking", "Straße"]
    vocab = []
    for b in bases:
        vocab += [b] * 40
        for _ in range(6):
            i = rng.randrange(len(b))
            kind = rng.randrange(3)
            c = rng.choice("aeiouxñé")
            v = b[:i] + b[i + 1 :] if kind == 0 else b[:i] + c + b[i:] if kind == 1 else b[:i] + c + b[i + 1 :]
            vocab += [v] * rng.choice([1, 5, 6, 8, 9, 40, 300])
    rng.shuffle(vocab)
    out = []
    for d in range(docs):
        out.append((d, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 60)))))
    return out + [(None, "colourful " * 6), (docs, None), (docs + 1, ""), (docs + 2, "x" * 100_000 + " colourfull" * 7)]


@pytest.fixture()
def fixture_docs(spark):
    data = corpus()
    return data, spark.createDataFrame([(*d, 1, "clash") for d in data + data[:20]], "doc_id long, text string, n long, word string")


def test_matches_brute_force(spark, fixture_docs):
    data, docs = fixture_docs
    got = rows(spelling.variants(docs), "word", "form", "root", "n", "n_near", "form_n")
    assert got == brute(data + data[:20])
    assert any(r[1] is not None for r in got) and any(r[4] > 0 for r in got)


def test_query_on_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    got = rows(QUERIES["op11_spelling"](spark, sf_dir), "word", "form", "root", "n", "n_near", "form_n")
    assert got == brute([tuple(r) for r in docs.collect()])


def test_empty_and_null(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, None)], "doc_id long, text string")
    assert spelling.variants(docs).count() == 0
    assert spelling.variants(docs.limit(0)).count() == 0


def test_pivots_disjoint(spark, fixture_docs):
    _, docs = fixture_docs
    pivots, _ = spelling.pivots_and_prefixes(spelling.counted_words(docs))
    for word, positions in rows(pivots.groupBy("word").agg({"pos": "collect_list"})):
        assert len(positions) == 2 and abs(positions[0] - positions[1]) >= 2, word
