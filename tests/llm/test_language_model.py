"""The filter, the base model by hand, and held-out scores."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from treeledger.llm import language_model as lm
from treeledger.llm.hashing import word_hashes
from treeledger.llm.queries import QUERIES


def tokens_of(text):
    for c in "\t\n\x0b\x0c\r":
        text = (text or "").replace(c, " ")
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in lower.split(" ") if w] + [None]


def test_hashes_tell_words_apart():
    texts = ["", " a B\tab\nÉ é ", "x" * 5000, "A b", "\x85 \x1c\xa0 b"]
    hashes, counts = word_hashes([t.encode() for t in texts])
    words = [w for t in texts for w in tokens_of(t)[:-1]]
    assert counts.tolist() == [len(tokens_of(t)) - 1 for t in texts] and len(hashes) == len(words)
    assert len({(w, h) for w, h in zip(words, hashes.tolist())}) == len(set(words)) == len(set(hashes.tolist()))


def test_blocks_and_levels():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    counts = np.minimum(rng.zipf(1.5, len(hashes)), 10**6)
    for width in (lm.WORD_BYTES, lm.PAIR_BYTES):
        named = lm.kept_bits(hashes, 4, width)
        blocks = list(lm.packed(named, counts, 4, width)) + list(lm.packed(named[:100], counts[:100], 4, width))
        rows, got = [], {}
        for place in range(16):
            h, n = lm.unpacked(place, [b for p, b in blocks if p == place], 4, width)
            got |= dict(zip(h.tolist(), n.tolist()))
            size, bits = lm.shard(h, n, 1)
            rows.append({"range": place, "size": size, "bits": bits})
        assert got == {h: n * (2 if i < 100 else 1) for i, (h, n) in enumerate(zip(named.tolist(), counts.tolist()))}
        scale = np.concatenate([[0], lm.levels(1)])
        filter_ = lm.Filter.of(rows, 4, width, 1)
        read = scale[filter_.level(hashes)]
        true = np.array([got[h] for h in named.tolist()])
        assert (read >= scale[np.searchsorted(scale[1:], true, "right")]).all()  # nothing is lost
        assert (read > true).mean() < 0.02 and (read < true / 1.11).sum() == 0
        absent = rng.integers(0, 2**64, 20_000, dtype=np.uint64)
        assert (filter_.level(absent) > 0).mean() < 0.02
        known = np.unique(hashes)
        assert (lm.Memory(filter_).level(known) == filter_.level(known)).all()


def test_the_least_count_follows_the_room(monkeypatch):
    counts = np.minimum(np.random.default_rng(2).zipf(1.4, 20_000), 10**6)
    classes, n = np.unique(lm.size_class(counts), return_counts=True)
    sizes = dict(zip(classes.tolist(), n.tolist()))
    assert lm.least_count(sizes, 1) == 1 and lm.least_count({}, 2) == 2
    monkeypatch.setattr(lm, "MAX_BITS", 100_000)
    least = lm.least_count(sizes, 1)
    assert least > 1
    hashes = np.arange(len(counts), dtype=np.uint64)
    assert lm.shard(hashes, counts, least)[0] <= 100_000 < lm.shard(hashes, counts, 1)[0]


def test_a_full_filter_ends():
    full = [{"range": i, "size": 64, "bits": b"\xff" * 8} for i in range(16)]
    got = lm.Filter.of(full, 4, 8, 2).level(np.arange(5, dtype=np.uint64))
    assert (got == len(lm.levels(2))).all()


@pytest.mark.parametrize("hot", [lm.HOT, 8])
def test_query(spark, sf_dir, monkeypatch, hot):
    """With few hot words nearly all counts come from the join."""
    monkeypatch.setattr(lm, "HOT", hot)
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    counts = Counter()
    for i, text in docs:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            counts.update(tokens_of(text))
    n, v = sum(counts.values()), len(counts)
    got = {r.doc_id: r for r in QUERIES["op5_language_model"](spark, sf_dir).collect()}
    assert len(got) == len(docs)
    for i, text in docs:
        words, r = tokens_of(text), got[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(counts[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words), rel=1e-9)
        assert r.held_out == (zlib.crc32(str(i).encode()) % 7 == 2)
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_of_known_tokens_sum_to_at_most_one(spark):
    texts = ["the cat sat on the mat", "the cat ran", "a dog sat on the cat", "the cat sat"] * 5
    model = lm.train(spark.createDataFrame([(t,) for t in texts], "text string"))
    words = sorted({w for t in texts for w in t.split()})
    known, _ = word_hashes([" ".join(words).encode()])
    for word in words:
        # Pairs of this word and each known one; the last token of the first text is the end.
        after, before, counts = lm.tokens([word.encode(), *(f"{word} {w}".encode() for w in words)])
        p = 10 ** lm.log_probabilities(model, lm.Memory(model.words), after, before)
        assert p[1] + p[3::3].sum() <= 1.0001
    assert len(known) == len(words)
    pair = spark.createDataFrame([(1, "the cat sat"), (2, "cat the sat")], "doc_id long, text string")
    scores = {r.doc_id: r.score for r in lm.scored(pair, model).collect()}
    assert scores[1] > scores[2]


def test_odd_rows_and_empty_training(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, ""), (2, "w " * 50_000), (3, " \n")], "doc_id long, text string")
    got = lm.scored(docs, lm.train(docs.limit(0).select("text"))).collect()
    assert sorted(r.n_tokens for r in got) == [1, 1, 1, 1, 50_001] and all(r.n_known == 0 == r.train_tokens for r in got)
    trained = lm.scored(docs, lm.train(docs.select("text"))).collect()
    assert all(r.n_known == r.n_tokens and r.train_tokens == 50_005 for r in trained)
    assert lm.scored(docs.limit(0), lm.train(docs.select("text"))).collect() == []


@pytest.mark.parametrize("room", [{"HOT": 8, "HOT_PAIRS": 8, "LATE_TOKENS": 3_000}, {}])
def test_scores_do_not_depend_on_the_room_of_the_filter(spark, sf_dir, monkeypatch, room):
    """Rare n-grams are read from their ranges when the filter is too large to be sent."""
    want = {r.doc_id: r for r in QUERIES["op5_language_model"](spark, sf_dir).collect()}
    monkeypatch.setattr(lm, "MAX_BITS", 20_000)
    for name, value in room.items():
        monkeypatch.setattr(lm, name, value)
    got = {r.doc_id: r for r in QUERIES["op5_language_model"](spark, sf_dir).collect()}
    assert got.keys() == want.keys()
    for i, r in got.items():
        assert r.score == pytest.approx(want[i].score, rel=1e-9)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (want[i].n_tokens, want[i].n_known, want[i].train_tokens)


@pytest.mark.parametrize("n", [1, lm.APART - 1, lm.APART, 5000])
def test_packed_columns(n):
    rng = np.random.default_rng(4)
    columns = [rng.integers(0, 1 << 40, n, dtype=np.uint64), np.arange(n), rng.integers(0, 400, n).astype(np.int16)]
    first, got = lm.unpack(lm.pack(3 << 40, columns, (5, 4, 2)), (5, 4, 2))
    assert first == 3 << 40 and all(np.array_equal(a.astype(np.uint64), b) for a, b in zip(columns, got))


def test_the_coarse_filter_loses_no_pair():
    rng = np.random.default_rng(3)
    hashes = np.unique(lm.kept_bits(rng.integers(0, 2**64, 5000, dtype=np.uint64), 4, lm.PAIR_BYTES))
    place = (hashes >> np.uint64(60)).astype(int)
    rows = []
    for i in range(15):  # the last range has no pairs
        size, bits = lm.shard(hashes[place == i], np.full((place == i).sum(), 2), 2)
        rows.append({"range": i, "size": size, "bits": bits, "coarse": lm.folded(bits, 2)})
    whole, coarse = lm.Filter.of(rows, 4, lm.PAIR_BYTES, 2), lm.Coarse.of(rows, 4, 2)
    other = lm.kept_bits(rng.integers(0, 2**64, 100_000, dtype=np.uint64), 4, lm.PAIR_BYTES)
    for some in (hashes, other):
        assert not (~coarse.holds(some, 4) & (whole.level(some) > 0)).any()
    assert coarse.holds(other, 4).mean() < 0.1 and coarse.bits.nbytes < 0.6 * whole.bits.nbytes


@pytest.mark.parametrize("fold", [0, 8])
def test_late_pairs_take_few_bytes(spark, monkeypatch, fold):
    """A pair that has to be asked for is one packed entry of the range's block, and nothing waits beside it."""
    rng = np.random.default_rng(6)
    made = [" ".join(f"w{x}" for x in rng.integers(0, 300, 1600)) for _ in range(100)]
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").coalesce(1)
    want = {r.doc_id: r.score for r in lm.scored(docs, lm.train(docs.select("text"))).collect()}
    monkeypatch.setattr(lm, "MAX_BITS", 250_000)
    monkeypatch.setattr(lm, "FOLD", fold)
    monkeypatch.setattr(lm, "HOT_PAIRS", 8)
    kept = []
    monkeypatch.setattr(lm, "stored", lambda df, label, store=lm.stored: kept.append((label, store(df, label))) or kept[-1][1])
    model = lm.train(docs.select("text"))
    assert isinstance(model.words, lm.Filter) and isinstance(model.pairs, lm.Hot) and bool(model.pairs.coarse) == (fold > 0)
    assert {r.doc_id: pytest.approx(r.score, rel=1e-9) for r in lm.scored(docs, model).collect()} == want
    sent = dict(kept)["lm-scored"].where("_kind is not null").selectExpr("_kind", "octet_length(_block) as n").collect()
    assert {r["_kind"] for r in sent} == {lm.PLACED}
    assert sum(r.n for r in sent) < 9 * 160_100
