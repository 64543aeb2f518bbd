"""BPE and token counts against the tokenizers library."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from treeledger.llm import bpe, token_counts

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
VOCABULARY = bpe.byte_vocabulary()
ENCODER = bpe.Encoder(VOCABULARY)
ODD = ["", " ", "<|endoftext|>", "a<|endoftext|> it's\r\n\t  x", "ß" * 3000, " " * 500 + "x", "x\x85y\x1c\x00z", "퟿漢😀 é"]


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_any_text(text):
    counts, ids = ENCODER.encode([text])
    assert ids.tolist() == ids_of(text)
    assert bpe.decode(VOCABULARY, counts, ids) == [text]


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text):
    counts, ids = ENCODER.encode([text, "after"])
    assert ids[: counts[0]].tolist() == ids_of(text)
    assert bpe.decode(VOCABULARY, counts, ids)[0] == text


def test_all_characters_and_one_long_word():
    for text in ("".join(chr(c) for c in range(0x3000) if not 0xD800 <= c < 0xE000), "ab" * 40_000):
        assert ENCODER.encode([text])[1].tolist() == ids_of(text)


def test_forgetting_pretokens_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 3)
    encoder = bpe.Encoder(VOCABULARY)
    for text in ("one two three four five", "six one<|endoftext|>two", "one two"):
        assert encoder.encode([text])[1].tolist() == ids_of(text)


def test_decoding_parts_of_characters():
    ids = ids_of("漢字")[:1]
    counts = np.array([1])
    assert bpe.decode(VOCABULARY, counts, np.array(ids)) == [LIBRARY.decode(ids, skip_special_tokens=False)]
    with pytest.raises(ValueError):
        bpe.decode(VOCABULARY, counts, np.array([10**6]))


def test_query(spark, sf_dir):
    from treeledger.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = set()
    for d in docs:
        ids = ids_of(d.text or "")
        text = LIBRARY.decode(ids, skip_special_tokens=False)
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text)]
        want.add((d.doc_id, len(ids), *digests))
    assert {tuple(r) for r in QUERIES["op7_bpe"](spark, sf_dir).collect()} == want


def test_columns_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, None, "x"), (2, "", None), (3, "hi there", "y")], "ids int, text string, _row string")
    got = bpe.encode_column(df, VOCABULARY, ids="ids", decoded="again").collect()
    assert sorted((tuple(r.ids), r["_row"], r.again) for r in got if r["_row"]) == sorted(
        [((), "x", ""), ((), "x", ""), (tuple(ids_of("hi there")), "y", "hi there")]
    )
    back = bpe.decode_column(bpe.encode_column(df, VOCABULARY), VOCABULARY).collect()
    assert sorted(r.decoded for r in back) == ["", "", "", "hi there"]
    assert bpe.encode_column(df.limit(0), VOCABULARY).collect() == []


def counts_by_hand(text, spans):
    """Token by token, character by character."""
    widths = np.diff(VOCABULARY.token_starts)
    place = [len(text[:i].encode()) for i in range(len(text) + 1)]
    sections = [(place[min(a, len(text))], place[min(b, len(text))]) for a, b in spans]
    out, at = [[0, 0, 0.0] for _ in sections], 0
    for token in ids_of(text):
        end = at + widths[token]
        held = [max(0, min(end, b) - max(at, a)) for a, b in sections]
        for k, (a, b) in enumerate(sections):
            out[k][0] += a <= at < b
            out[k][2] += held[k] / (end - at)
        if max(held, default=0) > 0:
            out[max(range(len(sections)), key=lambda k: (held[k], -k))][1] += 1
        at = end
    return out


@settings(max_examples=100, deadline=None)
@given(st.text("ab é漢 \n,Hello😀", max_size=50), st.lists(st.integers(0, 55), max_size=8))
def test_attribution(text, cuts):
    cuts = sorted(set(cuts))
    spans = list(zip(cuts, cuts[1:]))[::2] + list(zip(cuts, cuts[1:]))[1::2]
    spans.sort()
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    place = np.append(np.flatnonzero((data & 0xC0) != 0x80), data.size)
    given_ = np.array(spans, dtype=np.int64).reshape(-1, 2)
    first, last = place[np.clip(given_[:, 0], 0, len(text))], place[np.clip(given_[:, 1], 0, len(text))]
    ends = np.concatenate([[0], np.cumsum(np.diff(VOCABULARY.token_starts)[ids_of(text)])]).astype(np.int64)
    got = list(zip(*token_counts.attribute(ends, first, last)))
    want = counts_by_hand(text, spans)
    assert [tuple(g[:2]) for g in got] == [tuple(w[:2]) for w in want]
    assert np.allclose([g[2] for g in got], [w[2] for w in want])


def test_sections_from_a_column_and_from_lines(spark):
    df = spark.createDataFrame(
        [(1, "one two\nthree", [(0, 5), (5, 13)], "s"), (2, None, [(0, 4)], "t"), (3, "", None, "u")],
        "id int, text string, spans array<struct<a:int,b:int>>, sections string",
    )
    got = {r.id: r for r in token_counts.with_token_counts(df, VOCABULARY, sections="spans", counts="got").collect()}
    assert [tuple(x)[3:5] for x in got[1].got] == [tuple(w[:2]) for w in counts_by_hand("one two\nthree", [(0, 5), (5, 13)])]
    assert [tuple(x) for x in got[2].got] == [(0, 0, 4, 0, 0, 0.0)] and got[3].got == [] and got[3].sections == "u"
    lines = token_counts.with_token_counts(df, VOCABULARY).where("id = 1").first().sections
    assert [(x.start, x.stop) for x in lines] == [(0, 8), (8, 13)]
    assert sum(x.by_largest for x in lines) == len(ids_of("one two\nthree"))


def test_every_rule_gives_out_every_token(spark, sf_dir):
    from treeledger.llm.queries import QUERIES

    got = QUERIES["op2_token_counts"](spark, sf_dir).groupBy().sum("by_start", "by_largest", "by_share").first()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()
    assert got[0] == got[1] == round(got[2], 3) == sum(len(ids_of(d.text or "")) for d in docs)
