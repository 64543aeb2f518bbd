"""Alignment of two tokenizers against a brute-force version of the contract."""

import hashlib
import random
import re
from bisect import bisect_left
from collections import Counter
from types import SimpleNamespace

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from tokenizers import Tokenizer

from conftest import rows
from treeledger.llm import alignment
from treeledger.llm.queries import QUERIES

A, B = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")


def token_bytes():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {chr(c): c for c in printable}
    extra = iter(range(256, 512))
    for c in range(256):
        if c not in printable:
            shown[chr(next(extra))] = c

    def a_of(i):
        return bytes(shown[c] for c in a.id_to_token(i))

    def b_of(i):
        p = b.id_to_piece(i)
        m = re.fullmatch("<0x(..)>", p)
        return bytes([int(m[1], 16)]) if m else p.replace("▁", " ").encode()

    return a, b, a_of, b_of


def brute(docs):
    a, b, a_of, b_of = token_bytes()
    per = []
    links = Counter()
    for doc_id, text in docs:
        if not text:
            per.append((doc_id, 0, 0, 0, [], ""))
            continue
        ai, bi = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ab, bb = [a_of(i) for i in ai], [b_of(i) for i in bi]
        whole = (" " + text).encode()
        if b"".join(ab) != whole or b"".join(bb) != whole:
            per.append((doc_id, 0, 0, 0, [], ""))
            continue
        ae = [sum(len(x) for x in ab[: k + 1]) for k in range(len(ab))]
        be = [sum(len(x) for x in bb[: k + 1]) for k in range(len(bb))]
        cuts = sorted(set(ae) & set(be))
        ga = [bisect_left(cuts, e) for e in ae]
        gb = [bisect_left(cuts, e) for e in be]
        mine = [(x, y) for p, x in zip(ga, ai) for q, y in zip(gb, bi) if p == q]
        links.update(mine)
        text_groups = ";".join(
            ",".join(str(x) for g, x in zip(ga, ai) if g == k) + "|" + ",".join(str(y) for g, y in zip(gb, bi) if g == k)
            for k in range(len(cuts))
        )
        per.append((doc_id, len(ai), len(bi), len(cuts), mine, hashlib.sha256(text_groups.encode()).hexdigest()))
    top = Counter()
    for (x, y), c in links.items():
        top[y] = max(top[y], c)
    return sorted(
        (
            (d, na, nb, ng, len(m), sum(links[p] == top[p[1]] for p in m), sum(links[p] for p in m), h)
            for d, na, nb, ng, m, h in per
        ),
        key=repr,
    )


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
TEXTS = [
    (1, "Hello world, hello world."), (2, None), (3, ""), (4, "special <|endoftext|> and <s> </s> stay text"),
    (5, "ñandú Straße 東京 😀 tabs\tand\nlines  two spaces"), (6, "Hello world, hello world."), (None, "no id here"),
    (7, "word " * 5000), (8, "\x00\x01 control"), (1, "Hello world, hello world."),
]


@pytest.mark.parametrize("a_file", [A, P.path("byte_bpe_50k.tiktoken")])
def test_matches_brute_force(spark, a_file):
    """With the vocabulary read by the tokenizers library and as tiktoken ranks."""
    docs = spark.createDataFrame([(*t, 0, "x") for t in TEXTS], "doc_id long, text string, rid long, pairs string")
    got = rows(alignment.alignment(docs, a_file, B), *COLUMNS)
    assert got == brute(TEXTS)
    assert any(r[4] > r[3] for r in got)  # groups with more than one pair


def test_query_on_whole_table(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = rows(QUERIES["op13_alignment"](spark, sf_dir), *COLUMNS)
    assert got == brute(docs)


def test_groups_cut_where_both_end():
    a, b, a_of, b_of = token_bytes()
    tools = alignment._tokenizers(A, B)
    a_bytes, b_bytes = tools.a_bytes, tools.b_bytes
    text = "internationalization of tokenizers"
    ai, bi = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    groups = alignment.align(ai, bi, a_bytes, b_bytes)
    assert [x for g in groups for x in g[0]] == ai and [y for g in groups for y in g[1]] == bi
    for ga, gb in groups:
        assert b"".join(a_of(i) for i in ga) == b"".join(b_of(i) for i in gb)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.alignment(docs, A, B).count() == 0


def test_large_ids_beside_a_null_id(spark):
    """Ids that no float can hold stay as they are in a batch with a null id."""
    ids = [None, 2**53 + 1, 2**53 + 3, -(2**53) - 5, 2**63 - 1, -(2**63), 7]
    docs = [(i, f"row {k} Hello world") for k, i in enumerate(ids)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    assert rows(alignment.alignment(df, A, B), *COLUMNS) == brute(docs)


@pytest.mark.parametrize("text", ["a" + " " * 1_200_000 + "b", "\n" * 1_100_000])
def test_very_long_white_space(text):
    """tiktoken's pattern engine stops at such runs."""
    a, _, a_of, _ = token_bytes()
    tools = alignment._tokenizers(P.path("byte_bpe_50k.tiktoken"), B)
    assert tools.encode_a(" " + text) == a.encode(" " + text, add_special_tokens=False).ids


def test_chunks_give_what_whole_texts_give():
    """Also beside runs of white space, other spaces, contractions, marks and pieces of the special tokens."""
    tools = alignment._tokenizers(P.path("byte_bpe_50k.tiktoken"), B)
    assert tools.chunks is not None
    draw = random.Random(5)
    parts = [" ", " ", "  ", "\n", "\t", "a", "the", "'s", "'ll", "1", "é", "東", "😀", "▁", "\u00a0", "\u3000", "\x1c", "\x85", "\x00",
             "ing", "<s>", "<|endoftext|>", ".", "\u0308", "_"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 40))) for _ in range(2000)] + ["it's a test " * 50, None]
    for again in range(2):  # learned, then remembered
        for text, got in zip(texts, alignment.described(texts, tools), strict=True):
            want = alignment.describe(text, tools)
            assert got[:5] == want[:5] and np.array_equal(got[5], want[5]), text
    encoded = []
    tools.chunks.forget()
    tools.b, kept = SimpleNamespace(encode=lambda x, **kw: encoded.append(x) or kept.encode(x, **kw)), tools.b
    try:
        alignment.described(["one two one two one"] * 5, tools)
    finally:
        tools.b = kept
    assert encoded == [["one", "two"]]


@pytest.mark.parametrize("room", [0, 40])
def test_pairs_that_are_not_sent_are_joined(spark, monkeypatch, room):
    monkeypatch.setattr(alignment, "HOT_PAIRS", room)
    monkeypatch.setattr(alignment, "CHUNKS", 3)
    docs = spark.createDataFrame(TEXTS, "doc_id long, text string")
    assert rows(alignment.alignment(docs, P.path("byte_bpe_50k.tiktoken"), B), *COLUMNS) == brute(TEXTS)
