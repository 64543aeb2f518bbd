"""Byte-level BPE encoding and decoding with a segment tree over the ranks of adjacent pairs.

Each pretoken starts as its bytes.  The leaves of a binary tree hold the rank of the pair that begins at each position
(or "none"), an inner node holds the smaller rank of its children, so the root holds the lowest rank of the pretoken;
going down and preferring the left child on ties finds its leftmost place.  A merge changes three leaves, each updated
with one walk to the root.  The trees of many pretokens of about the same length are rows of one array, so one step
merges once in each of them.

Defined results: a null text is the empty text and has no tokens; special tokens of the vocabulary in a text become
their ids; decoding bytes that are not UTF-8 gives replacement characters; null ids decode to the empty text.  Other
columns are kept, also those named like an internal value; an output column replaces an input column of its name.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

NONE = np.int32(2**31 - 1)
CELLS = 1 << 17  # tree leaves that are worked on at once
CHUNK_CHARS = 1 << 19  # text whose pretokens are held at once
CACHE_WORDS = 200_000  # pretokens whose ids a worker remembers; more only cost time


def byte_characters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    kept = set(shown)
    return [chr(b) if b in kept else chr(next(rest)) for b in range(256)]


def byte_vocabulary(name: str = "byte_bpe_50k.json") -> Vocabulary:
    """A vocabulary of the public tokenizers."""
    import public_tokenizers

    return Vocabulary.load(public_tokenizers.path(name), public_tokenizers.PATTERN)


@dataclass
class Vocabulary:
    """Tables of a byte-level BPE vocabulary; their size is that of the vocabulary file."""

    pattern: str
    byte_ids: np.ndarray  # id of each byte
    keys: np.ndarray  # left id * 2^32 + right id, sorted
    ranks: np.ndarray  # rank of each key
    merged: np.ndarray  # id that each rank makes
    special: dict[str, int]
    token_starts: np.ndarray
    token_bytes: np.ndarray  # bytes of all tokens, one after the other

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, chars = spec["model"]["vocab"], byte_characters()
        pairs = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        order = np.argsort(keys, kind="stable")
        special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        of_char = {c: b for b, c in enumerate(chars)}
        tokens = {i: bytes(of_char[c] for c in t) for t, i in vocab.items()}
        tokens |= {i: t.encode() for t, i in special.items()}
        listed = [tokens.get(i, b"") for i in range(max(tokens) + 1)]
        return cls(
            pattern,
            np.array([vocab[c] for c in chars], dtype=np.int32),
            keys[order],
            order.astype(np.int32),
            np.array([vocab[a + b] for a, b in pairs], dtype=np.int32),
            special,
            np.cumsum([0, *map(len, listed)]),
            np.frombuffer(b"".join(listed), dtype=np.uint8),
        )

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of ids, NONE where they do not merge or an id is below 0."""
        key = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)


def merge_rows(vocabulary: Vocabulary, symbols: np.ndarray) -> np.ndarray:
    """Merge each row to the end.

    ``symbols`` holds ids, -1 after the end of a row; its width is a power of two.  Returns ids with -1 in the places
    that were merged away or lie after the end.
    """
    n, width = symbols.shape
    ids = np.full((n, width + 1), -1, dtype=np.int32)  # the last column stands for "no neighbour" on either side
    ids[:, :width] = symbols
    after = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))
    after[:, width] = width
    before = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1))
    before[:, 0] = width
    tree = np.full((n, 2 * width), NONE, dtype=np.int32)
    tree[:, width:] = vocabulary.rank(ids[:, :width], ids[:, 1:])
    level = width
    while level > 1:
        tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level //= 2

    def put(rows: np.ndarray, places: np.ndarray, ranks: np.ndarray) -> None:
        node = places + width
        tree[rows, node] = ranks
        while node[0] > 1:  # all nodes are on the same level
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    rows = np.arange(n)
    while (rows := rows[tree[rows, 1] != NONE]).size:
        root, node = tree[rows, 1], np.ones(rows.size, dtype=np.int64)
        while node[0] < width:
            node = 2 * node + (tree[rows, 2 * node] != root)
        at = node - width
        gone = after[rows, at]
        ids[rows, at] = vocabulary.merged[root]
        ids[rows, gone] = -1
        after[rows, at] = following = after[rows, gone]
        before[rows, following] = at
        put(rows, gone.astype(np.int64), np.full(rows.size, NONE))
        put(rows, at, vocabulary.rank(ids[rows, at], ids[rows, following]))
        left = before[rows, at].astype(np.int64)
        if (has := left < width).any():
            there, place = rows[has], left[has]
            put(there, place, vocabulary.rank(ids[there, place], ids[there, at[has]]))
    return ids[:, :width]


def ragged(starts: np.ndarray, counts: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The runs values[start : start + count], one after the other."""
    ends = np.cumsum(counts)
    if not ends.size or not ends[-1]:
        return values[:0]
    return values[np.repeat(starts - ends + counts, counts) + np.arange(ends[-1])]


class Encoder:
    """Encodes texts; remembers the ids of the pretokens it has met."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.find = regex.compile(vocabulary.pattern).findall
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts = np.zeros(1024, dtype=np.int64)
        self.counts = np.zeros(1024, dtype=np.int64)
        self.ids = np.zeros(4096, dtype=np.int32)
        self.used = 0

    def _append(self, words: list[str], counts: np.ndarray, ids: np.ndarray) -> None:
        first = len(self.index)
        while len(self.starts) < first + len(words):
            self.starts, self.counts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.counts))
        while len(self.ids) < self.used + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.starts[first : first + len(words)] = self.used + np.cumsum(counts) - counts
        self.counts[first : first + len(words)] = counts
        self.ids[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.index.update(zip(words, range(first, first + len(words))))

    def learn(self, words: list[str]) -> None:
        """Encode pretokens that are not known yet, those of a length class together."""
        classes: dict[int, list[str]] = {}
        for word in words:
            classes.setdefault(max(1, (len(word.encode()) - 1).bit_length()), []).append(word)
        for bits, group in classes.items():
            width, step = 1 << bits, max(1, CELLS >> bits)
            for i in range(0, len(group), step):
                some = group[i : i + step]
                coded = [w.encode() for w in some]
                lengths = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded))
                symbols = np.full((len(coded), width), -1, dtype=np.int32)
                symbols[np.arange(width) < lengths[:, None]] = self.vocabulary.byte_ids[
                    np.frombuffer(b"".join(coded), dtype=np.uint8)
                ]
                out = merge_rows(self.vocabulary, symbols)
                here = out >= 0
                self._append(some, here.sum(axis=1), out[here])

    def pretokens(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return self.find(text)
        parts = self.special.split(text)
        return list(chain.from_iterable([p] if i % 2 else self.find(p) for i, p in enumerate(parts)))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each text, and all ids."""
        if len(self.index) > CACHE_WORDS:
            self.clear()
        if not self.index and self.vocabulary.special:
            special = self.vocabulary.special
            self._append(list(special), np.ones(len(special), dtype=np.int64), np.array(list(special.values())))
        split = [self.pretokens(t) for t in texts]
        self.learn([w for w in set(chain.from_iterable(split)) if w not in self.index])
        sizes = list(map(len, split))
        flat = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), dtype=np.int64, count=sum(sizes))
        counts = self.counts[flat]
        ends = np.concatenate([[0], np.cumsum(counts)])[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])]
        return np.diff(ends), ragged(self.starts[flat], counts, self.ids)


def decode(vocabulary: Vocabulary, counts: np.ndarray, ids: np.ndarray) -> list[str]:
    """The text of each run of ids."""
    if ids.size and (ids.min() < 0 or ids.max() >= len(vocabulary.token_starts) - 1):
        raise ValueError("an id is not in the vocabulary")
    lengths = np.diff(vocabulary.token_starts)[ids]
    raw = ragged(vocabulary.token_starts[ids], lengths, vocabulary.token_bytes).tobytes()
    ends = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])]
    return [raw[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


def _slices(batch: pa.RecordBatch, sizes: np.ndarray, limit: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of about ``limit`` size each, one row at least."""
    start, sum_ = 0, 0
    for i, size in enumerate(sizes.tolist()):
        sum_ += size
        if sum_ >= limit:
            yield batch.slice(start, i + 1 - start)
            start, sum_ = i + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def _with(batch: pa.RecordBatch, added: dict[str, pa.Array], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([added[n] if n in added else batch.column(n) for n in names], names)


_LATEST: list[Encoder] = []


def _encoder(vocabulary: Vocabulary) -> Encoder:
    """The encoder of this worker, which keeps it from one task to the next."""
    if not _LATEST or _LATEST[0].vocabulary is not vocabulary:
        _LATEST[:] = [Encoder(vocabulary)]
    return _LATEST[0]


def _schema(df: DataFrame, added: list[T.StructField]) -> T.StructType:
    new = {f.name for f in added}
    return T.StructType([f for f in df.schema.fields if f.name not in new] + added)


def encode_column(
    df: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", decoded: str | None = None
) -> DataFrame:
    """Add the ids of a text column, and, on request, the text that decoding these ids gives back."""
    added = [T.StructField(ids, T.ArrayType(T.IntegerType()))]
    if decoded:
        added.append(T.StructField(decoded, T.StringType()))
    schema = _schema(df, added)
    names = schema.names
    held = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
            for part in _slices(batch, sizes, CHUNK_CHARS):
                counts, flat = encoder.encode([x or "" for x in part.column(text).to_pylist()])
                offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
                new = {ids: pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))}
                if decoded:
                    new[decoded] = pa.array(decode(encoder.vocabulary, counts, flat), pa.string())
                yield _with(part, new, names)

    return df.mapInArrow(run, schema)


def decode_column(df: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add the text that a column of ids stands for."""
    schema = _schema(df, [T.StructField(text, T.StringType())])
    names = schema.names
    held = df.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = [np.array(x or [], dtype=np.int64) for x in batch.column(ids).to_pylist()]
            flat = np.concatenate([np.zeros(0, dtype=np.int64), *lists])
            texts = decode(held.value, np.array([len(x) for x in lists], dtype=np.int64), flat)
            yield _with(batch, {text: pa.array(texts, pa.string())}, names)

    return df.mapInArrow(run, schema)
