"""Language-model scores from a log-frequency Bloom filter.

The filter holds, for every word and every word pair that the training texts have at least ``PAIR_COUNT`` times, the
level of its count on a scale that is exact for small counts and geometric above: an n-gram is entered once for each
level up to its own, at ``BITS`` bits each, so the filter grows with the corpus and the rate of false positives (about 0.5
percent) is the same for every corpus.  Its count is read back by probing level after level until one is missing.  The
smoothed probability of a word after another is

    LAMBDA * pairs / before + (1 - LAMBDA) * (count + 1) / (N + V + 1)

with counts rounded down in the numerators and up in the denominator, so that, false positives apart, the probabilities
of all known words sum to at most one.  A text is its words, lower-cased in A-Z, and one end.

Training counts go through one shuffle in packed form: a task sorts and counts the hashes of its own batch and sends
each range of hashes as one block of bytes.  The number of ranges follows the corpus, so a range stays small, and the filter is cut
by the same ranges.

A filter of words or of pairs that ``MAX_BITS`` has room for is sent to every worker.  A larger one stays a table with a
row for each range, and workers get what it reads for its most frequent n-grams (``HOT`` words or ``HOT_PAIRS`` pairs at
most).  For pairs they also get a coarse form of the filter, in which a bit stands for up to ``FOLD`` neighbouring ones,
while ``MAX_BITS`` has room for that: a pair whose coarse bits are not all set is not in the filter.  Any other pair goes
to its range together with its document and the levels of its two words, packed for ``LATE_TOKENS`` tokens at once; the
text is scored as if the pair was missing, and the ranges answer with the pairs that they do hold, which correct the
scores of their documents.  Only where a word itself is open does a task ask the ranges, each different n-gram once for
``LATE_TOKENS`` tokens that wait for it, and the waiting tokens are scored when the answers have come back to them.  All
ways read the same filter, so the scores do not depend on the room.

The base model needs exact counts of all words.  The ``HOT`` most frequent words at most are sent to all tasks; the
occurrences of all others, summed for each document, are joined with the table of words.

Defined results: null and empty texts have the end as their only token; without training texts every count is 0; rows
are scored one by one, whatever their ids; other columns are not used.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from treeledger.llm.common import stored
from treeledger.llm.hashing import mix, seeds, slices, word_hashes

LAMBDA = 0.1
PAIR_COUNT = 2
STEP = 1.1  # of the geometric part of the scale
BITS, PROBES = 12, 5
MAX_BITS = 1 << 28
FOLD = 4
HOT = 1 << 20
HOT_PAIRS = 1 << 22
LATE_TOKENS = 500_000  # tokens that wait for answers together
RANGE_TOKENS = 1 << 20  # tokens a range of hashes is meant for
CHUNK_BYTES = 1 << 20
COUNT_TOKENS = 2_000_000  # tokens that a task counts at once
WORD_BYTES, PAIR_BYTES = 8, 5  # bytes of a hash that are kept, behind those that name the range

BEGIN, END, PAIR, LEVEL, SECOND = (seeds(1, 1001 + i)[0] for i in range(5))


def levels(least: int) -> np.ndarray:
    """Counts at which a level begins, from ``least`` up."""
    out = [least]
    while out[-1] < 1 << 50:
        out.append(max(out[-1] + 1, int(out[-1] * STEP)))
    return np.array(out, dtype=np.int64)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, of the token before each, and the number of tokens of each text."""
    words, counts = word_hashes(texts)
    counts = counts + 1
    ends = np.cumsum(counts)
    out = np.full(int(ends[-1]), END, dtype=np.uint64)
    inside = np.ones(len(out), dtype=bool)
    inside[ends - 1] = False
    out[inside] = words
    before = np.concatenate([[BEGIN], out[:-1]])
    before[ends[:-1]] = BEGIN
    return out, before, counts


def pair_hashes(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    return mix(before * PAIR + after)


def kept_bits(hashes: np.ndarray, range_bits: int, width: int) -> np.ndarray:
    """The part of a hash that names an n-gram: the bits of its range and ``width`` bytes."""
    drop = 64 - range_bits - 8 * width
    return hashes if drop <= 0 else hashes >> np.uint64(drop) << np.uint64(drop)


def _cut(hashes: np.ndarray, range_bits: int, width: int) -> np.ndarray:
    """The ``width`` bytes of each hash behind its range, or all 8."""
    short = (hashes << np.uint64(range_bits)) if width < 8 else hashes
    return short.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :width]


def _uncut(block: bytes, place: int, range_bits: int, width: int) -> np.ndarray:
    raw = np.zeros((len(block) // width, 8), dtype=np.uint8)
    raw[:, :width] = np.frombuffer(block, dtype=np.uint8).reshape(-1, width)
    short = raw.view(">u8").ravel().astype(np.uint64)
    return short >> np.uint64(range_bits) | np.uint64(place << (64 - range_bits)) if width < 8 else short


def packed(hashes: np.ndarray, counts: np.ndarray, range_bits: int, width: int) -> Iterator[tuple[int, bytes]]:
    """Blocks by range of sorted different hashes: those counted once, then the others with their counts."""
    places = np.arange((1 << range_bits) + 1, dtype=object) << (64 - range_bits)
    limits = np.searchsorted(hashes, np.array(places[1:-1], dtype=np.uint64))
    limits = np.concatenate([[0], limits, [len(hashes)]])
    raw = _cut(hashes, range_bits, width)
    for i in range(1 << range_bits):
        a, b = limits[i], limits[i + 1]
        if a < b:
            many = counts[a:b] > 1
            head = np.array([b - a - many.sum(), many.sum()], dtype="<u4").tobytes()
            body = raw[a:b][~many].tobytes() + raw[a:b][many].tobytes()
            yield i, head + body + counts[a:b][many].astype("<u4").tobytes()


def unpacked(place: int, blocks: list[bytes], range_bits: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Different hashes of a range in order, and their summed counts."""
    hashes, counts = [], []
    for block in blocks:
        once, many = np.frombuffer(block, dtype="<u4", count=2)
        n = int(once) + int(many)
        raw = np.zeros((n, 8), dtype=np.uint8)
        raw[:, :width] = np.frombuffer(block, dtype=np.uint8, count=n * width, offset=8).reshape(n, width)
        hashes.append(raw.view(">u8").ravel().astype(np.uint64))
        counts.append(np.concatenate([np.ones(once, dtype=np.int64), np.frombuffer(block, dtype="<u4", offset=8 + n * width)]))
    if not hashes:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    flat, weight = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(flat, kind="stable")
    flat, weight = flat[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    flat, weight = flat[first], np.add.reduceat(weight, first)
    if width < 8:
        flat = flat >> np.uint64(range_bits) | np.uint64(place << (64 - range_bits))
    return flat, weight


def _chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[bytes]]]:
    texts = batch.column(column).cast(pa.binary())
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(lengths, CHUNK_BYTES):
        yield a, b, [x or b"" for x in texts.slice(a, b - a).to_pylist()]


BLOCKS = T.StructType([T.StructField("range", T.IntegerType()), T.StructField("block", T.BinaryType())])
COUNTS = T.StructType([T.StructField("hash", T.LongType()), T.StructField("n", T.LongType())])
HELD = [T.StructField(n, T.BinaryType()) for n in ("hot_hashes", "hot_levels", "coarse")]
MERGED = T.StructType(
    [
        T.StructField("range", T.IntegerType()),
        T.StructField("hashes", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
        T.StructField("sizes", T.ArrayType(T.LongType())),
    ]
)
SHARDS = T.StructType(
    [
        T.StructField("range", T.IntegerType()),
        T.StructField("size", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        *HELD,
    ]
)


def counted_blocks(texts: DataFrame, range_bits: int, pairs: bool) -> DataFrame:
    """Packed counts of the words or word pairs of a column of texts, by range."""
    width = PAIR_BYTES if pairs else WORD_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def send() -> Iterator[pa.RecordBatch]:
            hashes, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            for place, block in packed(hashes, counts, range_bits, width):
                yield pa.RecordBatch.from_arrays([pa.array([place], pa.int32()), pa.array([block])], BLOCKS.names)

        for batch in batches:
            for _, _, chunk in _chunks(batch, 0):
                after, before, _ = tokens(chunk)
                held.append(kept_bits(pair_hashes(before, after), range_bits, width) if pairs else after)
                if sum(map(len, held)) >= COUNT_TOKENS:
                    yield from send()
        if held:
            yield from send()

    return texts.mapInArrow(run, BLOCKS)


def words_of_blocks(blocks: DataFrame, range_bits: int) -> DataFrame:
    """Words and counts, a row each."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = unpacked(int(key[0]), list(rows["block"]), range_bits, WORD_BYTES)
        return pd.DataFrame({"hash": hashes.astype(np.int64), "n": counts})

    return blocks.groupBy("range").applyInPandas(run, COUNTS)


def _entry(hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the probes of an entry begin and how far apart they are, before they are cut to the size of the range."""
    key = mix(hashes ^ np.uint64(level * int(LEVEL) % 2**64))
    return key, mix(key ^ SECOND) | np.uint64(1)


def shard(hashes: np.ndarray, counts: np.ndarray, least: int) -> tuple[int, bytes]:
    """Size and bits of the filter of one range."""
    scale = levels(least)
    keep = counts >= least
    hashes, top = hashes[keep], np.searchsorted(scale, counts[keep], side="right")
    size = max(64, BITS * int(top.sum()))
    bits = np.zeros((size + 7) // 8 * 8, dtype=bool)
    for level in range(int(top.max(initial=0))):
        key, apart = _entry(hashes[top > level], level)
        for _ in range(PROBES):
            bits[key % np.uint64(size)] = True
            key += apart
    return size, np.packbits(bits).tobytes()


def size_class(counts: np.ndarray) -> np.ndarray:
    """Classes of counts, eight to each doubling."""
    return np.floor(8 * np.log2(counts)).astype(np.int64)


def least_count(sizes: dict[int, int], least: int) -> int:
    """The least count from which all n-grams fit; ``sizes`` has the number of n-grams of each size class."""
    for count in levels(least):
        if filter_bits(sizes, int(count)) <= MAX_BITS:
            return int(count)
    raise AssertionError("no n-gram is that frequent")


def filter_bits(sizes: dict[int, int], least: int) -> int:
    """Bits of a filter of the n-grams from ``least`` on, at most."""
    classes = np.array(sorted(sizes), dtype=np.int64)
    n = np.array([sizes[c] for c in classes], dtype=np.int64)
    greatest = np.floor(2 ** ((classes + 1) / 8)).astype(np.int64)  # of a class
    held = greatest >= least
    return int(BITS * (n[held] * np.searchsorted(levels(least), greatest[held], side="right")).sum())


def folded(bits: bytes, fold: int) -> bytes:
    """Bits of which each says whether one of ``fold`` neighbours is set; none without ``fold``."""
    if not fold:
        return b""
    return np.packbits(np.unpackbits(np.frombuffer(bits, dtype=np.uint8)).reshape(-1, fold).any(axis=1)).tobytes()


def merged_blocks(blocks: DataFrame, range_bits: int, width: int, least: int) -> DataFrame:
    """For each range the n-grams that occur ``least`` times or more, and the sizes of their counts."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = unpacked(int(key[0]), list(rows["block"]), range_bits, width)
        keep = counts >= least
        sizes = np.bincount(size_class(counts[keep])) if keep.any() else np.zeros(0, dtype=np.int64)
        made = {"range": [key[0]], "hashes": [hashes[keep].tobytes()], "counts": [counts[keep].tobytes()], "sizes": [sizes]}
        return pd.DataFrame(made)

    return blocks.groupBy("range").applyInPandas(run, MERGED)


def hot_class(sizes: dict[int, int], room: int) -> int:
    """The least size class from which no more than ``room`` n-grams are left."""
    least = max(sizes, default=0) + 1
    for b in sorted(sizes, reverse=True):
        room -= sizes[b]
        if room < 0:
            break
        least = b
    return least


def _range_row(
    place: int, hashes: np.ndarray, counts: np.ndarray, range_bits: int, width: int, least: int, hot: int, fold: int = 0
) -> tuple:
    """The filter of one range, what it reads for the n-grams from size class ``hot`` on, and its coarse form."""
    size, bits = shard(hashes, counts, least)
    often = np.sort(hashes[size_class(counts) >= hot])
    read = Filter.of_range(place, size, bits, range_bits, width, least).level(often)
    return int(place), size, bits, often.tobytes(), read.astype(np.int16).tobytes(), folded(bits, fold)


def shards_of_merged(merged: DataFrame, range_bits: int, least: int, hot: int, fold: int = 0) -> DataFrame:
    """The filter of each range of merged n-grams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                place, hashes, counts = (batch.column(i)[row].as_py() for i in range(3))
                hashes, counts = np.frombuffer(hashes, dtype=np.uint64), np.frombuffer(counts, dtype=np.int64)
                found = _range_row(place, hashes, counts, range_bits, PAIR_BYTES, least, hot, fold)
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(found, KINDS)], SHARDS.names)

    return merged.select("range", "hashes", "counts").mapInArrow(run, SHARDS)


KINDS = (pa.int32(), pa.int64(), *[pa.binary()] * 4)


def shards_of_words(words: DataFrame, range_bits: int, least: int, hot: int) -> DataFrame:
    """The filter of each range of a table of words."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        hashes, counts = rows["hash"].to_numpy().astype(np.uint64), rows["n"].to_numpy()
        found = _range_row(int(key[0]), hashes, counts, range_bits, WORD_BYTES, least, hot)
        return pd.DataFrame({f: [x] for f, x in zip(SHARDS.names, found)})

    place = F.shiftrightunsigned("hash", 64 - range_bits).cast("int")
    return words.where(F.col("n") >= least).withColumn("range", place).groupBy("range").applyInPandas(run, SHARDS)


@dataclass
class Filter:
    """A log-frequency Bloom filter in ranges of hashes."""

    range_bits: int
    width: int
    least: int
    sizes: np.ndarray
    offsets: np.ndarray
    bits: np.ndarray
    first: int = 0  # range that the sizes begin with

    @classmethod
    def of_range(cls, place: int, size: int, bits: bytes, range_bits: int, width: int, least: int) -> Filter:
        """For hashes of this range only."""
        sizes, offsets = np.array([size], dtype=np.int64), np.zeros(1, dtype=np.int64)
        return cls(range_bits, width, least, sizes, offsets, np.frombuffer(bits, dtype=np.uint8), place)

    @classmethod
    def of(cls, rows: list, range_bits: int, width: int, least: int) -> Filter:
        found = {r["range"]: (r["size"], r["bits"]) for r in rows}
        listed = [found.get(i, (64, bytes(8))) for i in range(1 << range_bits)]
        lengths = np.array([len(b) for _, b in listed], dtype=np.int64)
        return cls(
            range_bits,
            width,
            least,
            np.array([s for s, _ in listed], dtype=np.int64),
            np.cumsum(lengths) - lengths,
            np.frombuffer(b"".join(bytes(b) for _, b in listed), dtype=np.uint8),
        )

    def level(self, hashes: np.ndarray) -> np.ndarray:
        """Number of levels that are present for each hash, from the lowest without a gap."""
        hashes = kept_bits(hashes, self.range_bits, self.width)
        out = np.zeros(len(hashes), dtype=np.int64)
        left = np.arange(len(hashes))
        most = len(levels(self.least))
        level = 0
        while left.size and level < most:
            key, apart = _entry(hashes[left], level)
            place = (hashes[left] >> np.uint64(64 - self.range_bits)).astype(np.int64) - self.first
            size, offset = self.sizes[place].astype(np.uint64), self.offsets[place]
            for probe in range(PROBES):
                at = (key % size).astype(np.int64)
                byte = self.bits[offset + (at >> 3)]
                hit = (byte >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
                left = left[hit]
                if probe < PROBES - 1:
                    key, apart, size, offset = key[hit] + apart[hit], apart[hit], size[hit], offset[hit]
            level += 1
            out[left] = level
        return out


@dataclass
class Coarse:
    """The coarse form of a filter in ranges."""

    fold: int
    sizes: np.ndarray  # of the filter itself
    offsets: np.ndarray
    bits: np.ndarray

    @classmethod
    def of(cls, rows: list, range_bits: int, fold: int) -> Coarse:
        found = {r["range"]: (r["size"], r["coarse"]) for r in rows}
        listed = [found.get(i, (64, bytes(8))) for i in range(1 << range_bits)]
        lengths = np.array([len(b) for _, b in listed], dtype=np.int64)
        sizes = np.array([s for s, _ in listed], dtype=np.uint64)
        return cls(fold, sizes, np.cumsum(lengths) - lengths, np.frombuffer(b"".join(b for _, b in listed), dtype=np.uint8))

    def holds(self, hashes: np.ndarray, range_bits: int) -> np.ndarray:
        """Whether the filter can have the first level of each hash."""
        out = np.zeros(len(hashes), dtype=bool)
        left = np.arange(len(hashes))
        key, apart = _entry(hashes, 0)
        place = (hashes >> np.uint64(64 - range_bits)).astype(np.int64)
        for _ in range(PROBES):
            at = (key[left] % self.sizes[place[left]]).astype(np.int64) // self.fold
            byte = self.bits[self.offsets[place[left]] + (at >> 3)]
            left = left[(byte >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)]
            key[left] += apart[left]
        out[left] = True
        return out


@dataclass
class Hot:
    """What a filter in ranges reads for its most frequent n-grams."""

    range_bits: int
    width: int
    least: int
    hashes: np.ndarray  # sorted
    levels: np.ndarray
    coarse: Coarse | None = None

    @classmethod
    def of(cls, rows: list, range_bits: int, width: int, least: int, coarse: Coarse | None = None) -> Hot:
        rows = sorted(rows, key=lambda r: r["range"])  # each sorted, and a range is the first bits of a hash
        hashes = np.frombuffer(b"".join([r["hot_hashes"] for r in rows]), dtype=np.uint64)
        read = np.frombuffer(b"".join([r["hot_levels"] for r in rows]), dtype=np.int16)
        return cls(range_bits, width, least, hashes, read, coarse)

    def level(self, hashes: np.ndarray) -> np.ndarray:
        """As ``Filter.level``, and ``OPEN`` for n-grams that their range has to be asked for."""
        hashes = kept_bits(hashes, self.range_bits, self.width)
        out = np.full(len(hashes), OPEN, dtype=np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            out = np.where(self.hashes[at] == hashes, self.levels[at], OPEN).astype(np.int64)
        if self.coarse is not None:
            rest = np.flatnonzero(out == OPEN)
            out[rest[~self.coarse.holds(hashes[rest], self.range_bits)]] = 0
        return out


OPEN = -1


class Memory:
    """Levels of frequent words that a worker has probed for, so that it does so once and not in every chunk."""

    ROOM = 1 << 18

    def __init__(self, of: Filter):
        self.of = of
        self.hashes = np.zeros(0, dtype=np.uint64)
        self.levels = np.zeros(0, dtype=np.int64)

    def level(self, hashes: np.ndarray) -> np.ndarray:
        """As ``Filter.level``, for sorted different hashes."""
        out = np.zeros(len(hashes), dtype=np.int64)
        new = np.ones(len(hashes), dtype=bool)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
            new = self.hashes[at] != hashes
            out[~new] = self.levels[at[~new]]
        out[new] = self.of.level(hashes[new])
        often = new & (out >= 8)
        if len(self.hashes) + often.sum() <= self.ROOM:
            known = np.concatenate([self.hashes, hashes[often]])
            order = np.argsort(known)
            self.hashes, self.levels = known[order], np.concatenate([self.levels, out[often]])[order]
        return out


@dataclass
class Model:
    words: Filter | Hot
    pairs: Filter | Hot
    hot: np.ndarray  # hashes of the most frequent words, sorted
    hot_counts: np.ndarray
    n: int  # training tokens
    v: int  # different training tokens
    table: DataFrame | None  # all words with their counts
    ranges: DataFrame | None = None  # filters that stay tables, by kind and range

    def __getstate__(self) -> dict:
        return self.__dict__ | {"table": None, "ranges": None}


def train(texts: DataFrame) -> Model:
    """Count a column of texts and build the filter."""
    size = texts.agg(F.sum(F.octet_length(texts.columns[0]))).first()[0] or 0
    range_bits = min(20, max(4, math.ceil(math.log2(max(1, size / 6 / RANGE_TOKENS)))))
    words = stored(words_of_blocks(counted_blocks(texts, range_bits, False), range_bits), "lm-words")
    bucket = F.floor(8 * F.log2("n")).cast("int")
    by_size = words.groupBy(bucket.alias("b")).agg(F.count("*").alias("k"), F.sum("n").alias("s"))
    kinds = {r["b"]: (r["k"], r["s"]) for r in by_size.collect()}  # at most 8 * 63 rows
    n, v = sum(s for _, s in kinds.values()), sum(k for k, _ in kinds.values())
    word_sizes = {b: k for b, (k, _) in kinds.items()}
    least = hot_class(word_sizes, HOT)
    hot = words.where(bucket >= least).toArrow()  # at most HOT rows
    hashes = hot["hash"].to_numpy().astype(np.uint64)
    order = np.argsort(hashes)
    blocks = counted_blocks(texts, range_bits, True)
    pairs = stored(merged_blocks(blocks, range_bits, PAIR_BYTES, PAIR_COUNT), "lm-pairs")
    by_class = pairs.select(F.posexplode("sizes").alias("b", "k")).groupBy("b").agg(F.sum("k").alias("k"))
    pair_sizes = {r["b"]: r["k"] for r in by_class.where("k > 0").collect()}
    ranges: list[DataFrame] = []

    def held(kind: int, sizes: dict[int, int], least: int, width: int, room: int) -> Filter | Hot:
        fits = least_count(sizes, least) == least
        hot = max(sizes, default=0) + 1 if fits else hot_class(sizes, room)
        fold = 0
        if kind == PAIRS and not fits:
            fold = next((f for f in (2, 4, 8) if f <= FOLD and filter_bits(sizes, least) <= f * MAX_BITS), 0)
        if kind == WORDS:
            shards = shards_of_words(words, range_bits, least, hot)
        else:
            shards = shards_of_merged(pairs, range_bits, least, hot, fold)
        if fits:
            return Filter.of(shards.select("range", "size", "bits").collect(), range_bits, width, least)
        shards = stored(shards, "lm-filter")
        ranges.append(shards.select(F.lit(kind).alias("kind"), "range", "size", "bits"))
        coarse = Coarse.of(shards.select("range", "size", "coarse").collect(), range_bits, fold) if fold else None
        return Hot.of(shards.select("range", "hot_hashes", "hot_levels").collect(), range_bits, width, least, coarse)

    return Model(
        held(WORDS, word_sizes, 1, WORD_BYTES, HOT),
        held(PAIRS, pair_sizes, PAIR_COUNT, PAIR_BYTES, HOT_PAIRS),
        hashes[order],
        hot["n"].to_numpy()[order],
        int(n),
        int(v),
        words,
        reduce(DataFrame.unionAll, ranges) if ranges else None,
    )


_LATEST: list[Memory] = []


def token_levels(model: Model, memory: Memory | Hot, after: np.ndarray, before: np.ndarray) -> list[np.ndarray]:
    """Levels of each token, of the one before it and of both together."""
    words, place = np.unique(after, return_inverse=True)
    level = memory.level(words)
    # The token before is the last one, or the beginning of a text; texts begin as often as they end.
    end = level[np.searchsorted(words, END)]
    context = np.concatenate([[end], level[place[:-1]]])
    context[before == BEGIN] = end
    pairs, where = np.unique(pair_hashes(before, after), return_inverse=True)
    return [level[place], context, model.pairs.level(pairs)[where]]


def smoothed(n: int, word: np.ndarray, context: np.ndarray, pair: np.ndarray, least_word: int, least_pair: int) -> np.ndarray:
    """log10 of the smoothed probabilities from levels; ``n`` is N + V + 1."""
    scale = np.concatenate([[0], levels(least_word)])
    single = (scale[word] + 1) / n
    above = np.maximum(np.concatenate([scale[1:], scale[-1:]])[context] - 1, 1)
    together = np.concatenate([[0], levels(least_pair)])[pair]
    share = np.minimum(together / above, 1.0)
    return np.log10(LAMBDA * share + (1 - LAMBDA) * single)


def log_probabilities(model: Model, memory: Memory | Hot, after: np.ndarray, before: np.ndarray) -> np.ndarray:
    """log10 of the smoothed probability of each token after the one before it, all from membership probes."""
    found = token_levels(model, memory, after, before)
    return smoothed(model.n + model.v + 1, *found, model.words.least, model.pairs.least)


WORDS, PAIRS, TOKENS, PLACED = 1, 2, 3, 4
LATE = [
    T.StructField("_kind", T.IntegerType()),  # none in rows of documents
    T.StructField("_batch", T.LongType()),
    T.StructField("_range", T.IntegerType()),
    T.StructField("_block", T.BinaryType()),
]


APART = 512  # numbers from which the bytes of each place are compressed apart


def pack(head: int, columns: list[np.ndarray], widths: tuple[int, ...]) -> bytes:
    """Columns of numbers of so many bytes each: the first bytes of all numbers, then the second ones, compressed."""
    n = len(columns[0])
    planes = [p for c, w in zip(columns, widths) for p in c.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :w].T]
    planes = planes if n >= APART else [np.concatenate(planes)]
    frames = [pa.compress(p.tobytes(), "zstd", asbytes=True) if p.any() else b"" for p in planes]
    return np.array([n, head, *map(len, frames)], dtype=np.int64).tobytes() + b"".join(frames)


def unpack(block: bytes, widths: tuple[int, ...]) -> tuple[int, list[np.ndarray]]:
    n, head = np.frombuffer(block, dtype=np.int64, count=2).tolist()
    lengths = [n] * sum(widths) if n >= APART else [n * sum(widths)]
    at, flat = 16 + 8 * len(lengths), []
    for size, length in zip(np.frombuffer(block, dtype=np.int64, count=len(lengths), offset=16).tolist(), lengths):
        flat.append(pa.decompress(block[at : at + size], length, "zstd", asbytes=True) if size else bytes(length))
        at += size
    planes = np.frombuffer(b"".join(flat), dtype=np.uint8).reshape(-1, n)
    out = []
    for end, w in zip(np.cumsum(widths), widths):
        raw = np.zeros((n, 8), dtype=np.uint8)
        raw[:, :w] = planes[end - w : end].T
        out.append(raw.view("<u8").ravel().astype(np.uint64))
    return head, out


ASKED = (PAIR_BYTES, 4, 2, 2)  # bytes of a pair (its distance from the one before), its document and two levels
TOLD = (4, 2, 2, 2)  # bytes of a document (its distance from the one before) and three levels
TOLD_BLOCKS = T.StructType([T.StructField("_batch", T.LongType()), T.StructField("_block", T.BinaryType())])


class Placed:
    """Tokens of which only the pair is open, on their way to the range of the pair."""

    def __init__(self, model: Model, batch: int):
        self.range_bits, self.batch = model.pairs.range_bits, batch
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, rows: np.ndarray, hashes: np.ndarray, word: np.ndarray, context: np.ndarray) -> None:
        self.parts.append((rows, kept_bits(hashes, self.range_bits, PAIR_BYTES), word.astype(np.int16), context.astype(np.int16)))
        self.size += len(rows)

    def blocks(self) -> Iterator[tuple[int, int, int, bytes]]:
        rows, hashes, word, context = (np.concatenate(x) for x in zip(*self.parts))
        self.clear()
        first = int(rows[0])
        order = np.argsort(hashes, kind="stable")
        hashes = hashes[order]
        ranges = (hashes >> np.uint64(64 - self.range_bits)).astype(np.int64)
        short = hashes << np.uint64(self.range_bits) >> np.uint64(64 - 8 * PAIR_BYTES)
        starts = np.flatnonzero(np.diff(ranges, prepend=-1))
        for a, b in zip(starts, np.append(starts[1:], len(hashes))):
            these = order[a:b]
            columns = [np.diff(short[a:b], prepend=np.uint64(0)), rows[these] - first, word[these], context[these]]
            yield PLACED, self.batch, int(ranges[a]), pack(first, columns, ASKED)
        self.batch += 1


def told(asked: DataFrame, model: Model) -> DataFrame:
    """The tokens of each block whose pair its range holds, with the level of the pair."""
    range_bits, width, least = model.pairs.range_bits, model.pairs.width, model.pairs.least

    def run(key: tuple, shards: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        if not len(blocks) or not len(shards):
            return pd.DataFrame({f: [] for f in TOLD_BLOCKS.names})
        place = int(key[0])
        firsts, columns = zip(*(unpack(b, ASKED) for b in blocks["_block"]))
        short = np.concatenate([np.cumsum(c[0], dtype=np.uint64) for c in columns])
        hashes = short << np.uint64(64 - 8 * width) >> np.uint64(range_bits) | np.uint64(place << (64 - range_bits))
        different, where = np.unique(hashes, return_inverse=True)
        read = Filter.of_range(place, int(shards["size"][0]), shards["bits"][0], range_bits, width, least).level(different)[where]
        ends = np.cumsum([len(c[0]) for c in columns])[:-1]
        made = []
        for first, c, level in zip(firsts, columns, np.split(read, ends)):
            hit = np.flatnonzero(level)
            hit = hit[np.argsort(c[1][hit], kind="stable")]
            rows = np.diff(c[1][hit], prepend=np.uint64(0))
            made.append(pack(first, [rows, c[2][hit], c[3][hit], level[hit]], TOLD) if len(hit) else None)
        return pd.DataFrame({"_batch": blocks["_batch"], "_block": made}).dropna()

    ranges = model.ranges.where(F.col("kind") == PAIRS)
    return ranges.groupBy("range").cogroup(asked.groupBy("_range")).applyInPandas(run, TOLD_BLOCKS)


def corrections(rows: DataFrame, model: Model) -> DataFrame:
    """What the scores of documents gain by the pairs that the ranges hold."""
    n, least_word, least_pair = model.n + model.v + 1, model.words.least, model.pairs.least

    def run(key: tuple, blocks: pd.DataFrame) -> pd.DataFrame:
        firsts, columns = zip(*(unpack(b, TOLD) for b in blocks["_block"]))
        row = np.concatenate([np.cumsum(c[0], dtype=np.uint64) for c in columns]).astype(np.int64)
        word, context, pair = (np.concatenate(x).astype(np.int64) for x in list(zip(*columns))[1:])
        # In one order, whichever range answers first.
        different, times = np.unique(row << 30 | word << 20 | context << 10 | pair, return_counts=True)
        row, word, context, pair = different >> 30, different >> 20 & 1023, different >> 10 & 1023, different & 1023
        gain = smoothed(n, word, context, pair, least_word, least_pair) - smoothed(n, word, context, 0 * pair, least_word, least_pair)
        docs, count = np.unique(row, return_counts=True)
        return pd.DataFrame({"_row": docs + firsts[0], "_late": _sums(gain * times, count)})

    asked = rows.where(F.col("_kind") == PLACED).select("_range", "_batch", "_block")
    return told(asked, model).groupBy("_batch").applyInPandas(run, LATE_SUMS)


class Late:
    """Tokens that wait for the levels of n-grams that are open."""

    def __init__(self, model: Model, batch: int):
        self.range_bits, self.width = model.pairs.range_bits, model.pairs.width
        self.batch = batch
        self.clear()

    def clear(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, rows: np.ndarray, after: np.ndarray, before: np.ndarray, found: list[np.ndarray]) -> None:
        self.parts.append((rows, after, before, *(x.astype(np.int16) for x in found)))
        self.size += len(rows)

    def blocks(self) -> Iterator[tuple[int, int, int | None, bytes]]:
        """What the ranges are asked, each different n-gram once, and the tokens with the numbers of their questions."""
        rows, after, before, word, context, pair = (np.concatenate(x) for x in zip(*self.parts))
        self.clear()
        pairs = pair_hashes(before, after)
        _, first, where = np.unique(pairs, return_index=True, return_inverse=True)
        after, before = after[first], np.where(before[first] == BEGIN, END, before[first])
        word, context, pair = word[first], context[first], pair[first]
        open_words = np.concatenate([after[word == OPEN], before[context == OPEN]])
        words, named = np.unique(open_words, return_inverse=True)
        asked = kept_bits(pairs[first][pair == OPEN], self.range_bits, self.width)
        for kind, hashes, width in ((WORDS, words, WORD_BYTES), (PAIRS, asked, self.width)):
            ranges = (hashes >> np.uint64(64 - self.range_bits)).astype(np.int64)
            starts = np.flatnonzero(np.diff(ranges, prepend=-1))
            raw = _cut(hashes, self.range_bits, width)
            for a, b in zip(starts, np.append(starts[1:], len(hashes))):
                yield kind, self.batch, int(ranges[a]), raw[a:b].tobytes()
        docs, counts = np.unique(rows, return_counts=True)
        head = np.array([docs[0], len(docs), len(rows), len(word), len(named)], dtype=np.int64)
        parts = (head, (docs - docs[0]).astype(np.int32), counts.astype(np.int32), where.astype(np.int32), named.astype(np.int32))
        body = b"".join(x.tobytes() for x in (*parts, word, context, pair))
        size = np.array([len(body)], dtype=np.int64).tobytes()
        yield TOKENS, self.batch, None, size + pa.compress(body, "zstd", asbytes=True)
        self.batch += 1


ANSWERS = T.StructType([LATE[1], *[T.StructField(n, t) for n, t in (("_kind", T.IntegerType()), ("_range", T.IntegerType()))], LATE[3]])
LATE_SUMS = T.StructType([T.StructField("_row", T.LongType()), T.StructField("_late", T.DoubleType())])


def answered(asked: DataFrame, model: Model) -> DataFrame:
    """The levels that the range of each block of n-grams reads for it, in the same order."""
    about = {k: (p.range_bits, p.width, p.least) for k, p in ((WORDS, model.words), (PAIRS, model.pairs))}

    def run(key: tuple, shards: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        kind, place = int(key[0]), int(key[1])
        if not len(blocks):
            return pd.DataFrame({f: [] for f in ANSWERS.names})
        size, bits = (int(shards["size"][0]), shards["bits"][0]) if len(shards) else (64, bytes(8))
        width = about[kind][1]
        hashes, where = np.unique(_uncut(b"".join(blocks["_block"]), place, about[kind][0], width), return_inverse=True)
        read = Filter.of_range(place, size, bits, *about[kind]).level(hashes)[where].astype(np.int16)
        ends = np.cumsum([len(b) // width for b in blocks["_block"]])[:-1]
        made = [x.tobytes() for x in np.split(read, ends)]
        return pd.DataFrame({"_batch": blocks["_batch"], "_kind": kind, "_range": place, "_block": made})

    return model.ranges.groupBy("kind", "range").cogroup(asked.groupBy("_kind", "_range")).applyInPandas(run, ANSWERS)


def late_scores(rows: DataFrame, model: Model) -> DataFrame:
    """What came late to the score of each document."""
    parts = [corrections(rows, model)] if isinstance(model.pairs, Hot) else []
    if isinstance(model.words, Hot):
        parts.append(waiting_scores(rows, model))
    return reduce(DataFrame.unionAll, parts)


def waiting_scores(rows: DataFrame, model: Model) -> DataFrame:
    """The sum of the log probabilities of the tokens of each document that had to wait."""
    n, least_word, least_pair = model.n + model.v + 1, model.words.least, model.pairs.least

    def run(key: tuple, waiting: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers = answers.sort_values(["_kind", "_range"])
        told = {
            k: np.frombuffer(b"".join(answers["_block"][answers["_kind"] == k]), dtype=np.int16).astype(np.int64)
            for k in (WORDS, PAIRS)
        }
        block = waiting["_block"][0]
        body = pa.decompress(block[8:], int(np.frombuffer(block, dtype=np.int64, count=1)[0]), "zstd", asbytes=True)
        start, n_docs, n_tokens, n_pairs, n_named = np.frombuffer(body, dtype=np.int64, count=5)
        numbers = np.frombuffer(body, dtype=np.int32, offset=40, count=2 * n_docs + n_tokens + n_named)
        docs, counts, where, named = np.split(numbers, np.cumsum([n_docs, n_docs, n_tokens]))
        read = np.frombuffer(body, dtype=np.int16, offset=40 + 4 * len(numbers)).astype(np.int64).reshape(3, n_pairs)
        word, context, pair = read
        both = read[:2].ravel()  # words, then those before
        both[both == OPEN] = told[WORDS][named]
        pair[pair == OPEN] = told[PAIRS]
        logs = smoothed(n, word, context, pair, least_word, least_pair)
        return pd.DataFrame({"_row": docs + start, "_late": _sums(logs[where], counts)})

    asked = rows.where(F.col("_kind").isin(WORDS, PAIRS)).select("_kind", "_batch", "_range", "_block")
    waiting = rows.where(F.col("_kind") == TOKENS).select("_batch", "_block")
    return waiting.groupBy("_batch").cogroup(answered(asked, model).groupBy("_batch")).applyInPandas(run, LATE_SUMS)


REST = T.ArrayType(T.StructType([T.StructField("hash", T.LongType()), T.StructField("n", T.LongType())]))
SCORED = [
    T.StructField("_row", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("hot_known", T.LongType()),
    T.StructField("hot_logs", T.DoubleType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("rest", REST),
]


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, np.cumsum(counts) - counts)


def scored(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add the number of tokens and of known ones, the scores of the base model and of the smoothed model."""
    fields = [f for f in docs.schema.fields if f.name != text]
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in fields] + SCORED + LATE)
    names, types = schema.names, to_arrow_schema(schema).types
    column = docs.columns.index(text)
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        memory: Memory | Hot = m.words
        if isinstance(m.words, Filter):
            if not _LATEST or _LATEST[0].of is not m.words:
                _LATEST[:] = [Memory(m.words)]  # kept from one task to the next
            memory = _LATEST[0]
        row = TaskContext.get().partitionId() << 40  # rows and batches are numbered once and stored
        late, placed = Late(m, row), Placed(m, row)

        def send(late: Late | Placed) -> Iterator[pa.RecordBatch]:
            for block in late.blocks():
                made = [pa.nulls(1, t) for t in types[: -len(LATE)]] + [pa.array([x], t) for x, t in zip(block, types[-len(LATE) :])]
                yield pa.RecordBatch.from_arrays(made, names)

        for batch in batches:
            for a, b, chunk in _chunks(batch, column):
                after, before, counts = tokens(chunk)
                found = token_levels(m, memory, after, before)
                waits = np.minimum(found[0], found[1]) == OPEN
                asks = (found[2] == OPEN) & ~waits
                logs = smoothed(m.n + m.v + 1, *found[:2], np.where(asks, 0, found[2]), m.words.least, m.pairs.least)
                owners = np.repeat(np.arange(row, row + len(counts)), counts)
                if asks.any():
                    placed.add(owners[asks], pair_hashes(before[asks], after[asks]), found[0][asks], found[1][asks])
                if waits.any():
                    logs[waits] = 0
                    late.add(owners[waits], after[waits], before[waits], [x[waits] for x in found])
                at = np.minimum(np.searchsorted(m.hot, after), max(len(m.hot) - 1, 0))
                is_hot = m.hot[at] == after if len(m.hot) else np.zeros(len(after), dtype=bool)
                count = np.where(is_hot, m.hot_counts[at], 0) if len(m.hot) else np.zeros(len(after))
                owner = np.repeat(np.arange(len(counts)), counts)[~is_hot]
                # Other words, summed for each document: sorted by document and hash, equal neighbours are one.
                rare = after[~is_hot]
                order = np.lexsort((rare, owner))
                rare, owner = rare[order], owner[order]
                other = (rare[1:] != rare[:-1]) | (owner[1:] != owner[:-1])
                new = np.flatnonzero(np.concatenate([np.ones(min(len(rare), 1), dtype=bool), other]))
                times = np.diff(np.concatenate([new, [len(rare)]]))
                offsets = np.searchsorted(owner[new], np.arange(len(counts) + 1)).astype(np.int32)
                items = pa.StructArray.from_arrays(
                    [pa.array(rare[new].astype(np.int64)), pa.array(times.astype(np.int64))], ["hash", "n"]
                )
                made = [
                    pa.array(np.arange(row, row + len(counts))),
                    pa.array(counts.astype(np.int64)),
                    pa.array(_sums(is_hot.astype(np.int64), counts)),
                    pa.array(_sums(np.where(is_hot, np.log10(count + 1.0), 0.0), counts)),
                    pa.array(_sums(logs, counts)),
                    pa.ListArray.from_arrays(pa.array(offsets), items),
                ]
                row += len(counts)
                part = batch.slice(a, b - a)
                made += [pa.nulls(len(counts), t) for t in types[-len(LATE) :]]
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in fields] + made, names)
                for some in (late, placed):
                    if some.size >= LATE_TOKENS:
                        yield from send(some)
        for some in (late, placed):
            if some.size:
                yield from send(some)

    rows = stored(docs.mapInArrow(run, schema), "lm-scored")
    return _with_base(rows.where(F.col("_kind").isNull()), model, late_scores(rows, model) if model.ranges is not None else None)


def _with_base(rows: DataFrame, model: Model, late: DataFrame | None) -> DataFrame:
    """Complete the figures of the base model with the words that are not hot, and the score with what came late."""
    known = model.table.select(F.col("hash").alias("_hash"), F.col("n").alias("_count"))
    rest = rows.select("_row", F.explode("rest").alias("r")).select("_row", F.col("r.hash").alias("h"), F.col("r.n").alias("k"))
    found = rest.join(known, F.col("h") == F.col("_hash")).groupBy("_row").agg(
        F.sum("k").alias("_known"), F.sum(F.col("k") * F.log10(F.col("_count") + 1)).alias("_logs")
    )
    plus: Column = F.coalesce("_logs", F.lit(0.0))
    base = F.col("hot_logs") + plus - F.col("n_tokens") * math.log10(model.n + model.v + 1)
    joined = rows.join(found.withColumnRenamed("_row", "_r"), F.col("_row") == F.col("_r"), "left")
    score = F.col("score")
    if late is not None:
        late = late.groupBy(F.col("_row").alias("_l")).agg(F.sum("_late").alias("_late"))
        joined = joined.join(late, F.col("_row") == F.col("_l"), "left")
        score = (score + F.coalesce("_late", F.lit(0.0))).alias("score")
    own = [c for c in rows.columns if c not in {f.name for f in SCORED + LATE}]
    return joined.select(
        *own,
        "n_tokens",
        (F.col("hot_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(model.n).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        score,
    )
