"""Alignment of two tokenizers over a corpus: which token of one stands for which tokens of the other, and how often.

Each text is encoded by a byte-level BPE (A, of space + text) and a sentencepiece BPE (B, of the text; it adds the
space itself).  Byte offsets where an A token and a B token both end cut the text into groups; every A-B pair of token
occurrences of one group is a link.  An id pair's count is the number of links that hold it in the whole corpus, and a
link is "best" if its count is the highest of all pairs of its B id (ties included).

The named method is external spill counting: radix-partition the link records, write sorted runs compressed with
zstd, merge them with a heap so that equal pairs meet, and read the counts back in B-major order so that each B id's
maximum is known when its last pair has passed.  On Spark this is what a grouped aggregate does, so the code says it
as a Spark user does: links are aggregated inside each document and each task first (map-side combine), shuffled by
hash of the pair (the radix partition), sorted and spilled in runs that Spark merges with a heap (shuffle and spill
files use ``spark.io.compression.codec``, which a cluster sets to zstd), and the B-major pass is a second aggregate
keyed by the B id.  Contributions stream back to the documents: the counts of the ``HOT_PAIRS`` most frequent pairs
at most go to every task, which looks up the links of its documents; the links of all other pairs are joined with the
table of counts.  None of those is frequent, so the join has no skew.

Tokenizing is a helper in an Arrow function.  Texts are cut into chunks at single spaces between other characters, where
tokens of both sides always end; the groups and links of a chunk are found once while a worker remembers it (up to
``CHUNKS`` chunks, then it starts anew), and those of a text are put together from its chunks.  Texts of other
tokenizers, or whose bytes differ in a chunk, are encoded whole.

Defined results: null, empty, or texts whose A or B bytes joined differ from space + text have no tokens, zeros
everywhere and ``groups_sha256`` ''; special-token strings in a text are plain text; repeated rows and repeated or
null ids are separate rows, each counted; other columns of the input are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from treeledger.llm.bpe import byte_characters
from treeledger.llm.common import stored
from treeledger.llm.language_model import hot_class

HOT_PAIRS = 1 << 20  # pairs whose counts every task gets
# Texts handed to Python at once: long documents in large batches would fill a worker's memory.
BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 64
LOOKUP_ROWS = 512
BYTE_PIECE = re.compile(r"<0x([0-9A-Fa-f]{2})>")
# tiktoken's pattern engine gives up on longer runs of white space (its stack ends at a million).
SPACE = re.compile(r"\s+")
LONG_SPACE = 500_000

ALIGNED = (
    "rid long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pair_a array<int>, pair_b array<int>, pair_k array<long>"
)
PAIRS = ("pair_a", "pair_b", "pair_k")
KEPT = ("rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")


def _found(path: str) -> str:
    """A path as given, or a name of the public tokenizers where a worker has no file under that path."""
    if os.path.exists(path):
        return path
    import public_tokenizers

    return public_tokenizers.path(os.path.basename(path))


@dataclass
class _Table:
    """Byte strings of a vocabulary as one flat array with starts and lengths."""

    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @classmethod
    def of(cls, items: list[bytes]) -> _Table:
        size = np.array([len(b) for b in items], np.int64)
        start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        return cls(np.frombuffer(b"".join(items), np.uint8), start, size)

    def gather(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of ``ids`` one after the other."""
        sizes = self.size[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.start[ids] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.flat[at]


@dataclass
class Tools:
    encode_a: Callable[[str], list[int]]
    b: object
    a_bytes: list[bytes]
    b_bytes: list[bytes]
    a_table: _Table
    b_table: _Table
    digits: _Table  # decimal text of every A id, then of every B id
    chunks: Chunks | None = None  # where texts may be encoded in chunks


def _vocabulary_a(path: str) -> tuple[Callable[[str], list[int]], list[bytes]]:
    """The encoder of A and the bytes of its ids.

    A ``.tiktoken`` file holds the ranks of the byte-level vocabulary, which tiktoken encodes to the same ids as the
    tokenizers library does with the ``.json`` file of that vocabulary (the tests compare both), in a quarter of the
    time; texts with very long white space, and all texts under a ``.json`` file, go to the tokenizers library.
    """
    if path.endswith(".tiktoken"):
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        coder = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        by_id = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            by_id[rank] = token
        plain = cache(lambda: _library_encoder(_library_tokenizer(_found(path.removesuffix(".tiktoken") + ".json"))))

        def encode(text: str) -> list[int]:
            if len(text) >= LONG_SPACE and any(m.end() - m.start() >= LONG_SPACE for m in SPACE.finditer(text)):
                return plain()(text)
            return coder.encode_ordinary(text)

        return encode, by_id
    a = _library_tokenizer(path)
    back = {c: i for i, c in enumerate(byte_characters())}
    a_bytes = [bytes(back.get(c, 0) for c in (a.id_to_token(i) or "")) for i in range(a.get_vocab_size())]
    return _library_encoder(a), a_bytes


def _library_tokenizer(path: str):
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(path)
    a.encode_special_tokens = True
    return a


def _library_encoder(a) -> Callable[[str], list[int]]:
    return lambda text: a.encode(text, add_special_tokens=False).ids


@cache
def _tokenizers(a_path: str, b_path: str) -> Tools:
    import sentencepiece

    a_path, b_path = _found(a_path), _found(b_path)
    encode_a, a_bytes = _vocabulary_a(a_path)
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        hit = BYTE_PIECE.fullmatch(piece)
        b_bytes.append(bytes([int(hit.group(1), 16)]) if hit else piece.replace("▁", " ").encode())
    digits = _Table.of([str(i).encode() for i in range(len(a_bytes))] + [str(i).encode() for i in range(len(b_bytes))])
    tools = Tools(encode_a, b, a_bytes, b_bytes, _Table.of(a_bytes), _Table.of(b_bytes), digits)
    if a_path.endswith(".tiktoken") and _ends_at_joints(b):
        tools.chunks = Chunks(tools)
    return tools


def _ends_at_joints(b) -> bool:
    """Whether a sentencepiece model encodes what stands on the two sides of a joint apart.

    So do byte-pair merges of plain text (no normalizer, white space kept) when no piece has a space after another
    character.  The public pattern of A has no token over a joint either.
    """
    try:
        from sentencepiece import sentencepiece_model_pb2
    except ImportError:
        return False
    model = sentencepiece_model_pb2.ModelProto.FromString(b.serialized_model_proto())
    trained, plain = model.trainer_spec, model.normalizer_spec
    return (
        trained.model_type == trained.BPE
        and not trained.treat_whitespace_as_suffix
        and plain.add_dummy_prefix
        and plain.escape_whitespaces
        and not plain.remove_extra_whitespaces
        and not plain.precompiled_charsmap
        and not any("▁" in p.piece.lstrip("▁") or p.type in (p.USER_DEFINED, p.UNUSED) for p in model.pieces)
    )


def align(a_ids: list[int], b_ids: list[int], a_bytes: list[bytes], b_bytes: list[bytes]) -> list[tuple[list[int], list[int]]]:
    """Groups ``(A ids, B ids)`` of one text, cut where tokens of both end; the byte totals must be equal.

    A plain form of what :func:`describe` does with arrays.
    """
    a_end = np.cumsum([len(a_bytes[i]) for i in a_ids])
    b_end = np.cumsum([len(b_bytes[i]) for i in b_ids])
    cuts = np.intersect1d(a_end, b_end)
    ga, gb = np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)
    return [
        ([x for x, g in zip(a_ids, ga) if g == k], [y for y, g in zip(b_ids, gb) if g == k]) for k in range(len(cuts))
    ]


def _groups(a_ids: np.ndarray, b_ids: np.ndarray, tools: Tools) -> tuple[np.ndarray, ...]:
    """Group of every A and of every B token of texts whose A and B bytes are equal, and the byte offsets of the cuts."""
    a_end, b_end = np.cumsum(tools.a_table.size[a_ids]), np.cumsum(tools.b_table.size[b_ids])
    cut, b_mark = np.zeros(a_end[-1] + 1, bool), np.zeros(a_end[-1] + 1, bool)
    cut[a_end], b_mark[b_end] = True, True
    cut &= b_mark
    before = np.cumsum(cut) - cut  # cuts before an offset
    return before[a_end], before[b_end], np.flatnonzero(cut)


def _links(a_ids: np.ndarray, b_ids: np.ndarray, ga: np.ndarray, gb: np.ndarray, n_groups: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Every A token with every B token of its group as ``a * width + b``, and the number of links of every A token."""
    nb = np.bincount(gb, minlength=n_groups)
    times = nb[ga]
    inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    first = np.cumsum(nb) - nb
    return np.repeat(a_ids * width, times) + b_ids[np.repeat(first[ga], times) + inside], times


def _shown(a_ids: np.ndarray, b_ids: np.ndarray, ga: np.ndarray, gb: np.ndarray, n_groups: int, tools: Tools) -> tuple[bytes, np.ndarray]:
    """The groups as text, a mark behind each token, and where the text of each group ends.

    A ids of a group, '|', its B ids, ';' behind a group; ',' inside a side.
    """
    na, nb = np.bincount(ga, minlength=n_groups), np.bincount(gb, minlength=n_groups)
    a_upto, b_upto = np.cumsum(na), np.cumsum(nb)
    ids = np.empty(len(a_ids) + len(b_ids), np.int64)
    ids[np.arange(len(a_ids)) + (b_upto - nb)[ga]] = a_ids
    ids[np.arange(len(b_ids)) + a_upto[gb]] = b_ids + len(tools.a_bytes)
    mark = np.full(len(ids), ord(","), np.uint8)
    mark[a_upto + b_upto - nb - 1] = ord("|")
    mark[a_upto + b_upto - 1] = ord(";")
    ends = np.cumsum(tools.digits.size[ids] + 1)
    out = np.empty(int(ends[-1]), np.uint8)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    out[inside] = tools.digits.gather(ids)
    out[ends - 1] = mark
    return out.tobytes(), ends[a_upto + b_upto - 1]


def _equal(got: np.ndarray, whole: np.ndarray) -> bool:
    return len(got) == len(whole) and bool((got == whole).all())


NOTHING = (0, 0, 0, 0, "", np.zeros(0, np.int64))


def describe(text: str | None, tools: Tools) -> tuple:
    """``n_a, n_b, n_groups, n_links, groups_sha256`` of one text and its links as ``a * B ids + b``, encoded whole."""
    if not text:
        return NOTHING
    a_ids = np.array(tools.encode_a(" " + text), np.int64)
    b_ids = np.array(tools.b.encode(text), np.int64)
    whole = np.frombuffer((" " + text).encode(), np.uint8)
    if not _equal(tools.a_table.gather(a_ids), whole) or not _equal(tools.b_table.gather(b_ids), whole):
        return NOTHING
    ga, gb, cuts = _groups(a_ids, b_ids, tools)
    links, _ = _links(a_ids, b_ids, ga, gb, len(cuts), len(tools.b_bytes))
    shown, _ = _shown(a_ids, b_ids, ga, gb, len(cuts), tools)
    return len(a_ids), len(b_ids), len(cuts), len(links), hashlib.sha256(shown[:-1]).hexdigest(), links


# A space between two characters that are no white space: tokens of A and of B both end before it.
JOINT = re.compile(r" (?=\S)(?<=\S )")
CHUNKS = 1 << 19  # chunks that a worker remembers
CHUNK_BYTES = 1 << 26  # and the bytes of their texts and links


class Chunks:
    """Chunks of texts between joints, each encoded once while it is remembered.

    No A token and no B token reaches over a joint, so the groups of a text are those of its chunks in order.
    """

    def __init__(self, tools: Tools):
        self.tools = tools
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.shown: list[bytes] = []
        self.bytes = 0
        self.figures = np.zeros((1024, 4), np.int64)  # A tokens, B tokens, groups, links; negative: bytes differ
        self.start = np.zeros(1024, np.int64)
        self.links = np.zeros(4096, np.int64)
        self.used = 0

    def numbers(self, chunks: list[str]) -> list[int]:
        """The number of every chunk; new ones are described together."""
        new = [c for c in dict.fromkeys(chunks) if c not in self.known]
        if new:
            self._learn(new)
        return list(map(self.known.__getitem__, chunks))

    def _learn(self, new: list[str]) -> None:
        tools = self.tools
        whole = "".join([" " + c for c in new])
        sizes = np.array([len(c.encode()) + 1 for c in new])
        # Joined again by joints, chunks have the A tokens that each has alone.
        joined = len(JOINT.split(whole[1:])) == len(new)
        a = tools.encode_a(whole) if joined else [*chain.from_iterable(tools.encode_a(" " + c) for c in new)]
        b = [*chain.from_iterable(tools.b.encode(new, num_threads=1))]
        a_ids, b_ids = np.array(a, np.int64), np.array(b, np.int64)
        raw, upto = np.frombuffer(whole.encode(), np.uint8), np.cumsum(sizes)
        counts = []
        for table, ids in ((tools.a_table, a_ids), (tools.b_table, b_ids)):
            ends = np.cumsum(table.size[ids])
            counts.append(np.diff(np.searchsorted(ends, upto, side="right"), prepend=0))
            if not _equal(table.gather(ids), raw) or (ends[np.searchsorted(ends, upto)] != upto).any():
                break
        else:
            self._describe(new, a_ids, b_ids, *counts, upto)
            return
        if len(new) > 1:
            for part in (new[: len(new) // 2], new[len(new) // 2 :]):
                self._learn(part)
        else:
            self._add(new, [b""], np.full((1, 4), -1), np.zeros(1, np.int64), np.zeros(0, np.int64))

    def _describe(self, new: list[str], a_ids: np.ndarray, b_ids: np.ndarray, na: np.ndarray, nb: np.ndarray, upto: np.ndarray) -> None:
        tools = self.tools
        ga, gb, cuts = _groups(a_ids, b_ids, tools)
        links, times = _links(a_ids, b_ids, ga, gb, len(cuts), len(tools.b_bytes))
        shown, ends = _shown(a_ids, b_ids, ga, gb, len(cuts), tools)
        groups = np.searchsorted(cuts, upto, side="right")  # up to the end of each chunk
        limits = [0, *ends[groups - 1].tolist()]
        texts = [shown[i : j - 1] for i, j in zip(limits, limits[1:])]
        n_links = np.diff(np.cumsum(times)[np.cumsum(na) - 1], prepend=0)
        self._add(new, texts, np.stack([na, nb, np.diff(groups, prepend=0), n_links], 1), np.cumsum(n_links) - n_links, links)

    def _add(self, new: list[str], shown: list[bytes], figures: np.ndarray, start: np.ndarray, links: np.ndarray) -> None:
        at, end = len(self.shown), self.used + len(links)
        if at + len(new) > len(self.start):
            room = 2 * (at + len(new))
            self.figures, self.start = np.resize(self.figures, (room, 4)), np.resize(self.start, room)
        if end > len(self.links):
            self.links = np.resize(self.links, 2 * end)
        self.figures[at : at + len(new)], self.start[at : at + len(new)] = figures, start + self.used
        self.links[self.used : end] = links
        self.used = end
        self.shown += shown
        self.known.update(zip(new, range(at, at + len(new))))
        self.bytes += sum(map(len, new)) + sum(map(len, shown)) + 8 * len(links)


def _by_chunks(texts: list[str], tools: Tools) -> list[tuple]:
    """:func:`describe` of texts that are not empty, put together from their chunks."""
    memory = tools.chunks
    if len(memory.shown) > CHUNKS or memory.bytes > CHUNK_BYTES:
        memory.forget()
    pieces = [JOINT.split(t) for t in texts]
    numbers = memory.numbers([*chain.from_iterable(pieces)])
    flat = np.array(numbers)
    n = np.array([*map(len, pieces)])
    ends = np.cumsum(n)
    figures = memory.figures[flat]
    sums, least = np.add.reduceat(figures, ends - n), np.minimum.reduceat(figures[:, 0], ends - n)
    sizes = np.maximum(figures[:, 3], 0)
    upto = np.cumsum(sizes)
    links = memory.links[np.repeat(memory.start[flat] - (upto - sizes), sizes) + np.arange(upto[-1])]
    out = []
    for i, (text, first, last) in enumerate(zip(texts, (ends - n).tolist(), ends.tolist())):
        if least[i] < 0:
            out.append(describe(text, tools))
            continue
        shown = b";".join(map(memory.shown.__getitem__, numbers[first:last]))
        own = links[upto[first] - sizes[first] : upto[last - 1]]
        out.append((*sums[i].tolist(), hashlib.sha256(shown).hexdigest(), own))
    return out


def described(texts: list[str | None], tools: Tools) -> list[tuple]:
    """:func:`describe` of many texts."""
    if tools.chunks is None:
        return [describe(t, tools) for t in texts]
    found = iter(_by_chunks([t for t in texts if t], tools) if any(texts) else [])
    return [next(found) if t else NOTHING for t in texts]


def aligned(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: ``rid`` (a number of the row), the counts of its tokens, groups and links, and its pairs with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _tokenizers(a_path, b_path)
        width = len(tools.b_bytes)
        for batch in batches:
            if not batch.num_rows:
                continue
            *numbers, digest, links = zip(*described(batch.column("t").to_pylist(), tools))
            # The different links of every row: one sort of row and pair.
            pairs = len(tools.a_bytes) * width
            rows = np.repeat(np.arange(batch.num_rows) * pairs, [*map(len, links)])
            keys, k = np.unique(np.concatenate(links) + rows, return_counts=True)
            ends = np.searchsorted(keys, np.arange(batch.num_rows + 1) * pairs).astype(np.int32)
            keys %= pairs
            found = (keys // width).astype(np.int32), (keys % width).astype(np.int32), k.astype(np.int64)
            # Ids stay Arrow integers: as floats, which pandas makes of a column with nulls, large ones would change.
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("rid"),
                    batch.column("d"),
                    *(pa.array(n, pa.int64()) for n in numbers),
                    pa.array(digest, pa.string()),
                    *(pa.ListArray.from_arrays(ends, pa.array(p)) for p in found),
                ],
                names=[f.split()[0] for f in ALIGNED.split(", ")],
            )

    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t")
    )
    return _stored_in_batches(rows.mapInArrow(run, ALIGNED), "alignment-rows", BATCH_ROWS)


def _stored_in_batches(df: DataFrame, label: str, size: int) -> DataFrame:
    """``stored`` with so many rows handed to Python at once."""
    conf = df.sparkSession.conf
    before = conf.get(BATCH_SETTING, None)
    conf.set(BATCH_SETTING, str(size))
    try:
        return stored(df, label)
    finally:
        conf.unset(BATCH_SETTING) if before is None else conf.set(BATCH_SETTING, before)


def _pairs():
    return F.arrays_zip(F.col("pair_a").alias("a"), F.col("pair_b").alias("b"), F.col("pair_k").alias("k"))


def pair_counts(rows: DataFrame) -> DataFrame:
    """``a, b, count, best``: links of every id pair corpus-wide, and whether it is the most linked pair of its B id."""
    links = rows.select(F.inline(_pairs()))
    counts = links.groupBy("a", "b").agg(F.sum("k").alias("count"))
    top = counts.groupBy("b").agg(F.max("count").alias("top"))
    return stored(
        counts.join(top, "b").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best")), "alignment-counts"
    )


def _often(counts: DataFrame) -> tuple[tuple[np.ndarray, ...], bool]:
    """Keys, counts and marks of the most frequent pairs, ``HOT_PAIRS`` at most, and whether these are all pairs."""
    size = F.floor(8 * F.log2("count")).cast("int")  # eight classes to each doubling
    sizes = {r["s"]: r["n"] for r in counts.groupBy(size.alias("s")).agg(F.count("*").alias("n")).collect()}
    least = hot_class(sizes, HOT_PAIRS)
    found = counts.where(size >= least).toArrow()
    a, b, count = (found[c].to_numpy().astype(np.int64) for c in ("a", "b", "count"))
    keys = a << 32 | b
    order = np.argsort(keys)
    return (keys[order], count[order], found["best"].to_numpy(zero_copy_only=False)[order]), all(s >= least for s in sizes)


def scored(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Rows of :func:`aligned` with ``n_best`` and ``count_sum`` of their links.

    The most frequent pairs are looked up in each task; the others, none of which is frequent, are joined.
    """
    often, whole = _often(counts)
    held = rows.sparkSession.sparkContext.broadcast(often)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, count, best = held.value
        for batch in batches:
            size = pc.list_value_length(batch.column("pair_a")).to_numpy(zero_copy_only=False).astype(np.int64)
            a, b, k = (batch.column(c).flatten().to_numpy() for c in ("pair_a", "pair_b", "pair_k"))
            key = a.astype(np.int64) << 32 | b
            at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
            known = keys[at] == key if len(keys) else np.zeros(len(key), bool)
            ends, at, times = np.concatenate([[0], np.cumsum(size)]), at[known], np.where(known, k, 0)
            sums = []
            for worth in (best[at].astype(np.int64), count[at]):
                times[known] = k[known] * worth
                sums.append(np.diff(np.concatenate([[0], np.cumsum(times)])[ends]))
            left = np.concatenate([[0], np.cumsum(~known)])[ends].astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in KEPT),
                    *(pa.array(x, pa.int64()) for x in sums),
                    *(pa.ListArray.from_arrays(left, pa.array(x[~known])) for x in (a, b, k)),
                ],
                names=[*KEPT, "n_best", "count_sum", *PAIRS],
            )

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in (*KEPT, *PAIRS))
    head, tail = kinds.split(", pair_a")
    found = rows.select(*KEPT, *PAIRS).mapInArrow(run, f"{head}, n_best long, count_sum long, pair_a{tail}")
    found = _stored_in_batches(found, "alignment-scored", LOOKUP_ROWS)
    shown = ["rid", "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    if whole:
        return found.select(*shown)
    links = found.select("rid", F.inline(_pairs()))
    rest = links.join(counts, ["a", "b"]).groupBy("rid").agg(
        F.sum(F.when(F.col("best"), F.col("k")).otherwise(0)).alias("_best"), F.sum(F.col("k") * F.col("count")).alias("_sum")
    )
    plus = {"n_best": F.coalesce("_best", F.lit(0)), "count_sum": F.coalesce("_sum", F.lit(0))}
    joined = found.join(rest, "rid", "left")
    return joined.select(*((F.col(c) + plus[c]).cast("long").alias(c) if c in plus else F.col(c) for c in shown))


def alignment(docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with its alignment figures under the corpus-wide counts."""
    rows = aligned(docs, a_path, b_path, doc_id, text)
    return scored(rows, pair_counts(rows))
