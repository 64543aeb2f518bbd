"""Token counts attributed to the sections of documents by offsets.

Each whole text is encoded once; every token then covers a span of the text's bytes, and the spans tile the text.
Sections are spans of characters, translated to bytes.  The interval join of the two is done with binary searches in the
sorted token ends, so it costs no more than the numbers of tokens and sections of a document.  A token that crosses a
boundary is given out by a rule, and the counts under all three are returned:

* ``by_start``: to the sections that hold its first byte,
* ``by_largest``: to the section that holds most of its bytes, the earlier one on ties,
* ``by_share``: to every section by its share of the token's bytes.

Where sections tile the text, each rule gives out every token exactly once.

Defined results: a null or empty text has no tokens, and sections of a null text are kept with zero counts; a section
is cut at the ends of the text and may be empty, without tokens; bytes that no section holds go to none; sections that
overlap each count what they hold, and under ``by_largest`` those that cut a token compete for it; null sections are no
sections.  Other columns are kept; the output column replaces a column of its name.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from treeledger.llm.bpe import CHUNK_CHARS, Vocabulary, _encoder
from treeledger.llm.hashing import slices

Spans = list[tuple[int, int]]
COUNTS = T.ArrayType(
    T.StructType(
        [
            T.StructField("section", T.IntegerType()),
            T.StructField("start", T.IntegerType()),
            T.StructField("stop", T.IntegerType()),
            T.StructField("by_start", T.LongType()),
            T.StructField("by_largest", T.LongType()),
            T.StructField("by_share", T.DoubleType()),
        ]
    )
)


def line_spans(text: str) -> Spans:
    """The lines of a text, each with its line break."""
    out, at = [], 0
    while at < len(text):
        end = text.find("\n", at) + 1 or len(text)
        out.append((at, end))
        at = end
    return out


def attribute(ends: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of tokens by the three rules for sections of bytes ``first`` to ``last``.

    ``ends`` has the start of the first token and then the end of each.
    """
    starts = ends[:-1]
    if not len(starts):
        return np.zeros(len(first), np.int64), np.zeros(len(first), np.int64), np.zeros(len(first))
    a, b = np.searchsorted(starts, first), np.searchsorted(starts, last)
    by_start = np.maximum(b - a, 0)
    line = np.arange(len(ends), dtype=float)
    by_share = np.maximum(np.interp(last, ends, line) - np.interp(first, ends, line), 0.0)
    # Tokens wholly inside, and then those cut by a section's start or end.
    inside = np.maximum(np.searchsorted(ends[1:], last, "right") - a, 0)
    cut_start, cut_end = np.searchsorted(ends, first, "right") - 1, np.searchsorted(ends, last, "left") - 1
    section = np.arange(len(first))
    opens = (last > first) & (first < ends[-1]) & (starts[np.minimum(cut_start, len(starts) - 1)] < first)
    closes = (last > first) & (last < ends[-1]) & (ends[np.minimum(cut_end + 1, len(starts))] > last)
    closes &= ~(opens & (cut_end == cut_start))  # a section within one token cuts it once
    token = np.concatenate([cut_start[opens], cut_end[closes]])
    owner = np.concatenate([section[opens], section[closes]])
    held = np.minimum(last[owner], ends[np.minimum(token + 1, len(starts))]) - np.maximum(first[owner], ends[token])
    order = np.lexsort((owner, first[owner], -held, token))
    won = order[np.flatnonzero(np.diff(token[order], prepend=-1))]
    return by_start, inside + np.bincount(owner[won], minlength=len(first)), by_share


def with_token_counts(
    docs: DataFrame,
    vocabulary: Vocabulary,
    text: str = "text",
    sections: str | Callable[[str], Spans] = line_spans,
    counts: str = "sections",
) -> DataFrame:
    """Add the token counts of sections.

    ``sections`` is an array column of structs whose first two fields are first and last character (exclusive), or a
    function that finds these spans in a text.
    """
    kept = [f for f in docs.schema.fields if f.name != counts]
    names = [f.name for f in kept]
    held = docs.sparkSession.sparkContext.broadcast(vocabulary)
    column = sections if isinstance(sections, str) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(held.value)
        widths = np.diff(held.value.token_starts)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
            for start, stop in slices(sizes, CHUNK_CHARS):
                part = batch.slice(start, stop - start)
                texts = [x or "" for x in part.column(text).to_pylist()]
                if column:
                    spans = [[tuple(s.values())[:2] for s in x or [] if s] for x in part.column(column).to_pylist()]
                else:
                    spans = [sections(x) for x in texts]
                numbers, ids = encoder.encode(texts)
                limits = np.concatenate([[0], np.cumsum(numbers)])
                rows: list[list] = [[] for _ in COUNTS.elementType.fields]
                for i, x in enumerate(texts):
                    if not spans[i]:
                        continue
                    given = np.array(spans[i], dtype=np.int64).reshape(-1, 2)
                    data = np.frombuffer(x.encode(), dtype=np.uint8)
                    place = np.append(np.flatnonzero((data & 0xC0) != 0x80), data.size)  # first byte of each character
                    first, last = place[np.clip(given[:, 0], 0, len(x))], place[np.clip(given[:, 1], 0, len(x))]
                    ends = np.concatenate([[0], np.cumsum(widths[ids[limits[i] : limits[i + 1]]])])
                    made = (np.arange(len(given)), given[:, 0], given[:, 1], *attribute(ends, first, last))
                    for all_, some in zip(rows, made):
                        all_.append(some)
                arrays = [
                    pa.array(np.concatenate(r) if r else [], kind)
                    for r, kind in zip(rows, [pa.int32()] * 3 + [pa.int64()] * 2 + [pa.float64()])
                ]
                fields = pa.StructArray.from_arrays(arrays, COUNTS.elementType.names)
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(s) for s in spans])]).astype(np.int32))
                made_column = pa.ListArray.from_arrays(offsets, fields)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), made_column], [*names, counts])

    return docs.mapInArrow(run, T.StructType([*kept, T.StructField(counts, COUNTS)]))
