"""Approximate nearest neighbours with a forest of random-projection trees.

The forest is fitted on a bounded sample: tree by tree, every level has one random direction, and every node the median
of its sample along it as threshold.  Each vector is posted under its leaf in every tree.  A query walks all trees at
once with one priority queue, ordered by the summed squares of the margins that it crossed, and takes leaves until it has
its share of them.  Queries meet the vectors of their leaves in a join by leaf, cosines are computed exactly in double
precision there, and the best of all leaves are merged.

Equal vectors are one: they share a leaf in every tree and no threshold can part them.  Only the least ``k + 1`` of
their ids can be in a result.  Leaves and the queries that visit them are cut into blocks of about ``BLOCK``, so no task
holds a whole group, whatever its size.  A query vector that many queries share is searched once.

The share of leaves falls with the number of vectors, ``SHARE * (n / SHARE_ROWS) ** -FALL``; a table with few vectors
has one leaf and is searched whole.

Defined results: vectors that are null, empty, zero, or hold null or non-finite components take no part, nor do those
whose length is not the most frequent one (the greater on ties); a query without candidates gives no row; ties go to the
smaller id; rows that repeat an id are one candidate, with its best score, and one query; null ids take no part; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from treeledger.llm.common import stored

TREES = 8
SAMPLE = 1 << 16  # vectors that the forest is fitted on
LEAF = 256  # vectors in a leaf while all are in the sample
SAMPLE_LEAF = 16  # sampled vectors in a leaf at least
SHARE, SHARE_ROWS, FALL = 0.2, 10_000, 0.15
BLOCK = 2048
SEED = 20_240

VECTORS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("key", T.StringType()),
        T.StructField("length", T.IntegerType()),
        T.StructField("vector", T.BinaryType()),
    ]
)


def usable_vectors(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """Vectors that take part, in the precision of their column, with a digest that names equal ones."""
    single = isinstance(rows.schema[embedding].dataType.elementType, T.FloatType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i is None or not v or any(x is None for x in v):
                    continue
                x = np.array(v, dtype=np.float32 if single else np.float64) + 0  # so that -0 is 0
                if np.isfinite(x).all() and x.any():
                    raw = x.tobytes()
                    found.append((i, hashlib.sha256(raw).hexdigest(), len(x), raw))
            columns = list(zip(*found)) if found else [[]] * 4
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int32(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(arrays, VECTORS.names)

    vectors = rows.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).alias("vector"))
    if not single:
        vectors = vectors.withColumn("vector", F.col("vector").cast("array<double>"))
    return vectors.mapInArrow(run, VECTORS)


def _matrix(vectors: list[bytes], length: int) -> np.ndarray:
    """Vectors of one length as rows of doubles; single precision is told by their number of bytes."""
    kind = np.float32 if len(vectors[0]) == 4 * length else np.float64
    return np.frombuffer(b"".join(vectors), dtype=kind).astype(np.float64).reshape(len(vectors), length)


def _unit(x: np.ndarray) -> np.ndarray:
    """Vectors of length one; scaled first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


@dataclass
class Forest:
    """``directions[t, d]`` is the direction of level d, ``thresholds[t][d]`` has the threshold of each node there."""

    depth: int
    length: int  # of the vectors
    directions: np.ndarray
    thresholds: list[list[np.ndarray]]

    @classmethod
    def fit(cls, sample: np.ndarray, depth: int, trees: int = TREES) -> Forest:
        rng = np.random.default_rng(SEED)
        directions = rng.normal(size=(trees, depth, sample.shape[1]))
        thresholds = []
        for t in range(trees):
            node, levels = np.zeros(len(sample), dtype=np.int64), []
            for d in range(depth):
                along = sample @ directions[t, d]
                order = np.lexsort((along, node))
                counts = np.bincount(node, minlength=1 << d)
                middle = np.cumsum(counts) - counts + counts // 2
                level = np.where(counts > 0, along[order[np.minimum(middle, len(order) - 1)]], 0.0)
                levels.append(level)
                node = 2 * node + (along >= level[node])
            thresholds.append(levels)
        return cls(depth, sample.shape[1], directions, thresholds)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each vector in each tree."""
        out = np.zeros((len(self.thresholds), len(x)), dtype=np.int64)
        for t, levels in enumerate(self.thresholds):
            along = x @ self.directions[t].T if self.depth else None
            for d, level in enumerate(levels):
                out[t] = 2 * out[t] + (along[:, d] >= level[out[t]])
        return out

    def visited(self, x: np.ndarray, limit: int) -> list[tuple[int, int]]:
        """The first leaves (tree, leaf) of one vector from the shared priority queue."""
        along = [self.directions[t] @ x for t in range(len(self.thresholds))]
        queue = [(0.0, t, 0, 0) for t in range(len(self.thresholds))]
        out = []
        while queue and len(out) < limit:
            cost, t, d, node = heapq.heappop(queue)
            while d < self.depth:
                margin = along[t][d] - self.thresholds[t][d][node]
                near = int(margin >= 0)
                heapq.heappush(queue, (cost + margin * margin, t, d + 1, 2 * node + 1 - near))
                d, node = d + 1, 2 * node + near
                if queue[0][0] < cost:
                    break
            if d == self.depth:
                out.append((t, node))
            else:
                heapq.heappush(queue, (cost, t, d, node))
        return out


POSTS = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("leaf", T.IntegerType()),
        T.StructField("key", T.StringType()),
        T.StructField("vector", T.BinaryType()),
    ]
)
FOUND = T.StructType(
    [
        T.StructField("query", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ]
)


def _posted(vectors: DataFrame, forest: Forest, share: float | None) -> DataFrame:
    """Each vector under its leaves; with a share, under the leaves that a query visits."""
    held = vectors.sparkSession.sparkContext.broadcast(forest)
    limit = 0 if share is None else max(TREES, math.ceil(share * TREES * (1 << forest.depth)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                keys, raw = batch.column("key").to_pylist(), batch.column("vector").to_pylist()
                x = _unit(_matrix(raw, held.value.length))
                if share is None:
                    leaves = held.value.leaves(x)
                    rows = [(t, int(leaves[t, i]), keys[i], raw[i]) for t in range(len(leaves)) for i in range(len(keys))]
                else:
                    rows = [(t, n, k, r) for k, r, v in zip(keys, raw, x) for t, n in held.value.visited(v, limit)]
                kinds = (pa.int32(), pa.int32(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], POSTS.names)

    return vectors.select("key", "vector").mapInArrow(run, POSTS)


def _nearest_in(asks: pd.DataFrame, holds: pd.DataFrame, k: int, length: int) -> pd.DataFrame:
    """The k + 1 best of the held vectors for each asking one; equal scores in order of the least id."""
    q, x = _matrix(list(asks.vector), length), _matrix(list(holds.vector), length)
    scores = _unit(q) @ _unit(x).T
    n = min(k + 1, len(holds))
    least = holds.least.to_numpy()
    rows = []
    for i, key in enumerate(asks.key):
        limit = np.partition(scores[i], len(holds) - n)[len(holds) - n]
        near = np.flatnonzero(scores[i] >= limit)
        best = near[np.lexsort((least[near], -scores[i][near]))][:n]
        rows.append(pd.DataFrame({"query": key, "key": holds.key.to_numpy()[best], "score": scores[i][best]}))
    return pd.concat(rows)


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 5,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    share: float = SHARE,
    sample: int = SAMPLE,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k nearest of each query by cosine.  ``is_query`` reads the column ``id``."""
    every = stored(usable_vectors(rows, vec_id, embedding), "ann-usable")
    lengths = every.groupBy("length").count().agg(F.max(F.struct("count", "length"))["length"]).first()[0]
    schema = T.StructType(
        [
            T.StructField("query_id", T.LongType()),
            T.StructField("rank", T.IntegerType()),
            T.StructField("vec_id", T.LongType()),
            T.StructField("score", T.DoubleType()),
        ]
    )
    if lengths is None:
        return rows.sparkSession.createDataFrame([], schema)
    every = every.where(F.col("length") == lengths)
    # The least ids of each vector; the rank is limited before rows are moved.
    by_key = Window.partitionBy("key").orderBy("id")
    ranked = every.select("key", "id").distinct().withColumn("_r", F.row_number().over(by_key)).where(F.col("_r") <= k + 1)
    ids = stored(ranked.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids")), "ann-ids")
    firsts = ids.select(F.col("key").alias("_k"), F.col("ids")[0].alias("least"))
    first = (F.col("key") == F.col("_k")) & (F.col("id") == F.col("least"))
    vectors = stored(every.join(firsts, first).dropDuplicates(["key"]).select("key", "vector", "least"), "ann-vectors")
    n = vectors.count()
    depth = max(0, math.floor(math.log2(max(1, min(n / LEAF, min(n, sample) / SAMPLE_LEAF)))))
    part = vectors.select("vector")
    if n > sample:
        part = vectors.where(F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < int((1 << 30) * sample / n)).select("vector")
    forest = Forest.fit(_unit(_matrix(part.toArrow()["vector"].to_pylist(), lengths)), depth)
    # With less than a leaf of vectors there is nothing to skip.
    part_visited = min(1.0, share * (max(n, SHARE_ROWS) / SHARE_ROWS) ** -FALL) if depth > 2 else 1.0
    # Which queries there are, and under which vector each is searched.
    queries = stored(every.where(is_query).select(F.col("id").alias("query_id"), F.col("key").alias("query")).distinct(), "ann-queries")
    asked = queries.select(F.col("query").alias("_q")).distinct()
    asking = vectors.join(asked, F.col("key") == F.col("_q"), "left_semi")
    held = _posted(vectors, forest, None)
    probes = stored(_posted(asking, forest, part_visited), "ann-probes")
    sizes = held.groupBy("tree", "leaf").agg(F.count("*").alias("n_h")).join(
        probes.groupBy("tree", "leaf").agg(F.count("*").alias("n_a")), ["tree", "leaf"]
    )
    blocks = stored(
        sizes.select(
            F.col("tree").alias("_t"),
            F.col("leaf").alias("_l"),
            F.ceil(F.col("n_h") / BLOCK).cast("int").alias("_h"),
            F.ceil(F.col("n_a") / BLOCK).cast("int").alias("_a"),
        ),
        "ann-blocks",
    )
    here = (F.col("tree") == F.col("_t")) & (F.col("leaf") == F.col("_l"))
    own = lambda c: F.pmod(F.xxhash64("key"), F.col(c)).cast("int")
    all_of = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    left = probes.join(blocks, here).select("tree", "leaf", own("_a").alias("i"), all_of("_h").alias("j"), "key", "vector")
    named = vectors.select(F.col("key").alias("_key"), "least")
    right = (
        held.join(blocks, here)
        .join(named, F.col("key") == F.col("_key"))
        .select("tree", "leaf", own("_h").alias("j"), all_of("_a").alias("i"), "key", "vector", "least")
    )

    def compare(asks: pd.DataFrame, holds: pd.DataFrame) -> pd.DataFrame:
        if not len(asks) or not len(holds):
            return pd.DataFrame({"query": [], "key": [], "score": []})
        return _nearest_in(asks, holds, k, lengths)

    keys = ["tree", "leaf", "i", "j"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, FOUND)
    # One list of ids in order for each searched vector, one longer than a result, as it may hold the query itself.
    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    once = found.groupBy("query", "key").agg(F.max("score").alias("score"))
    named_ids = once.join(ids.select(F.col("key").alias("_key"), F.explode("ids").alias("vec_id")), F.col("key") == F.col("_key"))
    lists = (
        named_ids.groupBy("query", "vec_id")
        .agg(F.max("score").alias("score"))
        .withColumn("_r", F.row_number().over(best))
        .where(F.col("_r") <= k + 1)
        .select(F.col("query").alias("_q"), "vec_id", "score")
    )
    lists = stored(lists, "ann-lists")
    mine = queries.join(lists, F.col("query") == F.col("_q")).where("query_id != vec_id")
    mine = mine.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return mine.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
