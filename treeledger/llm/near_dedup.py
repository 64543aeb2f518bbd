"""Near-duplicate documents by a signature-coordinate inverted join.

A document is the set of its word shingles.  ``COORDINATES`` coordinates, each made of two minimum hashes, are its
signature; two sets of similarity s agree in one with probability s².  Documents are posted under every pair of
coordinate and value, and pairs that collide in ``MATCHES`` coordinates or more are compared on their full sets.  All
lists bring up candidates; prefix merging, where only the first ``PREFIX`` lists would, is left out: the test on the first
common list holds for every such pair and removes none.  At the similarity limit of 0.8 a pair misses the match threshold with probability below 1e-6.

Sets that are equal are one representative throughout, so exact copies cost one row.  Lists of more than ``LONG`` different
sets would bring up a square of pairs and are skipped in that merge; they are worked off without listing pairs: some of
their sets serve as pivots that all others are compared with, which joins most of a group of near copies into one
component; what is still outside is then compared with all sets of that list's component, block by block, and only the
links that join components are kept.  No link between different components is lost, however long a list is.

Defined results: texts without words have no shingles and no links; a text with fewer words than a shingle is one
shingle; equal rows are linked, and an id with several texts is linked through any of them; rows with a null id are not linked, they have a null component and are kept; an empty
table gives an empty result.  Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeledger.llm.common import stored
from treeledger.llm.components import components
from treeledger.llm.hashing import mix, seeds, slices, word_hashes

COORDINATES = 20
MATCHES = 3
PREFIX = COORDINATES - MATCHES + 1
LONG = 64  # different sets in a list from which on pairs are not listed
PIVOTS = 4
BLOCK = 512  # sets that are compared with one another in one task
CHUNK_BYTES = 1 << 19
SMALL_ROWS = 1_000_000  # rows of one number that may be sent to every task

FACTORS = seeds(16, 1)
MINIMA = seeds(2 * COORDINATES, 101)
FIRST, SECOND = seeds(2, 301)


def shingle_sets(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """The sorted different shingles of each text, as 64-bit hashes."""
    words, counts = word_hashes(texts)
    n = max(len(words) - width + 1, 0)
    rolled = np.zeros(n, dtype=np.uint64)
    for i in range(width):
        rolled += words[i : i + n] * FACTORS[i]
    rolled = mix(rolled)
    at = 0
    for count in counts.tolist():
        if count >= width:
            yield np.unique(rolled[at : at + count - width + 1])
        elif count:
            whole = words[at : at + count] * FACTORS[:count]
            yield mix(np.array([whole.sum(dtype=np.uint64) + np.uint64(count)]))
        else:
            yield rolled[:0]
        at += count


def signature(shingles: np.ndarray) -> tuple[int, int, np.ndarray]:
    """Two sums that stand for the whole set, and the coordinates."""
    least = np.full(2 * COORDINATES, np.uint64(2**64 - 1))
    for i in range(0, len(shingles), 4096):
        least = np.minimum(least, (shingles[i : i + 4096, None] * MINIMA).min(axis=0))
    pairs = mix(least[::2] ^ mix(least[1::2])) + np.arange(COORDINATES, dtype=np.uint64)
    sums = [mix(shingles ^ s).sum(dtype=np.uint64).astype(np.int64) for s in (FIRST, SECOND)]
    return int(sums[0]), int(sums[1]), mix(pairs).astype(np.int64)


SIGNED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("f1", T.LongType()),
        T.StructField("f2", T.LongType()),
        T.StructField("coordinates", T.ArrayType(T.LongType())),
    ]
)
SETS = T.StructType(
    [
        T.StructField("node", T.LongType()),
        T.StructField("f1", T.LongType()),
        T.StructField("shingles", T.ArrayType(T.LongType())),
    ]
)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
    ids = batch.column(0).to_pylist()
    texts = batch.column(1).cast(pa.binary())
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    for a, b in slices(lengths, CHUNK_BYTES):
        yield ids[a:b], [x or b"" for x in texts.slice(a, b - a).to_pylist()]


def signed(docs: DataFrame, width: int) -> DataFrame:
    """Set size, set sums and signature of each document; ``docs`` is id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _texts(batch):
                rows = [(i, len(s), *signature(s)) for i, s in zip(ids, shingle_sets(texts, width))]
                columns = [pa.array(c, pa.int64()) for c in list(zip(*rows))[:4]]
                flat = pa.array(np.concatenate([r[4] for r in rows]))
                offsets = pa.array(np.arange(len(rows) + 1, dtype=np.int32) * COORDINATES)
                yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, flat)], SIGNED.names)

    return docs.mapInArrow(run, SIGNED)


def full_sets(docs: DataFrame, width: int) -> DataFrame:
    """Shingles of each document; ``docs`` is id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, texts in _texts(batch):
                sets = list(shingle_sets(texts, width))
                offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets).astype(np.int64)))
                sums = [mix(s ^ FIRST).sum(dtype=np.uint64).astype(np.int64) for s in sets]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(sums, pa.int64()), lists], SETS.names)

    return docs.mapInArrow(run, SETS)


def sized(df: DataFrame) -> DataFrame:
    """Send a stored table of one number a row to every task while it is small; otherwise leave the join to Spark."""
    return F.broadcast(df) if df.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else df


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    whole = F.size("sa") + F.size("sb")
    return pairs.join(left, "a").join(right, "b").where(100 * common >= percent * (whole - common)).select("a", "b")


def _cross_links(asking: pd.DataFrame, held: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """For each asking set one link to each other component among the held sets that has one."""
    values = np.concatenate([np.asarray(s, dtype=np.int64) for s in held.shingles])
    sizes = np.array([len(s) for s in held.shingles])
    owners = np.repeat(np.arange(len(held)), sizes)
    order = np.argsort(values, kind="stable")
    values, owners = values[order], owners[order]
    nodes, comps = held.node.to_numpy(), held.comp.to_numpy()
    out = []
    for node, comp, shingles in zip(asking.node, asking.comp, asking.shingles):
        shingles = np.asarray(shingles, dtype=np.int64)
        a, b = np.searchsorted(values, shingles), np.searchsorted(values, shingles, "right")
        runs = b - a
        ends = np.cumsum(runs)
        found = owners[np.repeat(a - ends + runs, runs) + np.arange(ends[-1] if len(ends) else 0)]
        common = np.bincount(found, minlength=len(held))
        near = (100 * common >= percent * (len(shingles) + sizes - common)) & (comps != comp)
        for i in pd.Series(np.flatnonzero(near)).groupby(comps[near]).first():
            out.append((int(node), int(nodes[i])))
    return out


LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _labelled(nodes: DataFrame, comps: DataFrame) -> DataFrame:
    """Add ``comp``: the component of a node, itself where it has no link."""
    named = comps.withColumnRenamed("node", "_node")
    return nodes.join(named, F.col("node") == F.col("_node"), "left").select(
        *nodes.columns, F.coalesce("component", "node").alias("comp")
    )


def _left_over(lists: DataFrame, comps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between different components that long lists still hold; ``lists`` is key and node."""
    labelled = stored(_labelled(lists, comps), "dedup-long")
    # A list's main component is the one with most of its sets; the others ask.
    mains = labelled.groupBy("key", "comp").agg(F.count("*").alias("n")).groupBy("key").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count("*").alias("comps")
    )
    mixed = labelled.join(mains.where("comps > 1"), "key")
    asking = stored(mixed.where("comp <> main").select("main", "node", "comp").distinct(), "dedup-asking")
    inside = mixed.where("comp = main").select("main", "node", "comp").distinct()
    held = stored(inside.union(asking).distinct(), "dedup-held")

    def blocked(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy("main").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias(f"n_{name}"))
        return stored(counts, f"dedup-{name}").withColumnRenamed("main", "_m")

    n_a, n_h = blocked(asking, "a"), blocked(held, "h")
    n_h2 = n_h.withColumnRenamed("_m", "_m2")
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    put = lambda df: df.join(n_a, F.col("main") == F.col("_m")).join(n_h2, F.col("main") == F.col("_m2"))
    mine = sets.select(F.col("node").alias("_n"), F.col("shingles").alias("_s"))
    with_sets = lambda df: df.join(mine, F.col("node") == F.col("_n")).withColumn("shingles", F.col("_s"))
    columns = ("main", "node", "comp", "shingles")
    left = put(with_sets(asking)).select(*columns, own("n_a").alias("i"), every("n_h").alias("j"))
    right = put(with_sets(held)).select(*columns, own("n_h").alias("j"), every("n_a").alias("i"))

    def compare(asks: pd.DataFrame, holds: pd.DataFrame) -> pd.DataFrame:
        found = _cross_links(asks, holds, percent) if len(asks) and len(holds) else []
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    keys = ["main", "i", "j"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(compare, LINKS)


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Per document its number of shingles, its component (the least id it is linked with) and whether it is kept."""
    plain = docs.select(F.col(doc_id).cast("long").alias("id"), F.col(text).alias("text"))
    rows = stored(signed(plain, width), "dedup-signatures")
    usable = rows.where("n_shingles > 0 and id is not null")
    groups = stored(usable.groupBy("f1", "f2").agg(F.min("id").alias("node"), F.count("*").alias("n")), "dedup-sets")
    firsts = groups.select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), "node")
    first = (F.col("id") == F.col("node")) & (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2"))
    posts = usable.join(firsts, first).dropDuplicates(["node", "f1", "f2"])
    posts = stored(posts.select("node", F.posexplode("coordinates").alias("c", "key")), "dedup-posts")
    # Lists with one set bring up nothing; the sizes of the others decide how they are merged.
    lengths = posts.groupBy(F.col("key").alias("k")).agg(F.count("*").alias("n")).where("n > 1")
    lists = stored(posts.join(lengths, F.col("key") == F.col("k")).drop("k"), "dedup-lists")
    short = lists.where(F.col("n") <= LONG)
    other = short.select(F.col("key").alias("k2"), F.col("node").alias("b"), F.col("c").alias("c2"))
    met = short.withColumnRenamed("node", "a").join(other, (F.col("key") == F.col("k2")) & (F.col("a") < F.col("b")))
    counted = met.groupBy("a", "b").agg(F.count("*").alias("n"), F.min("c").alias("first"))
    # Pairs that also meet in skipped lists may lack collisions here, so the count is complete only for other pairs.
    long_ = stored(lists.where(F.col("n") > LONG).select("key", "node"), "dedup-skipped")
    skipped = stored(long_.select("node").distinct().withColumnRenamed("node", "s"), "dedup-skipped-nodes")
    hit = counted.join(skipped, F.col("a") == F.col("s"), "left").where(
        (F.col("n") >= MATCHES) & (F.col("first") < PREFIX) | F.col("s").isNotNull()
    )
    # Pivots of long lists, the same in all lists as far as possible: the sets with the least hash of their id.
    order = F.struct(F.xxhash64("node").alias("h"), F.col("node").alias("node"))
    salted = long_.groupBy("key", F.pmod(F.xxhash64("node", F.lit(1)), F.lit(PIVOTS)).alias("p")).agg(
        F.min(order)["node"].alias("pivot")
    )
    pivoted = long_.join(salted.select(F.col("key").alias("k2"), "pivot"), F.col("key") == F.col("k2"))
    aimed = pivoted.where("pivot <> node").select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b"))
    pairs = stored(hit.select("a", "b").union(aimed).distinct(), "dedup-pairs")
    involved = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(long_.select("node")).distinct()
    involved = stored(involved.withColumnRenamed("node", "involved"), "dedup-involved")
    needed = plain.join(sized(involved), F.col("id") == F.col("involved"), "left_semi")
    sets = stored(full_sets(needed, width).dropDuplicates(["node", "f1"]).drop("f1"), "dedup-full-sets")
    links = stored(_verified(pairs, sets, percent), "dedup-links")
    comps = components(links)
    more = stored(_left_over(long_, comps, sets, percent), "dedup-more-links")
    if more.limit(1).count():
        comps = components(links.union(more))
    found = stored(
        _labelled(groups.select("node", "f1", "f2", "n"), comps)
        .where("n > 1 or comp <> node")
        .select(F.col("f1").alias("g1"), F.col("f2").alias("g2"), "comp"),
        "dedup-classes",
    )
    out = rows.join(found, (F.col("f1") == F.col("g1")) & (F.col("f2") == F.col("g2")) & F.col("id").isNotNull(), "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("comp", "id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(doc_id),
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )
