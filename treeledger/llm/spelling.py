"""Spelling variants: words one edit apart, found through pivotal bigrams, grouped under their most frequent form.

The method is the pivotal prefix filter for edit distance (Deng, Li, Feng, SIGMOD 2014) with one edit and bigrams:

* Bigrams are ordered by the number of words that hold them (rare first, ties by the bigram).
* A word's prefix is every position of its three smallest bigrams in that order (of all of them if it has fewer).
* Its pivots are two disjoint positions of the prefix (they start two or more apart) of the least summed rank, found by
  a running minimum over the positions (the dynamic programme of the paper for two pivots).
* One edit destroys at most one of two disjoint bigrams, and moves the other by at most one position while the length
  changes by at most one.  So if two words are one edit apart, a pivot of one of them is in the prefix of the other at
  the same bigram, a position at most one away and a length at most one away (the word whose last prefix bigram comes
  first in the order is the one whose pivot survives into the other's prefix).  Each pivot asks the index of prefixes
  at the five (position, length) shifts that an edit allows, only of words whose last prefix bigram is not before its
  own word's; each candidate pair is verified by the edit distance.

All steps are joins, windows and aggregates on Spark.  The bigram order is the only table sent whole to every task: the
alphabet has 26 + 26 + 64 letters, so it holds at most 116 x 116 bigrams, whatever the size of the corpus.

Defined results: null texts have no runs; a null doc_id counts as the empty text in the hash; words are compared by
code points; an empty table or one without qualifying words gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from treeledger.llm.common import lower_ascii, stored

# Fixed values of the contract.
RUN = "[A-Za-z\\u00C0-\\u00FF]+"
DROP_EVERY = 199  # a run whose hash this divides loses the code point at hash % length
MIN_LENGTH = 6
MIN_COUNT = 5
FORM_RATIO = 5  # a form is at least this many times as frequent as the word
PREFIX = 3  # bigrams of the prefix: q * edits + 1
# (position, length) shifts of a bigram under one substitution, insertion or deletion.
SHIFTS = [(0, 0), (0, 1), (1, 1), (0, -1), (-1, -1)]


def occurrences(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row ``word`` per run of letters, with a code point deleted where the hash says so."""
    found = docs.select(
        F.col(doc_id).alias("d"), F.explode(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(RUN), 0)).alias("r")
    ).select("d", lower_ascii(F.col("r")).alias("r"))
    h = F.crc32(F.concat(F.coalesce(F.col("d").cast("string"), F.lit("")), F.lit(":"), F.col("r")).cast("binary"))
    k = (h % F.length("r")).cast("int")
    cut = F.concat(F.col("r").substr(F.lit(1), k), F.col("r").substr(k + 2, F.lit(1 << 30)))
    return found.select(F.when(h % DROP_EVERY == 0, cut).otherwise(F.col("r")).alias("word"))


def counted_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, n``: the words long and frequent enough (the count is partly aggregated before the shuffle)."""
    words = occurrences(docs, doc_id, text).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return words.where((F.length("word") >= MIN_LENGTH) & (F.col("n") >= MIN_COUNT))


def bigram_ranks(grams: DataFrame) -> DataFrame:
    """``gram, rank``: rare bigrams first.  At most 116 x 116 rows, so one task orders them."""
    held = grams.select("gram", "word").distinct().groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    return held.select("gram", F.row_number().over(Window.orderBy("df", "gram")).alias("rank"))


def pivots_and_prefixes(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(pivots, prefixes)``, both ``word, len, gram, pos``: two pivots a word, every prefix position."""
    grams = words.select(
        "word",
        F.length("word").alias("len"),
        F.posexplode(F.expr("transform(sequence(0, length(word) - 2), i -> substring(word, i + 1, 2))")).alias("pos", "gram"),
    )
    ranked = grams.join(F.broadcast(bigram_ranks(grams)), "gram")
    by_rank = Window.partitionBy("word").orderBy("rank")
    prefixes = ranked.withColumn("k", F.dense_rank().over(by_rank)).where(F.col("k") <= PREFIX).drop("k")
    # The rank of the last prefix bigram: a pivot needs to ask only words whose last is not smaller.
    prefixes = prefixes.withColumn("last", F.max("rank").over(Window.partitionBy("word")))
    # Best first pivot for each second one: least (rank, pos) at least two positions before it.
    before = Window.partitionBy("word").orderBy("pos").rangeBetween(Window.unboundedPreceding, -2)
    paired = prefixes.withColumn("first", F.min(F.struct("rank", "pos", "gram")).over(before)).where("first is not null")
    best = paired.groupBy("word", "len", "last").agg(
        F.min(F.struct((F.col("first.rank") + F.col("rank")).alias("total"), "pos", "gram", "first")).alias("b")
    )
    pivots = best.select(
        "word",
        "len",
        "last",
        F.explode(
            F.array(
                F.struct(F.col("b.gram").alias("gram"), F.col("b.pos").alias("pos")),
                F.struct(F.col("b.first.gram").alias("gram"), F.col("b.first.pos").alias("pos")),
            )
        ).alias("p"),
    ).select("word", "len", "last", "p.gram", "p.pos")
    return pivots, prefixes.select("word", "len", "last", "gram", "pos")


def near_pairs(words: DataFrame) -> DataFrame:
    """``a, b`` with a < b for every two words one inserted, deleted or replaced code point apart."""
    pivots, prefixes = pivots_and_prefixes(words)
    shifts = F.array(*[F.struct(F.lit(p).alias("dp"), F.lit(n).alias("dl")) for p, n in SHIFTS])
    moved = pivots.select("word", "gram", "pos", "len", "last", F.explode(shifts).alias("s"))
    asks = moved.select(
        F.col("word").alias("asker"),
        F.col("last").alias("asker_last"),
        "gram",
        (F.col("pos") + F.col("s.dp")).alias("pos"),
        (F.col("len") + F.col("s.dl")).alias("len"),
    )
    held = prefixes.select(F.col("word").alias("held"), F.col("last").alias("held_last"), "gram", "pos", "len")
    found = asks.join(held, ["gram", "pos", "len"]).where("asker <> held and asker_last <= held_last")
    pairs = found.select(F.least("asker", "held").alias("a"), F.greatest("asker", "held").alias("b")).distinct()
    return pairs.where(F.levenshtein("a", "b", 1) == 1)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` by following ``form`` from each word to a word without one (pointer doubling).

    A form is at least five times as frequent as its word, so chains are short and have no cycles; every round halves
    what is left of each chain and is written to the shared folder.
    """
    point = stored(forms.select("word", F.coalesce("form", "word").alias("to")), "spelling-roots")
    while True:
        ahead = point.select(F.col("word").alias("at"), F.col("to").alias("next"))
        step = point.join(ahead, F.col("to") == F.col("at")).select("word", "to", "next")
        moved = step.where(F.col("next") != F.col("to")).limit(1).count()
        if not moved:
            return point.select("word", F.col("to").alias("root"))
        point = stored(step.select("word", F.col("next").alias("to")), "spelling-roots")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of at least six code points seen at least five times."""
    words = stored(counted_words(docs, doc_id, text), "spelling-words")
    near = stored(near_pairs(words), "spelling-near")
    both = near.union(near.select(F.col("b").alias("a"), F.col("a").alias("b")))
    other = words.select(F.col("word").alias("b"), F.col("n").alias("nb"))
    best = both.join(other, "b").groupBy(F.col("a").alias("word")).agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("nb")).alias("m"), "b")).alias("best")
    )
    stats = words.join(best, "word", "left")
    has_form = F.col("best.m").isNotNull() & (-F.col("best.m") >= FORM_RATIO * F.col("n"))
    forms = stored(
        stats.select(
            "word",
            F.when(has_form, F.col("best.b")).alias("form"),
            F.col("n").cast("long").alias("n"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(has_form, -F.col("best.m")).cast("long").alias("form_n"),
        ),
        "spelling-forms",
    )
    return forms.join(roots(forms), "word").select("word", "form", "root", "n", "n_near", "form_n")
