"""Toxicity scores from a weighted finite-state pattern grammar.

A lexical transducer turns the words of a clause into classes: insult (with a learned weight), threat, target, negation,
reported speech, other.  Four small transducers read these classes and change weights: a negation shortly before an
insult weakens it, reported speech weakens what follows, a target strengthens an insult beside it, and a threat counts
only together with a target.  They are composed once into one table; each clause that has an insult or a threat runs
through it, and the clause scores of a document, not its words, are what a logistic model turns into a probability.

The insults (words and word beginnings) and their weights are learned from labelled documents: a bounded, hash-chosen
sample of at most ``MAX_TRAIN`` labels.  Near copies count once there, so that one text with many copies does not teach
its own words.  Scoring covers every document and its whole text.

Defined results: null and empty texts have no clauses and get the score of such a document; unlabelled, null and
held-out ids teach nothing; of repeated ids in the labels the largest label counts; without labels of both kinds the
grammar works with the listed insults and a fixed curve.  Other columns are kept; the score replaces a column of its
name.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from treeledger.llm.common import let, remainder_of_id, stored

MAX_TRAIN = 20_000  # labelled documents that the lexicon and the curve are fitted on
MAX_TERMS = 500  # learned insults
MIN_TOXIC = 8  # toxic training documents that a term needs
LEAST_WEIGHT = 2.0  # log of how much more often a term has to be in toxic documents
PREFIXES = range(3, 9)
HELD_OUT = 5

INSULT, THREAT, TARGET, NEGATION, REPORTED, OTHER = "IKTNRo"
# Fixed word lists of the grammar, for four languages; a word ends a list entry.
LISTED = {
    INSULT: "idiot idiots moron morons stupid scum loser losers pathetic worthless disgusting dumb imbecile bastard "
    "dummkopf trottel arschloch abschaum crétin connard salaud imbécile imbécil cabrón basura",
    THREAT: "kill murder hurt destroy burn beat shoot stab crush die töten umbringen tuer frapper matar golpear",
    TARGET: "you your he she they him her them we us this these those people everyone du dich ihr euch sie er "
    "tu toi vous il elle ils tú ti usted ustedes él ella ellos",
    NEGATION: "not never no isn't aren't wasn't don't cannot without nicht kein keine nie pas jamais sans nunca jamás sin",
    REPORTED: "said says called claimed wrote quoted reported alleged according sagte nannte schrieb "
    "dit écrit appelé dijo llamó escribió",
}
LISTED_WEIGHT = 4.0
NEGATION_REACH = 3  # words after a negation that it weakens

CLAUSES = re.compile(r"[.!?;:\n]+")
WORDS = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)*")


@dataclass
class Transducer:
    """Deterministic: ``arcs[state, class]`` is the next state, a factor for the weight read, and a weight added."""

    start: object
    arcs: dict[tuple[object, str], tuple[object, float, float]]

    def step(self, state: object, symbol: str) -> tuple[object, float, float]:
        return self.arcs.get((state, symbol), (state, 1.0, 0.0))

    def states(self) -> set[object]:
        return {self.start} | {s for s, _ in self.arcs} | {a[0] for a in self.arcs.values()}

    def compose(self, other: Transducer) -> Transducer:
        """Both at once: the states are pairs, factors multiply, added weights add up."""
        arcs = {}
        for a, b in product(self.states(), other.states()):
            for symbol in (INSULT, THREAT, TARGET, NEGATION, REPORTED, OTHER):
                (a2, f, x), (b2, g, y) = self.step(a, symbol), other.step(b, symbol)
                arcs[(a, b), symbol] = ((a2, b2), f * g, x + y)
        return Transducer((self.start, other.start), arcs)

    def score(self, clause: list[tuple[str, float]]) -> float:
        state, sum_ = self.start, 0.0
        for symbol, weight in clause:
            state, factor, added = self.step(state, symbol)
            sum_ += factor * weight + added
        return sum_


def grammar() -> Transducer:
    """The composition of the negation, reported-speech, target and threat transducers."""
    negation = Transducer(0, {})
    for left in range(NEGATION_REACH + 1):
        negation.arcs[left, NEGATION] = (NEGATION_REACH, 1.0, 0.0)
        for symbol in (INSULT, THREAT, TARGET, OTHER):
            weak = 0.3 if symbol == INSULT and left else 1.0
            negation.arcs[left, symbol] = (max(left - 1, 0), weak, 0.0)
    reported = Transducer("own", {("own", REPORTED): ("told", 1.0, 0.0), ("told", INSULT): ("told", 0.5, 0.0)})
    target = Transducer(
        "none",
        {
            ("none", TARGET): ("aimed", 1.0, 0.0),
            ("none", INSULT): ("open", 1.0, 0.0),
            ("aimed", INSULT): ("aimed", 1.25, 0.0),
            ("open", TARGET): ("aimed", 1.0, 0.5),
        },
    )
    threat = Transducer(
        "none",
        {
            ("none", THREAT): ("said", 1.0, 0.0),
            ("none", TARGET): ("aimed", 1.0, 0.0),
            ("said", TARGET): ("made", 1.0, 3.0),
            ("aimed", THREAT): ("made", 1.0, 3.0),
        },
    )
    return negation.compose(reported).compose(target).compose(threat)


@dataclass
class Lexicon:
    """Weights of insults; a term that ends in ``$`` is a whole word, any other the beginning of words."""

    insults: dict[str, float]
    _found: object = field(default=None, repr=False)
    _classes: dict[str, str] = field(default_factory=dict, repr=False)

    def prepare(self) -> None:
        """Build the automaton that finds insults and threats; it is not sent to workers."""
        finder = ahocorasick.Automaton()
        for term in [*self.insults, *(w + "$" for w in LISTED[THREAT].split())]:
            finder.add_word(term.rstrip("$"), len(term.rstrip("$")))
        finder.make_automaton()
        self._found = finder
        self._classes = {w: c for c in (TARGET, NEGATION, REPORTED, THREAT) for w in LISTED[c].split()}

    def __getstate__(self) -> dict:
        return {"insults": self.insults, "_found": None, "_classes": {}}

    def symbol(self, word: str) -> tuple[str, float]:
        weight = self.insults.get(word + "$")
        if weight is None:
            found = [self.insults[word[:k]] for k in range(1, len(word) + 1) if word[:k] in self.insults]
            weight = max(found, default=None)
        return (INSULT, weight) if weight is not None else (self._classes.get(word, OTHER), 0.0)

    def clauses(self, text: str) -> list[list[tuple[str, float]]]:
        """Classes of the clauses that have an insult or a threat."""
        text = text.lower()
        out, done = [], 0
        for end, size in self._found.iter(text):
            at = end - size + 1
            if at < done or (at and text[at - 1].isalpha()):
                continue
            start = max((text.rfind(c, done, at) for c in ".!?;:\n"), default=-1) + 1
            stop = CLAUSES.search(text, at)
            done = stop.start() if stop else len(text)
            clause = [self.symbol(w) for w in WORDS.findall(text, max(start, 0), done)]
            if any(s in (INSULT, THREAT) for s, _ in clause):
                out.append(clause)
        return out


FEATURES = ["sum", "most", "clauses", "density", "length"]


def _features(lexicon: Lexicon, machine: Transducer, text: str | None) -> list[float]:
    text = text or ""
    scores = [s for c in lexicon.clauses(text) if (s := machine.score(c)) > 0]
    sum_ = math.fsum(scores)
    return [
        math.log1p(sum_),
        max(scores, default=0.0),
        math.log1p(len(scores)),
        math.log1p(sum_ / (1 + len(text) / 500)),
        math.log1p(len(text)),
    ]


def with_clause_scores(docs: DataFrame, lexicon: Lexicon, text: str = "text", prefix: str = "tox_") -> DataFrame:
    """Add the figures that the grammar gives for each text, under FEATURES with a prefix."""
    new = [prefix + f for f in FEATURES]
    kept = [f for f in docs.schema.fields if f.name not in new]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon.prepare()
        machine = grammar()
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                made = np.array([_features(lexicon, machine, t) for t in batch.column(text).to_pylist()])
                arrays = [batch.column(n) for n in names] + [pa.array(made[:, i]) for i in range(len(FEATURES))]
                yield pa.RecordBatch.from_arrays(arrays, names + new)

    return docs.mapInArrow(run, T.StructType(kept + [T.StructField(n, T.DoubleType()) for n in new]))


def labelled_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, limit: int = MAX_TRAIN) -> DataFrame:
    """Texts and labels of at most about ``limit`` documents that are not held out, chosen by the hash of their id."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .where(remainder_of_id("doc_id", HELD_OUT) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("_toxic"))
    )
    rows = max(1, known.count())
    if rows > limit:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * limit / rows))
    # The bound on the sample makes it safe to send to every task, so the texts are not shuffled.
    known = F.broadcast(stored(known.withColumnRenamed("doc_id", "_labelled"), "toxicity-labels"))
    joined = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text")).join(
        known, F.col("_id") == F.col("_labelled")
    )
    return stored(joined.select("_text", "_toxic"), "toxicity-sample")


def _word_sets(sample: DataFrame) -> DataFrame:
    """Different words of each sampled text, near copies once: copies share their least hash of three words."""
    tokens = F.regexp_extract_all(F.lower(F.coalesce("_text", F.lit(""))), F.lit(r"\p{L}+"), 0)

    def least(w: Column) -> Column:
        three = F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(w) - 3, F.lit(0))), lambda i: F.xxhash64(F.slice(w, i + 1, 3))
        )
        return F.struct(F.array_min(three).alias("least"), F.array_distinct(w).alias("words"))

    return sample.select("_toxic", let(tokens, least).alias("_w")).groupBy("_w.least").agg(
        F.max("_toxic").alias("_toxic"), F.max_by("_w.words", "_toxic").alias("_words")
    )


def learn_insults(sample: DataFrame) -> dict[str, float]:
    """Words and word beginnings that are much more frequent in toxic documents, with the log of that ratio."""
    sets = stored(_word_sets(sample), "toxicity-words")
    toxic, clean = (sets.where(F.col("_toxic") == x).count() for x in (1, 0))
    if not toxic or not clean:
        return {w + "$": LISTED_WEIGHT for w in LISTED[INSULT].split()}
    counts = sets.select("_toxic", F.explode("_words").alias("word")).groupBy("word").agg(
        F.sum("_toxic").alias("pos"), F.sum(1 - F.col("_toxic")).alias("neg")
    )
    starts = F.array(*(F.when(F.length("word") >= k, F.substring("word", 1, k)) for k in PREFIXES))
    terms = F.concat(F.array(F.concat("word", F.lit("$"))), F.array_compact(starts))
    weight = F.log((F.col("pos") + 0.5) / (toxic + 1)) - F.log((F.col("neg") + 0.5) / (clean + 1))
    best = (
        counts.select(F.explode(terms).alias("term"), "pos", "neg")
        .groupBy("term")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
        .where(F.col("pos") >= MIN_TOXIC)
        .withColumn("weight", weight)
        .where(F.col("weight") >= LEAST_WEIGHT)
        .orderBy(F.desc(F.col("pos") * F.col("weight")), F.desc(F.length("term")), "term")
        .limit(10 * MAX_TERMS)
        .collect()
    )
    chosen: dict[str, tuple[float, int]] = {}
    for r in best:
        plain = r.term.rstrip("$")
        covered = any(plain[:k] in chosen for k in range(1, len(plain) + 1))
        # A beginning adds nothing when a longer term has nearly all of its toxic documents.
        finer = any(t.rstrip("$").startswith(plain) and n >= 0.9 * r.pos for t, (_, n) in chosen.items())
        if not covered and not finer and len(chosen) < MAX_TERMS:
            chosen[r.term] = (float(r.weight), r.pos)
    return {t: w for t, (w, _) in chosen.items()}


@dataclass
class Model:
    lexicon: Lexicon
    weights: list[float]
    bias: float


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = MAX_TRAIN) -> Model:
    """Learn the insults and the curve from the labelled documents that are not held out."""
    # Only the driver needs these; workers import this module too.
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    sample = labelled_sample(docs, labels, doc_id, text, limit)
    lexicon = Lexicon(learn_insults(sample))
    figures = stored(with_clause_scores(sample, lexicon, "_text").drop("_text"), "toxicity-figures")
    kinds = {r["_toxic"] for r in figures.select("_toxic").distinct().collect()}
    if kinds != {0, 1}:
        return Model(lexicon, [2.0, 0.0, 0.0, 0.0, 0.0], -3.0)
    rows = VectorAssembler(inputCols=["tox_" + f for f in FEATURES], outputCol="features").transform(figures)
    fitted = LogisticRegression(labelCol="_toxic", regParam=1e-4, maxIter=50).fit(rows)
    return Model(lexicon, [float(w) for w in fitted.coefficients], float(fitted.intercept))


def scored(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """Add the probability that a text is toxic."""
    prefix = "tox_"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix += "_"
    line = F.lit(model.bias)
    for name, weight in zip(FEATURES, model.weights):
        line = line + F.col(prefix + name) * weight
    kept = [F.col(f"`{c}`") for c in docs.columns if c != score]
    return with_clause_scores(docs, model.lexicon, text, prefix).select(*kept, (1 / (1 + F.exp(-line))).alias(score))
