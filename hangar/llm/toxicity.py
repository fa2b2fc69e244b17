"""Toxicity (operator 5).

Method: weighted finite-state pattern grammar.  The lexicon writes a symbol and a
weight per word (insult, threat, target, negation, reported speech).  Transducers for
negation, reported speech and a target named before are composed into one machine that
reads a text from the left; the one for a target named after reads what that wrote from
the right.  So what is weighed is a matched clause ("you are a ...", "not a ...",
"X said that ...") and not a word by itself.  The insult class is learned: words and
stems that set labelled toxic documents apart, with their log odds as weights; a
logistic model weighs the kinds of clauses and gives the score.

Learning takes at most ``TRAIN_ROWS`` labelled ids, those with the smallest hash, and
one text of each, so the lexicon (at most ``LEXICON`` entries, broadcast) and
the training features (collected) are bounded whatever the input.  Every text
is scored whole.

Defined cases: null texts are empty texts, whose score is that of a text
without a match; labels that are null or have no id are not learned from; of
repeated labels the larger counts; without usable labels the seed words alone
have a weight; repeated rows are scored alike; an empty table gives an empty
result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hangar.llm.bpe import parts_of
from hangar.llm.common import held_out, ship, staged, table
from hangar.llm.transducers import Transducer, build, compose, tables

TRAIN_ROWS, LEXICON, STEMS = 20_000, 5_000, (4, 5, 6)
THRESHOLD = 0.3
#: Weight of a seed word that the labels say nothing about, and the largest weight.
SEED_WEIGHT, TOP_WEIGHT = 3.0, 8.0

#: Closed word classes in English, French, German and Spanish.
INSULTS = "idiot idiots moron morons imbecile scum worthless pathetic disgusting loser losers bastard bitch asshole".split()
THREATS = "kill murder strangle destroy".split()
TARGETS = "you your yourself he she they him them tu toi vous du dich ihr euch usted ustedes ellos".split()
NEGATIONS = "not never no nor neither without isn't aren't n't pas jamais ni nicht kein keine nie tampoco nunca".split()
REPORTS = "said says called calls quoted wrote claims claimed alleged dit disait sagte schrieb dijo dice".split()

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?")
TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.,;:!?\n|]")
#: How many words a negation reaches, and how far the target of an insult and of a threat may be.
NEGATION_REACH, TARGET_REACH, THREAT_REACH = 3, 4, 2
KINDS = ("plain", "targeted", "negated", "reported", "threat")

#: Symbols: a pause and the end of a clause, and for a word the kind of its match ("menace":
#: a threat whose target is not known yet) and its class (target, negation, report).
PAUSE, END = ("pause", ""), ("end", "")
READ = [PAUSE, END, *((kind, cls) for kind in ("", "plain") for cls in ("", "G", "N", "R")),
        ("menace", "")]
_CLASS = {w: c for c, words in (("G", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in words}


def negation(alphabet) -> Transducer:
    """Insults up to ``NEGATION_REACH`` words after a negation of their clause are negated."""
    def step(left, symbol):
        kind, cls = symbol
        if symbol in (PAUSE, END):
            return 0, symbol
        kind = "negated" if kind == "plain" and left else kind
        return NEGATION_REACH if cls == "N" else max(0, left - 1), (kind, cls)

    return build(0, alphabet, step)


def report(alphabet) -> Transducer:
    """Insults after a verb of saying are reported, pauses or not, to the end of the clause."""
    def step(said, symbol):
        kind, cls = symbol
        if symbol in (PAUSE, END):
            return said and symbol == PAUSE, symbol
        return said or cls == "R", ("reported" if kind == "plain" and said else kind, cls)

    return build(False, alphabet, step)


def target(alphabet, threats: bool) -> Transducer:
    """Insults up to ``TARGET_REACH`` words from a target of their clause are targeted; with
    ``threats`` a threat up to ``THREAT_REACH`` words from one is complete."""
    def step(left, symbol):
        kind, cls = symbol
        if symbol in (PAUSE, END):
            return 0, symbol
        if kind == "plain" and left:
            kind = "targeted"
        elif kind == "menace" and threats and left > TARGET_REACH - THREAT_REACH:
            kind = "threat"
        return TARGET_REACH if cls == "G" else max(0, left - 1), (kind, cls)

    return build(0, alphabet, step)


def clause_machines() -> tuple[Transducer, Transducer]:
    """The composed machine that reads from the left, and the one that reads from the right
    what the first wrote."""
    left = negation(READ)
    for machine, more in ((report, ()), (target, (False,))):
        left = compose(left, machine(sorted(left.writes()), *more))
    return left, target(sorted(left.writes()), True)


_LEFT, _RIGHT = clause_machines()
_BETWEEN, _WRITTEN = sorted(_LEFT.writes()), sorted(_RIGHT.writes())
_LEFT_ARCS, _RIGHT_ARCS = tables(_LEFT, READ, _BETWEEN), tables(_RIGHT, _BETWEEN, _WRITTEN)
#: Of each symbol written at last, the place of its kind in ``KINDS``, or -1.
_KIND = [KINDS.index(kind) if kind in KINDS else -1 for kind, _ in _WRITTEN]
_CODE = {symbol: i for i, symbol in enumerate(READ)}


class Grammar(NamedTuple):
    """Learned insults: weights of words and of stems (prefixes)."""

    words: dict[str, float]
    stems: dict[str, float]

    def insult(self, word: str) -> float:
        found = self.words.get(word, 0.0)
        for k in STEMS:
            if len(word) >= k:
                found = max(found, self.stems.get(word[:k], 0.0))
        return found


    def read(self, token: str) -> tuple[int, float]:
        """The lexicon's arc: number of the symbol in ``READ``, and its weight."""
        if len(token) == 1 and token in ".,;:!?\n|":
            return _CODE[PAUSE if token in ",:" else END], 0.0
        weight, cls = self.insult(token), _CLASS.get(token, "")
        if weight > 0:
            return _CODE["plain", cls], weight
        if token in THREATS:
            return _CODE["menace", ""], SEED_WEIGHT
        return _CODE["", cls], 0.0


def clauses(text: str, grammar: Grammar, known: dict[str, tuple[int, float]]) -> dict[str, float]:
    """Weights of the matched clauses of a lower-case text, summed by kind."""
    tape, weights, state = [], [], 0
    for token in TOKEN.findall(text):
        arc = known.get(token)
        if arc is None:
            arc = known[token] = grammar.read(token)
        state, written = _LEFT_ARCS[state][arc[0]]
        tape.append(written)
        weights.append(arc[1])
    total, state = [0.0] * len(KINDS), 0
    for i in range(len(tape) - 1, -1, -1):
        state, written = _RIGHT_ARCS[state][tape[i]]
        if weights[i] and _KIND[written] >= 0:
            total[_KIND[written]] += weights[i]
    return dict(zip(KINDS, total))


def features(texts: list[str], grammar: Grammar,
             known: dict[str, tuple[int, float]]) -> np.ndarray:
    """Per text, the damped clause weights by kind, and whether any insult matched."""
    out = np.zeros((len(texts), len(KINDS) + 1))
    for i, text in enumerate(texts):
        text = text.lower()
        hit = False
        for w in set(WORD.findall(text)):
            arc = known.get(w)
            if arc is None:
                arc = known[w] = grammar.read(w)
            hit = hit or arc[1] > 0
        if hit:
            found = clauses(text, grammar, known)
            out[i, :-1] = [math.log1p(found[k]) for k in KINDS]
            out[i, -1] = any(found[k] > 0 for k in KINDS[:4])
        if len(known) > 200_000:
            known.clear()
    return out


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """text and toxic of labelled documents outside the held-out part: of at most ``rows``
    ids, and of the texts of a repeated id the one with the least hash."""
    usable = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
              .where(~held_out(F.col("doc_id"), 4, 2))
              .groupBy(F.col("doc_id").alias("_id")).agg(F.max("toxic").alias("toxic")))
    taken = usable.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    # at most ``rows`` pairs of an id and a label
    return (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
            .join(F.broadcast(taken), F.col("doc_id") == F.col("_id"))
            .groupBy("_id").agg(
                F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"),
                F.max("toxic").cast("int").alias("toxic"))
            .select("text", "toxic"))


def count_words(train: DataFrame) -> DataFrame:
    """word, pos, neg: toxic and other documents that hold each word."""
    def run(batches):
        counts = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[y].update(set(WORD.findall(text.lower())))
        words = list(counts[1].keys() | counts[0].keys())
        for at in range(0, len(words), 50_000):
            part = words[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([
                pa.array(part), pa.array([counts[1][w] for w in part], pa.int64()),
                pa.array([counts[0][w] for w in part], pa.int64())], names=["word", "pos", "neg"])

    return (train.mapInArrow(run, "word string, pos long, neg long").groupBy("word")
            .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))


def learn_grammar(train: DataFrame, size: int = LEXICON) -> Grammar:
    """The words and stems that occur in toxic documents far more often than chance
    allows (log-likelihood ratio above the log of the number tried)."""
    n = train.groupBy("toxic").count().collect()
    pos_all, neg_all = (sum(r["count"] for r in n if r.toxic == y) for y in (1, 0))
    seeds = dict.fromkeys(INSULTS, SEED_WEIGHT)
    if not pos_all or not neg_all:
        return Grammar(seeds, {})
    words = staged(count_words(train), "toxic_words")
    stems = (words.select(F.explode(F.array(*[F.when(F.length("word") >= k, F.left("word", F.lit(k)))
                                              for k in STEMS])).alias("word"), "pos", "neg")
             .where("word IS NOT NULL").groupBy("word")
             .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")))
    share = pos_all / (pos_all + neg_all)
    out = []
    for counts in (words, stems):
        tried = counts.where("pos >= 2").count()
        total = F.col("pos") + F.col("neg")
        part = lambda c, p: F.when(c > 0, c * F.log(c / (total * F.lit(p)))).otherwise(F.lit(0.0))
        llr = part(F.col("pos"), share) + part(F.col("neg"), 1 - share)
        weight = (F.log((F.col("pos") + 0.5) / F.lit(pos_all + 1.0))
                  - F.log((F.col("neg") + 0.5) / F.lit(neg_all + 1.0)))
        top = (counts.where("pos >= 3").withColumn("llr", llr).withColumn("weight", weight)
               .where((F.col("llr") >= math.log(max(tried, 1)) + 2) & (F.col("weight") >= 2.5))
               .orderBy(F.desc("llr"), "word").limit(size).collect())
        out.append({r.word: min(TOP_WEIGHT, r.weight) for r in top})
    seen = {r.word: r for r in words.where(F.col("word").isin(INSULTS)).collect()}
    for w in seeds:  # what the labels say of a seed counts
        if w in seen:
            r = seen[w]
            seeds[w] = max(0.0, min(TOP_WEIGHT, math.log((r.pos + 1.5) / (pos_all + 1))
                                    - math.log((r.neg + 0.5) / (neg_all + 1))))
    return Grammar({**seeds, **out[0]}, out[1])


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 0.5, rounds: int = 50) -> np.ndarray:
    """Logistic regression by Newton steps, drawn towards a prior that trusts
    matches: intercept first."""
    prior = np.array([-3.0] + [0.5] * (len(KINDS)) + [2.0])
    if not len(y):
        return prior
    x1 = np.hstack([np.ones((len(x), 1)), x])
    w = prior.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x1 @ w, -30, 30)))
        step = np.linalg.solve((x1 * (p * (1 - p))[:, None]).T @ x1 + ridge * np.eye(len(w)),
                               x1.T @ (p - y) + ridge * (w - prior))
        w -= step * min(1.0, 4 / (np.abs(step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame) -> tuple[Grammar, np.ndarray]:
    """The grammar and the weights of the clause kinds."""
    ship(docs.sparkSession)
    train = staged(training_rows(docs, labels), "toxic_train")
    grammar = learn_grammar(train)
    own = docs.sparkSession.sparkContext.broadcast(grammar)

    def run(batches):
        known: dict[str, tuple[int, float]] = {}
        for batch in batches:
            x = features(batch.column(0).to_pylist(), own.value, known)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.list_(pa.float64())), batch.column(1)], names=["x", "y"])

    rows = train.mapInArrow(run, "x array<double>, y int").collect()  # at most TRAIN_ROWS
    x = np.array([r.x for r in rows]).reshape(len(rows), len(KINDS) + 1)
    return grammar, fit(x, np.array([r.y for r in rows], dtype=float))


def score(docs: DataFrame, grammar: Grammar, weights: np.ndarray) -> DataFrame:
    """Adds ``toxic_score`` to the rows of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    model = spark.sparkContext.broadcast((grammar, weights))
    columns = [c for c in docs.columns if c != "toxic_score"]
    rows = docs.select(F.struct(*columns).alias("row"),
                       F.coalesce("text", F.lit("")).alias("text"))
    schema = rows.schema["row"].dataType
    known: dict[str, tuple[int, float]] = {}

    def run(batches):
        g, w = model.value
        for batch in batches:
            for part in parts_of(batch):
                x = features(part.column(1).to_pylist(), g, known)
                z = np.clip(w[0] + x @ w[1:], -30, 30)
                yield pa.RecordBatch.from_arrays(
                    [*part.column(0).flatten(), pa.array(1 / (1 + np.exp(-z)))],
                    names=[*columns, "toxic_score"])

    return rows.mapInArrow(run, T.StructType(
        [*schema.fields, T.StructField("toxic_score", T.DoubleType())]))


def op5_toxicity(spark, sf_dir):
    """Score and prediction of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = learn(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return score(docs, *model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        F.col("toxic_score").alias("score"),
        (F.col("toxic_score") >= THRESHOLD).cast("int").alias("predicted"))
