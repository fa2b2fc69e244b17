"""Quality classifier (operator 11).

Method: a factorisation machine.  A text becomes a sparse vector of hashed words
(``WORDS`` buckets, damped counts of length 1), structure statistics (shares of
capitals, digits, symbols, repeated words and lines, ... each in ``STEPS`` steps)
and metadata (the stated columns: numbers by their order of magnitude, anything
else hashed).  Next to a weight, every feature has a vector of ``RANK`` numbers;
any two features of a text interact by the inner product of their vectors.  All
pairs are summed in time linear in the text's features: half of the square of
the summed vectors less the sum of the squared ones.

Learning takes at most ``TRAIN_ROWS`` labelled ids, those with the smallest hash,
one text per id.  Their features are staged; a round trains one model per shard
(``SHARDS``, by hash; stochastic gradients, in one task each) from the last
round's average, and averages them again, so the driver holds nothing but models
of a fixed size.  Every text is scored whole.

Defined cases: null texts are empty texts, which have structure and metadata and
no words; labels that are null or have no id are not learned from; of repeated
labels the larger counts, of repeated ids the text with the smallest hash;
metadata that is null or not in the table is a feature of its own; without labels
of both kinds the score is the mean label (1/2 without any); repeated rows are
scored alike; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from operator import eq
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hangar.llm.bpe import parts_of
from hangar.llm.common import held_out, ship, staged, table

TRAIN_ROWS, SHARDS, ROUNDS = 20_000, 16, 6
#: Gradient steps of a task in a round (whole passes).
STEPS_AT_LEAST = 78
#: Buckets of words and of metadata, steps of a statistic, length of a feature's vector.
WORDS, METADATA, STEPS, RANK = 16_384, 256, 24, 8
#: Size of a gradient step, of its batch, pull towards 0, spread of the first vectors.
RATE, BATCH, DECAY, SPREAD, SEED = 0.3, 16, 1e-4, 0.05, 17
THRESHOLD = 0.7
STATISTICS = ("length", "words", "capitals", "digits", "symbols", "stops", "breaks", "spaces",
              "others", "word_length", "distinct", "commonest", "doubled", "line_length",
              "repeated_lines")
SIZE = WORDS + len(STATISTICS) * STEPS + METADATA

#: Kinds of Latin-1 characters: lower case, capital, digit, symbol, stop, line break, space.
_KINDS = bytes(5 if c == "\n" else 6 if c.isspace() else 2 if c.isdigit() else 1 if c.isupper()
               else 0 if c.isalpha() else 4 if c in ".,;:'\"()-?!" else 3 for c in map(chr, range(256)))


class Model(NamedTuple):
    """Bias, weights and vectors of the features; ``constant`` is the score of a
    model that had no two kinds of labels to learn from."""

    bias: float
    weights: np.ndarray
    vectors: np.ndarray
    constant: float | None = None


def statistics(text: str, sequence: list[bytes], counts: Counter) -> list[float]:
    """One number from 0 to 1 for each of ``STATISTICS``."""
    n = len(text)
    latin = text.encode("latin-1", "ignore").translate(_KINDS)
    kind = [latin.count(k) / (n or 1) for k in range(7)] + [(n - len(latin)) / (n or 1)]
    words, letters = counts.total(), n * (kind[0] + kind[1] + kind[7])
    lines = [x for x in text.split("\n") if x]
    log = lambda x, most: min(1.0, math.log2(1 + x) / most)
    part = lambda x, of: x / of if of else 0.0
    return [log(n, 20), log(words, 18), part(n * kind[1], letters), *kind[2:],
            log(part(letters, words), 6), part(len(counts), words),
            part(max(counts.values(), default=0), words),
            part(sum(map(eq, sequence, sequence[1:])), words),
            log(part(n, len(lines)), 16), 1 - part(len(set(lines)), len(lines) or 1) if lines else 0.0]


def features(text: str, meta: list[str]) -> tuple[list[int], list[float]]:
    """Numbers and values of a text's features; words that share a bucket add up."""
    sequence = text.lower().encode("utf-8", "surrogatepass").split()
    counts = Counter(sequence)
    hashed = np.fromiter(map(zlib.crc32, counts), dtype=np.int64, count=len(counts)) % WORDS
    times = np.fromiter(counts.values(), dtype=float, count=len(counts))
    own, back = np.unique(hashed, return_inverse=True)
    sums = np.bincount(back, 1 + np.log(times), minlength=len(own))
    at, values = own.tolist(), (sums / (math.sqrt(float(sums @ sums)) or 1.0)).tolist()
    # statistics in even steps of their square root: small shares tell the most
    at += [WORDS + k * STEPS + min(STEPS - 1, int(STEPS * math.sqrt(max(0.0, x))))
           for k, x in enumerate(statistics(text, sequence, counts))]
    first = WORDS + len(STATISTICS) * STEPS
    at += [first + zlib.crc32(f"{k}={m}".encode("utf-8", "surrogatepass")) % METADATA
           for k, m in enumerate(meta)]
    values += [0.3] * (len(STATISTICS) + len(meta))
    return at, values


def interactions(model: Model, at: np.ndarray, x: np.ndarray, starts: np.ndarray):
    """Per text (``starts``: first feature of each): the machine's value, and the
    summed vectors that its gradient needs again."""
    vx = model.vectors[at] * x[:, None]
    total = np.add.reduceat(vx, starts)
    pairs = 0.5 * (np.einsum("ij,ij->i", total, total)
                   - np.add.reduceat(np.einsum("ij,ij->i", vx, vx), starts))
    return model.bias + np.add.reduceat(model.weights[at] * x, starts) + pairs, total


def train(model: Model, rows: list[tuple[np.ndarray, np.ndarray, float]]) -> Model:
    """One pass of gradient steps (each coordinate's step shrinks with its gradients so far)."""
    bias, w, v = model.bias, model.weights.copy(), model.vectors.copy()
    gw, gv, gb = np.full(len(w), 1e-2), np.full(v.shape, 1e-2), 1e-2
    for begin in range(0, len(rows), BATCH):
        batch = rows[begin:begin + BATCH]
        sizes = np.array([len(a) for a, _, _ in batch])
        at, x = (np.concatenate([r[k] for r in batch]) for k in (0, 1))
        starts, of = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(batch)), sizes)
        value, total = interactions(Model(bias, w, v), at, x, starts)
        error = 1 / (1 + np.exp(-np.clip(value, -30, 30))) - np.array([y for _, _, y in batch])
        e = error[of] * x
        own, back = np.unique(at, return_inverse=True)
        dw = np.bincount(back, e, minlength=len(own)) + DECAY * w[own]
        each = e[:, None] * (total[of] - v[at] * x[:, None])
        dv = np.stack([np.bincount(back, each[:, k], minlength=len(own)) for k in range(v.shape[1])], 1)
        dv += DECAY * v[own]
        gw[own] += dw * dw
        gv[own] += dv * dv
        w[own] -= RATE * dw / np.sqrt(gw[own])
        v[own] -= RATE * dv / np.sqrt(gv[own]) / 3
        gb += error.sum() ** 2
        bias -= RATE * error.sum() / math.sqrt(gb)
    return Model(bias, w, v)


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """_id, text, meta and label of at most ``rows`` labelled ids outside the held-out part."""
    taken = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .where(~held_out(F.col("doc_id"), 4, 2))
             .groupBy(F.col("doc_id").alias("_id")).agg(F.max("quality").cast("double").alias("y"))
             .orderBy(F.xxhash64("_id"), "_id").limit(rows))
    # at most ``rows`` pairs of an id and a label are broadcast; one row per id is left
    return (docs.join(F.broadcast(taken), F.col("doc_id") == F.col("_id"))
            .groupBy("_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "meta")).alias("d"),
                                F.max("y").alias("y"))
            .select("_id", F.col("d.text").alias("text"), F.col("d.meta").alias("meta"), "y"))


def with_meta(docs: DataFrame, metadata: tuple[str, ...]) -> tuple[Column, Column]:
    """The text, and the metadata as an array of texts: a number by its power of two."""
    def level(name):
        if name not in docs.columns:
            return F.lit("none")
        c = F.col(name)
        if isinstance(docs.schema[name].dataType, T.NumericType):
            c = F.when(c > 0, F.floor(F.log2(c.cast("double")))).otherwise(F.lit(-1))
        return F.coalesce(c.cast("string"), F.lit("null"))

    meta = F.array(*[level(m) for m in metadata]) if metadata else F.array().cast("array<string>")
    return F.coalesce("text", F.lit("")).alias("text"), meta.alias("meta")


def _round(last, number: int):
    """One task's part of a round: a shard's model, from the broadcast one."""
    def run(shard):
        shard = shard.sort_by("_id")
        mine = [(np.array(a, dtype=np.int64), np.array(x, dtype=float), y) for a, x, y in zip(
            shard.column("at").to_numpy(), shard.column("x").to_numpy(), shard.column("y").to_pylist())]
        passes = -(-STEPS_AT_LEAST // -(-len(mine) // BATCH))
        draw = np.random.default_rng([SEED, number])
        out = train(last.value, [mine[i] for _ in range(passes) for i in draw.permutation(len(mine))])
        blob = np.concatenate([[out.bias], out.weights, out.vectors.ravel()]).astype(np.float32)
        return pa.table({"shard": shard.column("shard").slice(0, 1), "n": [len(mine)],
                         "model": pa.array([blob.tobytes()], pa.binary())})

    return run


def learn(docs: DataFrame, labels: DataFrame, metadata: tuple[str, ...] = ("n_chars",)) -> Model:
    """The machine of labelled documents."""
    spark = docs.sparkSession
    ship(spark)

    def vectors(batches):
        for batch in batches:
            for part in parts_of(batch):
                found = [features(t, m) for t, m in
                         zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(3), pa.array([f[0] for f in found], pa.list_(pa.int32())),
                     pa.array([f[1] for f in found], pa.list_(pa.float32()))],
                    names=["_id", "y", "at", "x"])

    rows = training_rows(docs.select("doc_id", *with_meta(docs, metadata)), labels)
    found = staged(rows.mapInArrow(vectors, "_id long, y double, at array<int>, x array<float>")
                   .withColumn("shard", F.pmod(F.xxhash64(F.lit(SEED), "_id"), F.lit(SHARDS))),
                   "quality_train")
    seen = found.agg(F.count("*").alias("n"), F.sum("y").alias("ones")).first()
    draw = np.random.default_rng(SEED)
    model = Model(0.0, np.zeros(SIZE), draw.normal(0, SPREAD, (SIZE, RANK)))
    if not seen.n or seen.ones in (0, seen.n):
        return model._replace(constant=seen.ones / seen.n if seen.n else 0.5)
    for k in range(ROUNDS):
        last = spark.sparkContext.broadcast(model)
        # a stated number of partitions, or few shards' worth of bytes would share a task
        parts = found.repartition(SHARDS, "shard").groupBy("shard").applyInArrow(
            _round(last, k), "shard long, n long, model binary").collect()  # SHARDS models of a fixed size
        parts.sort(key=lambda r: r.shard)
        share = np.array([r.n for r in parts], dtype=float) / sum(r.n for r in parts)
        flat = sum(s * np.frombuffer(r.model, np.float32).astype(float) for s, r in zip(share, parts))
        model = Model(float(flat[0]), flat[1:SIZE + 1], flat[SIZE + 1:].reshape(SIZE, RANK))
        last.unpersist()
    return model


def predict(model: Model, found: list[tuple[list[int], list[float]]]) -> np.ndarray:
    """Scores of texts given as their features."""
    if model.constant is not None or not found:
        return np.full(len(found), 0.5 if model.constant is None else model.constant)
    sizes = [len(a) for a, _ in found]
    at = np.fromiter((i for a, _ in found for i in a), dtype=np.int64, count=sum(sizes))
    x = np.fromiter((v for _, xs in found for v in xs), dtype=float, count=sum(sizes))
    value, _ = interactions(model, at, x, np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64))
    return 1 / (1 + np.exp(-np.clip(value, -30, 30)))


def score(docs: DataFrame, model: Model, metadata: tuple[str, ...] = ("n_chars",)) -> DataFrame:
    """Adds ``quality_score`` to the rows of ``docs``."""
    spark = docs.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)  # of a fixed size
    columns = [c for c in docs.columns if c != "quality_score"]
    rows = docs.select(F.struct(*columns).alias("row"), *with_meta(docs, metadata))
    kind = rows.schema["row"].dataType

    def run(batches):
        for batch in batches:
            for part in parts_of(batch):
                found = [features(t, m) for t, m in
                         zip(part.column(1).to_pylist(), part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [*part.column(0).flatten(), pa.array(predict(shared.value, found), pa.float64())],
                    names=[*columns, "quality_score"])

    return rows.mapInArrow(run, T.StructType(
        [*kind.fields, T.StructField("quality_score", T.DoubleType())]))


def op11_quality_fm(spark, sf_dir):
    """Score and prediction of every document; the metadata is n_chars."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = learn(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return score(docs, model).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
