"""LM scoring (operator 9).

Method: log-frequency Bloom filter.  Counts of words and word pairs are
quantised on a log scale; a Bloom filter holds each n-gram once per level up to
its own, so its quantised count is the number of levels that probe as members.
The filter is cut into segments by n-gram hash, and neighbouring segments go
into waves of at most ``WAVE_BYTES``: what a worker holds is bounded, while the
filter itself grows with the corpus.  Segments are built where their n-grams
meet after a shuffle.  They stay there: the texts are dealt into chunks, each
chunk sends every n-gram it holds to that n-gram's wave once, and the wave sends
the levels back, so all waves are probed in one pass over the texts at any
size.  Probabilities come from the probed counts: a bigram estimate,
interpolated with a smoothed unigram estimate.

All words and all pairs of the training texts are stored, those seen once
included: segments, and with them waves, grow with the distinct n-grams.

The base score needs exact counts.  The ``HEAD`` most frequent words are
broadcast with their counts and levels; the others, none of which is more
frequent, meet their counts in their waves.  Words and pairs are told apart by
64-bit hashes.

Defined cases: a null text is empty and has one token, its end; a null doc_id
counts as the empty id; repeated rows count and score each; without training
rows all counts are 0 and scores use the smoothing alone; an empty table gives
an empty result; other columns are not looked at.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangar.llm.common import held_out, ship, staged, table

#: Most frequent words whose exact counts are broadcast, most bytes of filter per
#: wave, tokens that a task counts before it hands on, n-grams per segment.
HEAD, WAVE_BYTES, FLUSH, SEGMENT = 200_000, 96 << 20, 1_500_000, 1_000_000
#: Bytes of text that are taken for one token when texts are dealt into chunks
#: of about ``FLUSH`` tokens, n-grams that are probed together.
LETTERS, PROBED = 6, 1 << 16
#: Quantisation: level 1 + floor(log(count) / log(BASE)), at most TOP levels.
BASE, TOP = 2.0, 40
#: Filter bits per stored level (a power of two fits all), probes per level.
BITS, PROBES = 10, 4
MIX, ALPHA = 0.6, 0.1
TRAIN_MOD, TRAIN_OUT = 10, 0

_C = np.uint64(0x9E3779B97F4A7C15)
_D = np.uint64(0xC2B2AE3D27D4EB4F)
#: The end of a text, counted as a token: no word can hold a blank.
END = np.uint64(xxhash.xxh3_64_intdigest(b" "))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def settled(df: DataFrame, name: str) -> DataFrame:
    """``staged``; the shuffles that led to it go as soon as it is written (they
    would stay on the disks until the driver happens to collect its garbage)."""
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return staged(df, name)
    finally:
        if before is None:
            conf.unset(key)
        else:
            conf.set(key, before)


def tokens(text: str | bytes) -> np.ndarray:
    """Hashes of the words of a text (A-Z in lower case), and of its end."""
    text = text if isinstance(text, bytes) else text.encode()
    words = text.lower().split()  # bytes: ASCII case and white space only
    out = np.empty(len(words) + 1, dtype=np.uint64)
    out[:-1] = list(map(xxhash.xxh3_64_intdigest, words))
    out[-1] = END
    return out


def pairs(t: np.ndarray) -> np.ndarray:
    """A hash for each token with the one before it (the end of a text stands
    before its first, so texts may follow one another)."""
    before = np.concatenate([[END], t[:-1]])
    return mix(before * _C ^ mix(t + _D))


def distinct(grams: np.ndarray) -> np.ndarray:
    """Each once, in order (by a sort: ``np.unique`` takes a slower way for this)."""
    grams = np.sort(grams)
    return grams[np.concatenate([[True], grams[1:] != grams[:-1]])[:len(grams)]]


def level(count: np.ndarray) -> np.ndarray:
    """Quantised count: 1 + floor(log_BASE(count)), 0 for 0."""
    c = np.asarray(count, dtype=np.float64)
    return np.where(c > 0, np.minimum(1 + np.floor(np.log(np.maximum(c, 1)) / math.log(BASE)
                                                   + 1e-9), TOP), 0).astype(np.int64)


def spread(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the middle of its range, 0 for level 0."""
    lv = np.asarray(levels, dtype=np.float64)
    return np.where(lv > 0, (BASE ** (lv - 1) + np.maximum(BASE ** lv - 1, 1)) / 2, 0.0)


#: The counts that the levels stand for.
SPREAD = spread(np.arange(TOP + 1))


def spots(gram: np.ndarray, lv: int, bits: int) -> np.ndarray:
    """Bit positions, shape (PROBES, n), of n-grams at a level."""
    h = mix(gram + np.uint64(lv) * _D)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return np.array([((h + np.uint64(k) * step) & np.uint64(bits - 1)).astype(np.int64)
                     for k in range(PROBES)])


def build(grams: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Bloom bits (bytes) of a segment: each n-gram at all levels up to its own."""
    need = max(64, BITS * int(levels.sum()))
    bits = 1 << (need - 1).bit_length()
    out = np.zeros(bits, dtype=bool)
    for lv in range(1, int(levels.max(initial=0)) + 1):
        for at in spots(grams[levels >= lv], lv, bits):
            out[at] = True
    return np.packbits(out, bitorder="little")


def probe(bits: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Quantised counts: levels in turn until one is not a member."""
    out = np.zeros(len(grams), dtype=np.int64)
    live = np.arange(len(grams))
    size = len(bits) * 8
    for lv in range(1, TOP + 1):
        ok = np.ones(len(live), dtype=bool)
        for at in spots(grams[live], lv, size):
            ok &= (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        live = live[ok]
        if not len(live):
            break
        out[live] = lv
    return out


def segment_of(gram: np.ndarray, segments: int) -> np.ndarray:
    return ((mix(gram ^ _C) >> np.uint64(33)) % np.uint64(segments)).astype(np.int64)


def by_segment(grams: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of n-grams by segment, and where in it each segment begins."""
    seg = segment_of(grams, segments)
    cuts = np.concatenate([[0], np.cumsum(np.bincount(seg, minlength=segments))])
    small = segments <= 1 << 16  # short keys are sorted in linear time
    return np.argsort(seg.astype(np.uint16) if small else seg, kind="stable"), cuts


def count_grams(train: DataFrame, segments: int) -> DataFrame:
    """segment, words, pairs: for each segment the n-grams of a task with their
    counts, packed (hashes, then counts as 32-bit integers)."""
    def packed(values):
        grams, counts = np.unique(values, return_counts=True)
        order, cuts = by_segment(grams, segments)
        grams, counts = grams[order], counts[order].astype(np.uint32)
        return [(grams[a:b].tobytes(), counts[a:b].tobytes()) for a, b in zip(cuts, cuts[1:])]

    def flush(held):
        toks = np.concatenate(held)
        rows = [(s, *w, *p) for s, (w, p) in enumerate(zip(packed(toks), packed(pairs(toks))))
                if w[0] or p[0]]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.binary() if k else pa.int32()) for k, c in enumerate(zip(*rows))],
            names=["segment", "w", "wn", "p", "pn"])

    def run(batches):
        held, size = [], 0
        for batch in batches:
            for text in batch.column(0):
                held.append(tokens(text.as_py()))
                size += len(held[-1])
                if size >= FLUSH:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return train.select("text").mapInArrow(
        run, "segment int, w binary, wn binary, p binary, pn binary")


def _sum(keys, counts) -> tuple[np.ndarray, np.ndarray]:
    k = np.concatenate([np.frombuffer(x, np.uint64) for x in keys] or [np.zeros(0, np.uint64)])
    c = np.concatenate([np.frombuffer(x, np.uint32) for x in counts] or [np.zeros(0, np.uint32)])
    grams, at = np.unique(k, return_inverse=True)
    return grams, np.bincount(at, weights=c, minlength=len(grams)).astype(np.int64)


def merge(parts: DataFrame) -> DataFrame:
    """Per segment: its filter, its exact words with the levels that the filter
    gives them, and their totals."""
    def run(key, rows):
        cols = {n: rows.column(n).to_pylist() for n in ("w", "wn", "p", "pn")}
        words, n = _sum(cols["w"], cols["wn"])
        grams, m = _sum(cols["p"], cols["pn"])
        lw, lp = level(n), level(m)
        bits = build(np.concatenate([words, grams]), np.concatenate([lw, lp]))
        return pa.table({
            "segment": pa.array([key[0].as_py()], pa.int32()),
            "bits": pa.array([bits.tobytes()], pa.binary()),
            "words": pa.array([words.view(np.int64)], pa.list_(pa.int64())),
            "counts": pa.array([n], pa.list_(pa.int64())),
            "probed": pa.array([probe(bits, words)], pa.list_(pa.int8())),
            "tokens": pa.array([int(n.sum())], pa.int64()),
            "distinct": pa.array([len(words)], pa.int64()),
            "mass": pa.array([float(spread(lw).sum())], pa.float64()),
            "size": pa.array([len(bits)], pa.int64())})

    return parts.groupBy("segment").applyInArrow(
        run, "segment int, bits binary, words array<long>, counts array<long>, "
             "probed array<tinyint>, tokens long, distinct long, mass double, size long")


def train_model(train: DataFrame) -> tuple[DataFrame, dict]:
    """The staged segments and their totals."""
    ship(train.sparkSession)
    chars = train.agg(F.sum(F.length("text"))).first()[0] or 0
    segments = max(8, -(-int(chars) // 12 // SEGMENT))
    model = settled(merge(count_grams(train, segments)), "lm_model")
    t = model.agg(F.sum("tokens").alias("tokens"), F.sum("distinct").alias("distinct"),
                  F.sum("mass").alias("mass")).first()
    return model, {"tokens": int(t.tokens or 0), "distinct": int(t.distinct or 0),
                   "mass": float(t.mass or 0.0), "segments": segments}


def waves(model: DataFrame, most: int = WAVE_BYTES) -> list[list[int]]:
    """Segment numbers in groups whose filters fit ``most`` bytes together."""
    out, size = [], 0
    for r in model.select("segment", "size").orderBy("segment").toLocalIterator():
        if not out or size + r.size > most:
            out.append([])
            size = 0
        out[-1].append(r.segment)
        size += r.size
    return out


def most_frequent(model: DataFrame, head: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``head`` most frequent words in order, with their counts and levels."""
    exact = model.select(F.explode(F.arrays_zip("words", "counts", "probed")).alias("x")).select("x.*")
    top = exact.orderBy(F.desc("counts"), "words").limit(head).toArrow()  # at most ``head`` rows
    words, counts, probed = (top.column(c).to_numpy() for c in ("words", "counts", "probed"))
    order = np.argsort(words.view(np.uint64))
    return words.view(np.uint64)[order], counts[order], probed[order].astype(np.uint8)


def find(words: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``words`` are among the sorted ``known``, and where those stand there."""
    at = np.searchsorted(known, words)
    hit = at < len(known)
    hit[hit] = known[at[hit]] == words[hit]
    return hit, at[hit]


def chunked(docs: DataFrame) -> DataFrame:
    """chunk, ids, outs, sizes, texts: rows (doc_id, held_out, text) in chunks of
    about ``FLUSH`` tokens, the texts one after another and compressed."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def packed(chunk, held):
        rows = pa.Table.from_batches(held).combine_chunks()
        texts = [t.encode() for t in rows.column("text").to_pylist()]
        ids, outs = (pa.array(rows.column(c).to_pylist(), rows.column(c).type)
                     for c in ("doc_id", "held_out"))
        sizes = pa.array([len(t) for t in texts], pa.int64())
        ends = pa.array([0, len(texts)], pa.int32())
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), *(pa.ListArray.from_arrays(ends, c) for c in (ids, outs, sizes)),
             pa.array([pa.Codec("zstd", 3).compress(b"".join(texts), asbytes=True)], pa.binary())],
            names=["chunk", "ids", "outs", "sizes", "texts"])

    def run(batches):
        from pyspark import TaskContext
        chunk, held, size = TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            begun = 0
            for i, n in enumerate(pc.binary_length(batch.column("text")).to_pylist()):
                size += n // LETTERS + 1
                if size >= FLUSH:
                    yield packed(chunk, [*held, batch.slice(begun, i + 1 - begun)])
                    chunk, held, size, begun = chunk + 1, [], 0, i + 1
            if begun < batch.num_rows:
                held.append(batch.slice(begun))
        if held:
            yield packed(chunk, held)

    return docs.select("doc_id", "held_out", "text").mapInArrow(
        run, f"chunk long, ids array<{kind}>, outs array<boolean>, sizes array<long>, texts binary")


def unpacked(sizes: list[int], texts: bytes) -> list[np.ndarray]:
    """The tokens of each text of a chunk."""
    ends = np.cumsum(sizes).tolist()
    blob = pa.Codec("zstd").decompress(texts, ends[-1], asbytes=True)
    return [tokens(blob[end - n:end]) for n, end in zip(sizes, ends)]


def of_waves(grams: np.ndarray, starts: list[int], segments: int) -> list[np.ndarray]:
    """Where the n-grams of each wave stand (a wave ends where the next one begins)."""
    order, cuts = by_segment(grams, segments)
    return [order[cuts[a]:cuts[b]] for a, b in zip(starts, [*starts[1:], segments])]


def ask(texts: DataFrame, known, starts: list[int], segments: int) -> DataFrame:
    """chunk, wave, w, p: the words, but for the ``known`` ones, and the pairs of a
    chunk that belong to a wave, each once."""
    def run(batches):
        for batch in batches:
            for chunk, sizes, blob in zip(*(batch.column(c) for c in ("chunk", "sizes", "texts"))):
                toks = np.concatenate(unpacked(sizes.as_py(), blob.as_py()))
                words, grams = distinct(toks), distinct(pairs(toks))
                words = words[~find(words, known.value[0])[0]]
                cuts = zip(of_waves(words, starts, segments), of_waves(grams, starts, segments))
                rows = [(k, words[w].tobytes(), grams[p].tobytes())
                        for k, (w, p) in enumerate(cuts) if len(w) or len(p)]
                if rows:
                    numbers, w, p = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([chunk.as_py()] * len(rows), pa.int64()), pa.array(numbers, pa.int32()),
                         pa.array(w, pa.binary()), pa.array(p, pa.binary())],
                        names=["chunk", "wave", "w", "p"])

    return texts.select("chunk", "sizes", "texts").mapInArrow(
        run, "chunk long, wave int, w binary, p binary")


def levels_of(grams: np.ndarray, held: dict[int, np.ndarray], segments: int) -> np.ndarray:
    """A level for each n-gram: what the held segments know."""
    out = np.zeros(len(grams), np.uint8)
    order, cuts = by_segment(grams, segments)
    for s, bits in held.items():
        for a in range(cuts[s], cuts[s + 1], PROBED):
            at = order[a:min(a + PROBED, cuts[s + 1])]
            out[at] = probe(bits, grams[at])
    return out


def answer(asked: DataFrame, model: DataFrame, starts: list[int], segments: int) -> DataFrame:
    """chunk, wave, levels, counts: the levels of the words, then of the pairs, that
    a chunk asked a wave for, and the exact counts of the words."""
    spark = model.sparkSession
    ends = [*starts[1:], segments]
    place = spark.createDataFrame([(s, k) for k, (a, b) in enumerate(zip(starts, ends)) for s in range(a, b)],
                                  "segment int, wave int")
    filters = model.join(F.broadcast(place), "segment").select("wave", "segment", "bits", "words", "counts")

    def run(key, left, right):
        held = {s: np.frombuffer(bits.as_py(), np.uint8) for s, bits in
                zip(left.column("segment").to_pylist(), left.column("bits"))}
        words, counts = (c.combine_chunks().flatten().to_numpy(zero_copy_only=False)
                         for c in (left.column("words"), left.column("counts")))
        order = np.argsort(words.view(np.uint64))
        words, counts = words.view(np.uint64)[order], counts[order]
        out = {"levels": [], "counts": []}

        def say(rows):
            grams = levels_of(np.concatenate([x for row in rows for x in row]), held, segments)
            asked = np.concatenate([w for w, _ in rows])
            hit, at = find(asked, words)
            n = np.zeros(len(asked), np.int64)
            n[hit] = counts[at]
            for name, x, sizes in (("levels", grams, [len(w) + len(p) for w, p in rows]),
                                   ("counts", n, [len(w) for w, _ in rows])):
                out[name] += [part.tobytes() for part in np.split(x, np.cumsum(sizes)[:-1])]

        rows, size = [], 0
        for w, p in zip(right.column("w"), right.column("p")):
            rows.append(tuple(np.frombuffer(x.as_buffer(), np.uint64) for x in (w, p)))
            size += sum(map(len, rows[-1]))
            if size >= SEGMENT:
                say(rows)
                rows, size = [], 0
        if rows:
            say(rows)
        return pa.table({"chunk": right.column("chunk"), "wave": right.column("wave"),
                         **{n: pa.array(x, pa.binary()) for n, x in out.items()}})

    return filters.groupBy("wave").cogroup(asked.groupBy("wave")).applyInArrow(
        run, "chunk long, wave int, levels binary, counts binary")


def log_prob(w: np.ndarray, p: np.ndarray, total: dict) -> np.ndarray:
    """log10 probabilities of the tokens of texts that follow one another, from
    the levels of words and pairs."""
    cw, cp = SPREAD[w], SPREAD[p]
    before = np.concatenate([cw[-1:], cw[:-1]])  # the end stands before the first word
    uni = (cw + ALPHA) / (total["mass"] + ALPHA * (total["distinct"] + 1))
    bi = np.where(cp > 0, cp / np.maximum(np.maximum(before, cp), 1.0), 0.0)
    known = before > 0
    return np.log10(np.where(known, MIX * bi + (1 - MIX) * uni, uni))


def score(docs: DataFrame, model: DataFrame, total: dict, head: int = HEAD,
          wave: int = WAVE_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of rows
    (doc_id, held_out, text)."""
    spark = docs.sparkSession
    ship(spark)
    kind, segments = docs.schema["doc_id"].dataType.simpleString(), total["segments"]
    # As many waves as tasks of a shuffle at least, if there are as many segments.
    size = model.agg(F.sum("size")).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = waves(model, max(1, min(wave, size // tasks)))
    starts = [0, *(g[0] for g in groups[1:])]
    known = spark.sparkContext.broadcast(most_frequent(model, head))
    texts = settled(chunked(docs), "lm_texts")
    told = settled(answer(ask(texts, known, starts, segments), model, starts, segments), "lm_levels")
    floor = ALPHA, total["tokens"] + ALPHA * (total["distinct"] + 1)

    def run(key, left, right):
        ids, outs, sizes, blob = (left.column(c)[0] for c in ("ids", "outs", "sizes", "texts"))
        toks = unpacked(sizes.as_py(), blob.as_py())
        ends = np.cumsum([len(t) for t in toks])
        toks = np.concatenate(toks)
        words, at = np.unique(toks, return_inverse=True)
        grams, pair_at = np.unique(pairs(toks), return_inverse=True)
        word_levels, counts = np.zeros(len(words), np.uint8), np.zeros(len(words), np.int64)
        pair_levels = np.zeros(len(grams), np.uint8)
        hit, spot = find(words, known.value[0])
        counts[hit], word_levels[hit] = known.value[1][spot], known.value[2][spot]
        tail = np.flatnonzero(~hit)
        tail_of, grams_of = of_waves(words[tail], starts, segments), of_waves(grams, starts, segments)
        for k, lv, n in zip(*(right.column(c).to_pylist() for c in ("wave", "levels", "counts"))):
            w, p, lv = tail[tail_of[k]], grams_of[k], np.frombuffer(lv, np.uint8)
            word_levels[w], pair_levels[p] = lv[:len(w)], lv[len(w):]
            counts[w] = np.frombuffer(n, np.int64)
        base = np.log10((counts + floor[0]) / floor[1])[at]
        fits = log_prob(word_levels[at], pair_levels[pair_at], total)
        begins = np.concatenate([[0], ends[:-1]])
        sums = [[float(x[a:b].sum()) for a, b in zip(begins, ends)] for x in (base, fits)]
        return pa.table({
            "doc_id": ids.values, "held_out": outs.values,
            "n_tokens": pa.array(ends - begins, pa.int64()),
            "n_known": pa.array(np.add.reduceat((counts > 0)[at].astype(np.int64), begins), pa.int64()),
            "train_tokens": pa.array(np.full(len(ends), total["tokens"]), pa.int64()),
            "base_score": pa.array(sums[0], pa.float64()), "score": pa.array(sums[1], pa.float64())})

    out = texts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")
    return settled(out, "lm_scored")


def op9_lm_score(spark, sf_dir):
    """Exact unigram base score and model score of every document."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", held_out(F.col("doc_id"), TRAIN_MOD, TRAIN_OUT).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"))
    model, total = train_model(docs.where("NOT held_out"))
    return score(docs, model, total)
