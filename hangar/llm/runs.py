"""Periodic run detection (operator 12).

Method: branching-tandem test on an enhanced suffix array.  The suffixes of the
words are sorted by doubling, with the common prefixes of neighbours; two words
are the same only within one text, so a batch of texts is one array.  Each
boundary inside an LCP interval (depth d) parts it in two; the suffixes i of the
smaller part look up the ranks of i + d and i - d, and if one lies in the other
part, a square of period d starts at the first of the two that cannot be moved to
the right.  Rotating it to the left as far as its period goes gives its run;
squares with the same end inside that run belong to it.  No tree is built, and
the smaller parts have n log n suffixes together.

A run: the smallest period q of a stretch of at least max(``LEAST``, 2 q) words
that no neighbour extends.  ``collapse`` drops the words of a run after its first q.

Defined cases: null texts are empty texts, without words or runs; very long texts
are a batch of their own; repeated rows each get their result; an empty table
gives an empty result.  In the query, a null id leaves the words as they are.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangar.llm.common import WORD, ship, table

#: Words of the shortest run; words that are sorted together (a longer text alone);
#: look-ups at a time.
LEAST, TOGETHER, LOOKUPS = 12, 200_000, 2_000_000

_WORD = re.compile(WORD)
#: White space of ``str.split`` that the contract counts as part of a word.
_ALSO = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")

Run = tuple[int, int, int]
Rewrite = Callable[[int | None, list[str]], list[str]]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text) if _ALSO.search(text) else text.split()


def suffix_array(symbols: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Sorted suffixes of an array of small numbers, and for each doubling the
    ranks by the first 1, 2, 4, ... symbols (equal prefixes have equal ranks)."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, dtype=np.int64)
    sorted_ = symbols[order]
    new = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, ahead = [rank.astype(np.int32)], 1
    while True:
        heads = np.append(new, True)
        slots = np.flatnonzero(~(heads[:-1] & heads[1:]))  # of groups that are not yet apart
        if not len(slots):
            return order, levels
        at = order[slots]
        beyond = at + ahead
        then = np.where(beyond < n, rank[np.minimum(beyond, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + then
        by = np.argsort(key, kind="stable")
        at, key = at[by], key[by]
        order[slots] = at
        apart = np.concatenate([[True], key[1:] != key[:-1]])
        new[slots] = apart
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(apart, slots, 0))
        levels.append(rank.astype(np.int32))
        ahead *= 2


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Of each suffix and the one before it in the order (0 for the first)."""
    n = len(order)
    lcp = np.zeros(n, dtype=np.int64)
    at = np.flatnonzero(levels[0][order[1:]] == levels[0][order[:-1]]) + 1
    a, b, found = order[at - 1].copy(), order[at].copy(), np.zeros(len(at), dtype=np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = np.maximum(a, b) < n
        same = inside & (levels[k][np.minimum(a, n - 1)] == levels[k][np.minimum(b, n - 1)])
        step = np.where(same, 1 << k, 0)
        a, b, found = a + step, b + step, found + step
    lcp[at] = found
    return lcp


def parted(lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Boundaries with a common prefix, and the first and last place of the
    interval that each one parts (of equal boundaries, the left one parts first)."""
    inner = np.flatnonzero(lcp > 0)
    low, high = [0] * len(inner), [0] * len(inner)
    stack: list[tuple[int, int]] = []  # (depth, boundary), deeper to the right
    begin, before, places = 0, -2, inner.tolist()
    for k, (place, depth) in enumerate(zip(places, lcp[inner].tolist())):
        if place != before + 1:  # nothing in common with what stands before
            for _, j in stack:
                high[j] = before
            stack, begin = [], place - 1
        while stack and stack[-1][0] > depth:
            high[stack.pop()[1]] = place - 1
        low[k] = places[stack[-1][1]] if stack else begin
        stack.append((depth, k))
        before = place
    for _, j in stack:
        high[j] = before
    return inner, np.array(low, dtype=np.int64), np.array(high, dtype=np.int64)


def squares(order: np.ndarray, lcp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and periods of the branching squares, a part at a time."""
    n = len(order)
    inner, low, high = parted(lcp)
    if not len(inner):
        return
    rank = np.empty(n, dtype=np.int64)
    rank[order] = np.arange(n)
    left = inner - low <= high - inner + 1
    begin, size = np.where(left, low, inner), np.where(left, inner - low, high - inner + 1)
    other_low, other_high = np.where(left, inner, low), np.where(left, high, inner - 1)
    ends = np.cumsum(size)
    at = 0
    while at < len(inner):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + LOOKUPS, "right")))
        own = np.repeat(np.arange(at, to), size[at:to])
        within = np.arange(len(own)) - np.repeat(ends[at:to] - size[at:to] - (ends[at - 1] if at else 0), size[at:to])
        i, d = order[begin[own] + within], lcp[inner[own]]
        for j in (i + d, i - d):
            ok = (j >= 0) & (j < n)
            r = rank[np.where(ok, j, 0)]
            hit = ok & (r >= other_low[own]) & (r <= other_high[own])
            yield np.minimum(i, j)[hit], d[hit]
        at = to


def runs(symbols: np.ndarray, least: int = LEAST) -> list[Run]:
    """start, length, period of every run, by start, then period."""
    if len(symbols) < 2:
        return []
    order, levels = suffix_array(symbols)
    lcp = common_prefixes(order, levels)
    del levels
    out: list[Run] = []
    reached: dict[int, int] = {}  # smallest start of the runs that end here
    parts = list(squares(order, lcp))
    start, period = (np.concatenate([p[k] for p in parts] or [np.empty(0, np.int64)]) for k in (0, 1))
    end = start + 2 * period
    short = 2 * period < least  # those must go on to the left for ``least`` words
    good = ~short | (end >= least)
    for back in range(1, least + 1):
        look = np.flatnonzero(good & short & (back > 2 * period))
        a = end[look] - back
        good[look] = symbols[a] == symbols[a + period[look]]
    start, period, end = start[good], period[good], end[good]
    for k in np.lexsort((period, end)).tolist():
        s, q, e = int(start[k]), int(period[k]), int(end[k])
        if reached.get(e, e) <= s:
            continue  # of a run with a period that divides this one
        s = rotated(symbols, s, q)
        reached[e] = min(s, reached.get(e, e))
        out.append((s, e - s, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def rotated(symbols: np.ndarray, s: int, q: int) -> int:
    """How far to the left a square of period q at s can be moved."""
    step = 16
    while s:
        k = min(step, s)
        differ = np.flatnonzero(symbols[s - k:s] != symbols[s - k + q:s + q])
        if len(differ):
            return s - k + int(differ[-1]) + 1
        s, step = s - k, step * 2
    return s


def runs_of_texts(texts: list[list[str]], least: int = LEAST) -> list[list[Run]]:
    """The runs of several texts, given as words, from one suffix array."""
    symbols, starts, base = [], [0], 0
    for words in texts:
        own: dict[str, int] = {}
        symbols.append(np.array([own.setdefault(w, len(own)) for w in words], dtype=np.int64) + base)
        base += len(own)
        starts.append(starts[-1] + len(words))
    out: list[list[Run]] = [[] for _ in texts]
    bounds = np.array(starts)
    for s, length, q in runs(np.concatenate(symbols) if symbols else np.empty(0, np.int64), least):
        k = int(np.searchsorted(bounds, s, "right")) - 1
        out[k].append((s - starts[k], length, q))
    return out


def collapse(words: list[str], found: list[Run]) -> list[str]:
    """The words without the repeats of the runs."""
    if not found:
        return words
    gone = np.zeros(len(words), dtype=bool)
    for s, length, q in found:
        gone[s + q:s + length] = True
    return [w for w, g in zip(words, gone.tolist()) if not g]


def batches_of(texts: Iterator[tuple], together: int = TOGETHER) -> Iterator[list[tuple]]:
    """(row, words) in lists of a bounded number of words (a longer text alone)."""
    batch, size = [], 0
    for row, words in texts:
        if batch and size + len(words) > together:
            yield batch
            batch, size = [], 0
        batch.append((row, words))
        size += len(words)
    if batch:
        yield batch


def find_runs(docs: DataFrame, rewrite: Rewrite | None = None, least: int = LEAST) -> DataFrame:
    """doc_id, runs (start, length, period) and collapsed text of every row of
    ``docs`` (doc_id, text); ``rewrite`` changes a text's words before the search."""
    ship(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches):
        def texts():
            for batch in batches:
                for k, text in enumerate(batch.column(1)):
                    doc_id, words = batch.column(0)[k], words_of(text.as_py() or "")
                    yield doc_id, rewrite(doc_id.as_py(), words) if rewrite else words

        for part in batches_of(texts()):
            found = runs_of_texts([w for _, w in part], least)
            yield pa.RecordBatch.from_arrays([
                pa.array([d.as_py() for d, _ in part], part[0][0].type),
                pa.array([[dict(zip(("start", "length", "period"), r)) for r in f] for f in found], pa.list_(run)),
                pa.array([" ".join(collapse(w, f)) for (_, w), f in zip(part, found)], pa.string())],
                names=["doc_id", "runs", "collapsed"])

    return docs.select("doc_id", "text").mapInArrow(
        work, f"doc_id {kind}, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The contract's change: in a tenth of the texts the words repeat from some word on."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]


def op12_periodic_runs(spark, sf_dir):
    """Runs and digests of every document after the contract's change."""
    found = find_runs(table(spark, sf_dir, "documents").select("doc_id", "text"), planted)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("down"))))
    lines = F.concat_ws("", F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return found.withColumn("m", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("m.back")).alias("start"), F.col("m.length").alias("length"),
        (-F.col("m.down")).alias("period"),
        F.expr("1000 * m.length div -m.down").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
