"""Approximate nearest neighbours (operator 4).

Method: collision-counting hashing.  The largest inner product is a nearest
neighbour search once every vector gets one more component that brings it to
the length of the longest.  Each of ``PROJECTIONS`` random lines keeps the rows
sorted by their projection; the sorted array is cut into ``CELLS`` base buckets of
as many rows each (equal projections share one).  A query opens a window of
buckets around its own place on every line and widens the windows by virtual
rehashing; rows that fall into at least a share of the windows are verified by their
exact inner product.  It stops when there are enough of them; if there are more than
twice as many as asked for, it goes back within the last step.  The first width is
what some rows of the block needed.  Collisions are counted for ``TOGETHER`` queries at a time, from the bucket number
(one byte) of each row on each line.

The lines are drawn from a seed, nothing is fitted but the largest length (one
aggregate).  The stated queries meet all rows in blocks; a block has its own
sorted arrays, is searched in one task and hands on its best rows only.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part; a query is not its own candidate, but another row with
the same vec_id counts as the query's own; ties go to the smaller vec_id; if
there are fewer candidates than asked for, all are found (a block then verifies
every row); an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangar.llm import vectors
from hangar.llm.common import ship, table

TOP, EVERY, SEED = 20, 20, 11
#: Lines, base buckets of a line, half-width of the first windows, and the share of
#: windows that makes a candidate.
PROJECTIONS, CELLS, FIRST, SHARE = 128, 256, 16, 0.6
#: Rows to verify before a query stops: a share of the block, and a least number.
ENOUGH, LEAST = 0.08, 400
#: Rows of a block and queries that meet it: as many, which copies the fewest rows;
#: queries whose collisions are counted at the same time.
BLOCK, BATCH, TOGETHER = 8_192, 8_192, 32


def exact(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, term by term (the same for a row
    whatever other rows are asked for)."""
    return np.einsum("ij,j->i", x, q)


class Index:
    """Sorted projections of a block of rows."""

    def __init__(self, x: np.ndarray, longest: float, lines: int = PROJECTIONS, seed: int = SEED):
        n, dim = x.shape
        self.x, self.lines, self.n = x, lines, n
        self.first, self.fitted = FIRST, False
        self.a = np.random.default_rng([seed, dim]).standard_normal((lines, dim + 1))
        unit = x / longest
        rest = np.sqrt(np.maximum(0.0, 1.0 - np.einsum("ij,ij->i", unit, unit)))
        p = self.a[:, :-1] @ unit.T + self.a[:, -1:] * rest
        self.sorted = np.sort(p, axis=1)
        # equal projections have the place of the first of them
        self.cell = np.empty((lines, n), dtype=np.uint8)
        for k in range(lines):
            self.cell[k] = self._cell(np.searchsorted(self.sorted[k], p[k], "left"))

    def _cell(self, place: np.ndarray) -> np.ndarray:
        return np.minimum(place, self.n - 1) * CELLS // self.n

    def collisions(self, first: np.ndarray, last: np.ndarray, width: np.ndarray) -> np.ndarray:
        """Windows (buckets first - width to last + width, by line and query) that hold
        each row: queries x rows."""
        low = np.maximum(first - width, 0)
        size = (np.minimum(last + width, CELLS - 1) - low).astype(np.uint8)
        low = low.astype(np.uint8)
        count = np.zeros((len(width), self.n), dtype=np.uint8)
        away, inside = np.empty_like(count), np.empty(count.shape, dtype=bool)
        for k in range(self.lines):
            # a bucket below the window wraps around to a large distance
            np.subtract(self.cell[k], low[k][:, None], out=away)
            np.less_equal(away, size[k][:, None], out=inside)
            np.add(count, inside.view(np.uint8), out=count)
        return count

    def candidates(self, queries: np.ndarray, need: int, share: float = SHARE) -> tuple[list[np.ndarray], np.ndarray]:
        """For each query, the rows that collide with it on enough lines (at least
        ``need``, or all rows), and the width that gave them."""
        n, m = self.n, len(queries)
        if n <= need:
            return [np.arange(n)] * m, np.full(m, CELLS)
        unit = queries / np.sqrt(np.einsum("ij,ij->i", queries, queries))[:, None]
        own = self.a[:, :-1] @ unit.T
        slack = 1e-9 * (1 + np.abs(own))  # a projection may be off in its last places
        first, last = (np.empty(own.shape, dtype=np.int64) for _ in range(2))
        for k in range(self.lines):
            first[k] = self._cell(np.searchsorted(self.sorted[k], own[k] - slack[k], "left"))
            last[k] = self._cell(np.searchsorted(self.sorted[k], own[k] + slack[k], "right"))
        goal = int(np.ceil(share * self.lines))
        out: list[np.ndarray] = [np.arange(n)] * m
        # widths known to be too small and to be enough (windows of all buckets are)
        low, high = np.zeros(m, dtype=np.int64), np.full(m, 2 * CELLS, dtype=np.int64)
        width, open_ = np.full(m, self.first, dtype=np.int64), np.arange(m)
        while len(open_):
            hit = self.collisions(first[:, open_], last[:, open_], width[open_]) >= goal
            found = np.count_nonzero(hit, axis=1)
            enough = found >= need
            for row, q in zip(hit[enough], open_[enough].tolist()):
                out[q] = np.flatnonzero(row)
            high[open_[enough]], low[open_[~enough]] = width[open_[enough]], width[open_[~enough]]
            open_ = open_[(~enough | (found > 2 * need)) & (high[open_] - low[open_] > np.maximum(1, high[open_] // 8))]
            a, b = low[open_], high[open_]
            # virtual rehashing: half as wide again, then half way between too small and enough
            width[open_] = np.where(b > CELLS, np.minimum(a * 3 // 2 + 1, CELLS), np.where(a == 0, b * 2 // 3, (a + b) // 2))
        return out, high

    def search(self, queries: np.ndarray, need: int) -> list[np.ndarray]:
        """``candidates`` with the first width that the block calls for."""
        if not self.fitted and self.n > need:
            some = self.x[np.linspace(0, self.n - 1, TOGETHER).astype(np.int64)]
            self.first, self.fitted = int(np.median(self.candidates(some, need)[1])), True
        return self.candidates(queries, need)[0]


def op4_search(rows: DataFrame, queries: DataFrame, top: int = TOP, block: int = BLOCK,
               enough: float = ENOUGH, least: int = LEAST, batch: int = BATCH) -> DataFrame:
    """The ``top`` rows found for each query: query_id, rank, vec_id, score.  Both
    tables as from ``vectors.clean``."""
    ship(rows.sparkSession)
    longest = rows.agg(F.max(F.aggregate(
        "v", F.lit(0.0), lambda s, x: s + x * x))).first()[0]
    longest = float(np.sqrt(longest)) if longest else 1.0

    def run(ids, x, qids, qs):
        index = Index(x, longest)
        need = max(least, int(enough * len(x)))
        for begin in range(0, len(qs), TOGETHER):
            part = slice(begin, begin + TOGETHER)
            for qid, q, at in zip(qids[part].tolist(), qs[part], index.search(qs[part], need)):
                at = at[ids[at] != qid]
                scores = exact(x[at], q)
                order = np.lexsort((ids[at], -scores))[:top]
                yield qid, ids[at][order], scores[order]

    return vectors.search(rows, queries, top, "double", run, block, batch)


def op4_ann(spark, sf_dir):
    """The 20 nearest found of every row whose vec_id is divisible by 20."""
    rows = vectors.clean(table(spark, sf_dir, "embeddings")).where(
        F.exists("v", lambda x: x != 0))
    return op4_search(rows, rows.where(vectors.divisible("vec_id", EVERY)))
