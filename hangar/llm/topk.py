"""Exact top-k search (operator 7).

Method: Fagin's threshold algorithm.  Every dimension has a list of the rows
sorted by that component; a query reads the lists from the end that its own
component favours, all to the same depth.  Rows that come up are scored in full
(random access).  The best score that an unseen row can have is the inner
product of the query with the values at the current depth; when the kth score
found beats this threshold, nothing unseen can enter.  Depth doubles, so rows
are scored many at a time.

The stated queries meet all rows in blocks; a block has its own lists, is
searched in one task and hands on its k best, of which the k best of all are
the exact answer.  Components are floor(256 * x) as whole numbers; scores are
exact (Python integers where 64 bits might not do; a score beyond 64 bits is
kept at the limit of a long).

Defined cases: vectors that are null, empty, or hold null or non-finite
components take no part; a zero vector does; vectors meet those of their own
length; another row with the query's vec_id is not a candidate either; ties go
to the smaller vec_id; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from hangar.llm import vectors
from hangar.llm.common import ship, table

TOP, EVERY, SCALE = 5, 50, 256.0
#: Depth of the first round.
DEPTH = 8
#: Rows of a block, and the queries that meet it at a time: blocks spread over tasks, and
#: their copies in the shuffle grow with rows times queries / 4,096.
BLOCK, BATCH = 8_192, 8_192
_LONG = 2**63 - 1


def whole(x: np.ndarray) -> np.ndarray:
    """floor(256 * x): as float64 where the inner products of such vectors are
    exact in it, else as Python integers."""
    y = np.floor(x * SCALE)
    most = np.abs(y).max(initial=0.0)
    if not np.isfinite(most):  # beyond double: limit first, scores are at the limit anyway
        y = np.floor(np.clip(x, -1e300, 1e300) * SCALE)
    if most * most * max(x.shape[1], 1) < 2.0**53:
        return y
    return np.array([[int(v) for v in row] for row in y.tolist()], dtype=object).reshape(y.shape)


class Lists:
    """Sorted lists of a block, one per dimension."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids = x, ids
        self.order = np.argsort(x, axis=0, kind="stable")
        self.values = np.take_along_axis(x, self.order, 0)

    def top(self, q: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """ids and scores of the k best rows other than the query's own."""
        n, dim = self.x.shape
        lists = np.flatnonzero(q != 0)
        down = q[lists] > 0  # read from the largest value, or from the smallest
        seen = np.zeros(n, dtype=bool)
        best_ids, best = np.zeros(0, dtype=np.int64), self.x[:0, 0]
        depth, done = min(DEPTH, n), 0
        if not len(lists):
            depth = n
        while True:
            if depth >= n:
                new = np.flatnonzero(~seen)
            else:
                spots = np.where(down[None, :], n - 1 - np.arange(done, depth)[:, None],
                                 np.arange(done, depth)[:, None])
                rows = self.order[spots, lists[None, :]].reshape(-1)
                new = np.unique(rows[~seen[rows]])
            seen[new] = True
            new = new[self.ids[new] != own]
            ids = np.concatenate([best_ids, self.ids[new]])
            scores = np.concatenate([best, self.x[new] @ q])
            keep = np.lexsort((ids, -scores))[:k]
            best_ids, best = ids[keep], scores[keep]
            if depth >= n:
                return best_ids, best
            at = np.where(down, n - depth, depth - 1)
            threshold = (self.values[at, lists] * q[lists]).sum()
            if len(best) == k and best[-1] > threshold:  # a tie could have a smaller id
                return best_ids, best
            done, depth = depth, min(n, depth * 2)


def op7_search(rows: DataFrame, queries: DataFrame, top: int = TOP,
               block: int = BLOCK) -> DataFrame:
    """The ``top`` best rows of each query: query_id, rank, vec_id, score.  Both
    tables as from ``vectors.clean``."""
    ship(rows.sparkSession)

    def run(ids, x, qids, qs):
        both = whole(np.concatenate([x, qs]))
        lists = Lists(both[:len(x)], ids)
        for qid, q in zip(qids.tolist(), both[len(x):]):
            found, scores = lists.top(q, qid, top)
            yield qid, found, np.array([max(-_LONG - 1, min(_LONG, int(s))) for s in scores],
                                       dtype=np.int64)

    return vectors.search(rows, queries, top, "long", run, block, BATCH)


def op7_exact_topk(spark, sf_dir):
    """The 5 best of every row whose vec_id is divisible by 50."""
    rows = vectors.clean(table(spark, sf_dir, "embeddings"))
    return op7_search(rows, rows.where(vectors.divisible("vec_id", EVERY)))


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.w) = len(c.w)),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""
