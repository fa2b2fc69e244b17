"""Helpers of the vector searches: clean vectors, blocks of rows, block merge."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a block that is searched as a whole (64 dimensions: 32 MB), and the
#: queries that meet it at a time.
BLOCK, QUERIES = 65_536, 2_048


def clean(rows: DataFrame) -> DataFrame:
    """vec_id and v (array of double) of the vectors that take part: not null, not
    empty, without null or non-finite components.  A null vec_id takes no part."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    odd = F.exists("v", lambda x: x.isNull() | F.isnan(x)
                   | (F.abs(x) == F.lit(float("inf"))))
    return (rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
            .where((F.size("v") > 0) & ~F.coalesce(odd, F.lit(False))))


def blocks(rows: DataFrame, number: int, label: str) -> DataFrame:
    """Rows with a block number by hash of their id, so that no value of a vector
    can fill a block."""
    return rows.withColumn(label, F.pmod(F.xxhash64("vec_id"), F.lit(number)).cast("int"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dim)


def search(rows: DataFrame, queries: DataFrame, top: int, score: str,
           run: Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], Iterator],
           block: int = BLOCK, batch: int = QUERIES) -> DataFrame:
    """The stated queries against all rows, in blocks.

    Vectors meet those of their own length.  Each pair of a query block and a
    row block is one task's work: ``run(ids, vectors, query ids, query vectors)``
    yields (query id, ids, scores) with the block's best for each query, and
    the best of all blocks are kept (``top`` per query, ties to smaller ids).
    """
    sized = rows.withColumn("dim", F.size("v"))
    asked = queries.withColumn("dim", F.size("v"))
    n, m = sized.count(), asked.count()
    if not n or not m:
        return rows.sparkSession.createDataFrame(
            [], f"query_id long, rank int, vec_id long, score {score}")
    nb, nq = -(-n // block), -(-m // batch)
    # every block of rows once per query block, and the other way round
    left = blocks(sized, nb, "rb").withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    right = blocks(asked, nq, "qb").withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(nb - 1))))
    keys = ("dim", "rb", "qb")
    schema = f"query_id long, vec_id long, score {score}"
    kind = pa.float64() if score == "double" else pa.int64()

    def meet(key, mine, theirs):
        dim = key[0].as_py()
        x, q = (matrix(t.column("v").combine_chunks(), dim) for t in (mine, theirs))
        ids, qids = (np.asarray(t.column("vec_id")) for t in (mine, theirs))
        out = ([], [], [])
        for qid, found, scores in run(ids, x, qids, q) if len(ids) and len(qids) else ():
            out[0].append(np.full(len(found), qid, dtype=np.int64))
            out[1].append(found)
            out[2].append(scores)
        cat = lambda a, t: pa.array(np.concatenate(a) if a else [], t)
        return pa.table([cat(out[0], pa.int64()), cat(out[1], pa.int64()), cat(out[2], kind)],
                        names=["query_id", "vec_id", "score"])

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top).select(
        "query_id", "rank", "vec_id", "score")


def divisible(column: str, by: int) -> Column:
    return F.col(column) % by == 0
