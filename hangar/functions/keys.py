"""Surrogate keys and the broadcast of the calendar.

``ordered_ids`` numbers the rows of a deduplicated dimension 1..n in the order
of its natural key without a global single-partition window:

* rows are grouped by a *coarse, order-preserving* bucket of the key (the
  year of a date, a prefix of a code);
* per-bucket row counts become offsets with a running sum over the buckets
  (one row per bucket, so the only unpartitioned step is bounded by the
  bucket domain, not by the data);
* each row gets ``offset + row_number()`` inside its bucket, a window
  partitioned by the bucket.

The result equals ``row_number() OVER (ORDER BY key)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ordered_ids(
    df: DataFrame,
    id_col: str,
    order_cols: list[str],
    bucket: Column,
) -> DataFrame:
    """Append ``id_col`` (INT, 1..n) ordered by ``order_cols``.

    ``bucket`` must be monotone in the ordering (bucket(a) < bucket(b)
    implies a sorts before b) and have a small domain.
    """
    keyed = df.withColumn("_bucket", bucket)
    offsets = (
        keyed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_offset",
            F.coalesce(
                F.sum("_n").over(
                    Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ),
        )
        .select("_bucket", "_offset")
    )
    within = Window.partitionBy("_bucket").orderBy(*order_cols)
    # no hint: how many buckets there are depends on the keys, Spark knows the size
    return (
        keyed.join(offsets, "_bucket")
        .withColumn(id_col, (F.col("_offset") + F.row_number().over(within)).cast("int"))
        .drop("_bucket", "_offset")
    )


def extended_ids(
    known: DataFrame | None,
    keys: DataFrame,
    id_col: str,
    key_col: str,
    bucket: Column,
) -> DataFrame:
    """The key map (``id_col``, ``key_col``) after a refresh: insert if absent.

    ``known`` is the map of the last refresh (None before the first), ``keys`` the
    distinct keys of this one.  Known keys keep their ids, whether they occur again
    or not; new ones, found by an anti join, are numbered in key order from above
    the largest id that was ever given.
    """
    if known is None:
        return ordered_ids(keys, id_col, [key_col], bucket).select(id_col, key_col)
    top = known.agg(F.max(id_col)).first()[0] or 0  # one number
    new = ordered_ids(keys.join(known.select(key_col), key_col, "left_anti"), id_col, [key_col], bucket)
    return known.select(id_col, key_col).unionByName(
        new.select((F.col(id_col) + F.lit(top)).cast("int").alias(id_col), key_col))


def broadcast_calendar(dim: DataFrame) -> DataFrame:
    """Broadcast a table with at most one row per calendar day.

    Proven bound: DATE covers years 1..9999, so such a table has at most
    3,652,059 rows (about 60 MB for a few INT/DATE columns); warehouses
    hold a few thousand days.  Used for the date dimension."""
    return F.broadcast(dim)
