"""Integrity checks of the warehouse (C1-C3), one result row per rule.

The warehouse files carry no constraints, so the declared ones are checked
by jobs: NOT NULL columns, primary and unique keys, and foreign keys.  Each
check is an aggregate (or an anti join feeding one); the rules are unioned
into one DataFrame ``(rule, violations)``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangar.schemas import FOREIGN_KEYS, PRIMARY_KEYS, UNIQUE_KEYS, WAREHOUSE_SCHEMAS


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def not_null_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Per NOT NULL column, the number of nulls (one scan per table)."""
    parts = []
    for name, df in tables.items():
        cols = [f.name for f in WAREHOUSE_SCHEMAS[name] if not f.nullable]
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        parts.append(
            counts.unpivot([], cols, "column", "violations").select(
                F.concat(F.lit(f"not_null:{name}."), F.col("column")).alias("rule"),
                F.col("violations").cast("bigint").alias("violations")))
    return _union(parts)


def key_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Per primary/unique key, the number of key values held by more
    than one row (aggregation on the key, map-side combined)."""
    parts = []
    for kind, keys in (("primary_key", PRIMARY_KEYS), ("unique", UNIQUE_KEYS)):
        for name, cols in keys.items():
            dup = tables[name].groupBy(*cols).count().where(F.col("count") > 1)
            parts.append(dup.agg(F.count(F.lit(1)).alias("violations")).select(
                F.lit(f"{kind}:{name}({','.join(cols)})").alias("rule"), "violations"))
    return _union(parts)


def reference_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Per foreign key, the number of fact rows without a parent row.

    The fact's rows are counted per key value first, so tasks send one row for each
    distinct key and the fact itself is never shuffled."""
    parts = []
    for name, refs in FOREIGN_KEYS.items():
        for col, parent in refs:
            orphans = tables[name].groupBy(col).agg(F.count(F.lit(1)).alias("_n")).join(
                tables[parent].select(col), col, "left_anti")
            parts.append(orphans.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
                F.lit(f"foreign_key:{name}.{col}->{parent}").alias("rule"), "violations"))
    return _union(parts)


ALL = (not_null_violations, key_violations, reference_violations)


def all_violations(tables: dict[str, DataFrame]) -> DataFrame:
    return _union([check(tables) for check in ALL])
