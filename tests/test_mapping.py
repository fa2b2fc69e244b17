"""Registrations and times of the mapped sources: cheap expressions, the same values."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from hangar.sources import driver_views


@pytest.mark.parametrize("n,want", [(None, None), (0, "XY-000"), (7, "XY-007"), (999, "XY-999"),
                                    (12345, "XY-12345"), (-5, "XY--05"), (-1234, "XY--1234")])
def test_padded_numbers(spark, n, want):
    row = spark.createDataFrame([(n,)], "n bigint").select(
        driver_views._padded("XY-", F.col("n"), 3).alias("new"),
        F.when(F.col("n").isNotNull(), F.format_string("XY-%03d", F.col("n"))).alias("old")).first()
    assert row.new == row.old == want


@pytest.mark.parametrize("minutes", [None, -60, 0, 1439, driver_views.FAR_FUTURE_MINUTES])
def test_minutes(spark, minutes):
    row = spark.createDataFrame([(minutes,)], "m int").selectExpr(
        "m", "timestamp_ntz '1996-02-29 23:59:00' t").select(
        (F.col("t") + driver_views._minutes(F.col("m"))).alias("new"),
        (F.col("t") + F.make_dt_interval(mins=F.col("m"))).alias("old")).first()
    assert row.new == row.old
