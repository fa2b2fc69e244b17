"""Randomised equivalence checks of the scale-oriented rewrites.

* the bucketed overlap rule (day / hour buckets stitched by a summary)
  equals a plain per-aircraft ``lead`` window;
* the union form of the daily fact equals the full-outer-join form.
"""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from hangar.operators import facts, quality
from hangar.schemas import FLIGHTS

BASE = dt.datetime(2024, 3, 30)

minutes = st.integers(min_value=0, max_value=6 * 24 * 60)
flight_rows = st.lists(
    st.tuples(
        st.sampled_from(["XY-001", "XY-002", None]),
        st.booleans(),
        st.one_of(st.none(), minutes),                       # departure offset
        st.one_of(st.none(), st.integers(0, 4 * 24 * 60)),   # duration (up to 4 days)
        st.integers(0, 6 * 24 * 60),                         # scheduled departure offset
    ),
    min_size=1, max_size=40)

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _rows(spec):
    out = []
    for reg, cancelled, dep, dur, sdep in spec:
        d = None if dep is None else BASE + dt.timedelta(minutes=dep)
        a = None if d is None or dur is None else d + dt.timedelta(minutes=dur)
        s = BASE + dt.timedelta(minutes=sdep)
        out.append((reg, cancelled, d, a, s, s + dt.timedelta(hours=2)))
    return out


def _naive(df):
    flown = F.coalesce(~F.col("cancelled") & F.col("aircraftregistration").isNotNull()
                       & F.col("actualdeparture").isNotNull(), F.lit(False))
    w = Window.partitionBy("aircraftregistration").orderBy(*quality.flight_order())
    nxt = F.when(flown, F.lead("actualdeparture").over(w))
    return df.withColumn("_p", flown).withColumn(
        "overlaps", F.coalesce(F.col("_p") & (F.col("actualarrival") > nxt), F.lit(False))
    ).drop("_p")


@SETTINGS
@given(flight_rows)
def test_bucketed_overlap_equals_plain_window(spark, spec):
    df = spark.createDataFrame(_rows(spec), FLIGHTS)
    # the plain window must only see flown flights, like the rule
    flown = df.where(F.coalesce(~F.col("cancelled") & F.col("aircraftregistration").isNotNull()
                                & F.col("actualdeparture").isNotNull(), F.lit(False)))
    rest = df.exceptAll(flown).withColumn("overlaps", F.lit(False))
    want = sorted(map(tuple, _naive(flown).unionByName(rest).collect()), key=repr)
    for bucket in quality.BUCKETS:
        got = sorted(map(tuple, quality.mark_overlapping(df, bucket).collect()), key=repr)
        assert got == want, bucket


@SETTINGS
@given(flight_rows, st.lists(st.tuples(st.sampled_from(["XY-001", "XY-003", None]),
                                       st.integers(0, 5), st.booleans()), max_size=10))
def test_union_form_equals_join_form(spark, spec, maint_spec):
    flights = quality.with_flight_day(spark.createDataFrame(_rows(spec), FLIGHTS))
    maint = spark.createDataFrame(
        [(reg, BASE + dt.timedelta(days=d), BASE + dt.timedelta(days=d, hours=5), p)
         for reg, d, p in maint_spec],
        "aircraftregistration string, scheduleddeparture timestamp_ntz, "
        "scheduledarrival timestamp_ntz, programmed boolean")
    reports = spark.createDataFrame(
        [(reg, (BASE + dt.timedelta(days=d)).date(), "PIREP" if p else "MAREP", 1)
         for reg, d, p in maint_spec],
        "aircraftregistration string, reportingdate date, reporteurclass string, "
        "reporteurid bigint")
    fm = facts.flight_measures(flights)
    mm = facts.maintenance_measures(maint)
    rm = facts.report_measures(reports)
    union = facts.daily_measures(fm, mm, rm)
    joined = facts.daily_measures_join_form(fm, mm, rm)
    assert sorted(union.collect()) == sorted(joined.select(*union.columns).collect())
