"""Quality rules on hand-written flights (swap, overlap, reference, years)."""

from __future__ import annotations

import datetime as dt

import pytest

from hangar.operators import quality
from tests.conftest import ts

REG = "XY-001"


def flight(dep, arr, reg=REG, cancelled=False, sdep=None, sarr=None):
    sdep = sdep if sdep is not None else dep
    return (reg, cancelled, dep, arr, sdep, sarr or sdep)


def kept_and_dropped(flights_df, rows, bucket="day"):
    clean, rejects = quality.split_overlapping(flights_df(rows), bucket)
    key = lambda r: (r.actualdeparture or dt.datetime.max, r.aircraftregistration or "")
    return (sorted(clean.collect(), key=key), sorted(rejects.collect(), key=key))


# ---- P4 ------------------------------------------------------------------

def test_swap_reversed_times(flights_df):
    rows = [
        flight(ts(1, 10), ts(1, 8)),                  # arrival before departure: swapped
        flight(ts(2, 10), ts(2, 10)),                 # equal: a violation, values unchanged
        flight(ts(3, 10), None),                      # one side null: unchanged
        flight(ts(4, 10), ts(4, 8), cancelled=True),  # cancelled: unchanged
    ]
    df = flights_df(rows)
    out = quality.swap_reversed_times(df).collect()
    assert (out[0].actualdeparture, out[0].actualarrival) == (ts(1, 8), ts(1, 10))
    assert (out[1].actualdeparture, out[1].actualarrival) == (ts(2, 10), ts(2, 10))
    assert (out[2].actualdeparture, out[2].actualarrival) == (ts(3, 10), None)
    assert (out[3].actualdeparture, out[3].actualarrival) == (ts(4, 10), ts(4, 8))
    assert quality.count_reversed_times(df).first().violations == 2


# ---- W1 ------------------------------------------------------------------

def test_overlap_only_the_long_flight_is_dropped(flights_df):
    a, b, c = flight(ts(1, 0), ts(1, 10)), flight(ts(1, 1), ts(1, 2)), flight(ts(1, 3), ts(1, 4))
    clean, dropped = kept_and_dropped(flights_df, [a, b, c])
    assert [r.actualdeparture for r in dropped] == [ts(1, 0)]
    assert [r.actualdeparture for r in clean] == [ts(1, 1), ts(1, 3)]


def test_overlap_chain_uses_original_neighbours(flights_df):
    rows = [flight(ts(1, 0), ts(1, 5)), flight(ts(1, 4), ts(1, 9)), flight(ts(1, 8), ts(1, 12))]
    clean, dropped = kept_and_dropped(flights_df, rows)
    assert [r.actualdeparture for r in dropped] == [ts(1, 0), ts(1, 4)]
    assert [r.actualdeparture for r in clean] == [ts(1, 8)]


def test_touching_flights_are_kept(flights_df):
    clean, dropped = kept_and_dropped(flights_df, [flight(ts(1, 0), ts(1, 5)),
                                                   flight(ts(1, 5), ts(1, 9))])
    assert dropped == [] and len(clean) == 2


def test_cancelled_flight_is_not_a_neighbour(flights_df):
    rows = [flight(ts(1, 0), ts(1, 5)),
            flight(ts(1, 2), None, cancelled=True),
            flight(ts(1, 4), ts(1, 6))]
    clean, dropped = kept_and_dropped(flights_df, rows)
    assert [r.actualdeparture for r in dropped] == [ts(1, 0)]
    assert len(clean) == 2


@pytest.mark.parametrize("bucket", ["day", "hour", "minute"])
def test_overlap_across_bucket_boundary(flights_df, bucket):
    # the successor departs in a later bucket (next day, two empty days later)
    rows = [flight(ts(1, 22), ts(2, 1)), flight(ts(2, 0.5), ts(2, 2)),
            flight(ts(2, 23), ts(5, 3)), flight(ts(5, 2), ts(5, 4))]
    clean, dropped = kept_and_dropped(flights_df, rows, bucket)
    assert [r.actualdeparture for r in dropped] == [ts(1, 22), ts(2, 23)]
    assert [r.actualdeparture for r in clean] == [ts(2, 0.5), ts(5, 2)]


def test_bucket_size_changes_nothing(flights_df):
    """Whatever the buckets of departures, results are the same."""
    rows = [flight(ts(1, 0), ts(1, 10)), flight(ts(1, 1), ts(1, 2)), flight(ts(1, 3), ts(1, 4)),
            flight(ts(1, 3.5), ts(2, 1)), flight(ts(2, 0.5), ts(2, 2))]
    for bucket in quality.BUCKETS:
        clean, rejects = quality.split_overlapping(flights_df(rows), bucket)
        assert sorted(r.actualdeparture for r in rejects.collect()) == [
            ts(1, 0), ts(1, 3), ts(1, 3.5)]
        assert clean.count() == 2


def test_nulls_never_dropped(flights_df):
    rows = [flight(ts(1, 0), ts(1, 10)),
            flight(None, ts(1, 3)),                 # null departure sorts last
            flight(ts(1, 1), ts(1, 20), reg=None),  # null registration: never dropped
            flight(ts(1, 2), None),                 # null arrival never overlaps
            flight(ts(1, 3), ts(1, 4))]
    clean, dropped = kept_and_dropped(flights_df, rows)
    assert [r.actualdeparture for r in dropped] == [ts(1, 0)]
    assert len(clean) == 4


def test_same_departure_tie_keeps_exactly_one(flights_df):
    rows = [flight(ts(1, 1), ts(1, 3)), flight(ts(1, 1), ts(1, 2))]
    clean, dropped = kept_and_dropped(flights_df, rows)
    # ordered by arrival: (1->2) comes first and overlaps (1->3)'s departure
    assert [(r.actualdeparture, r.actualarrival) for r in dropped] == [(ts(1, 1), ts(1, 2))]
    assert len(clean) == 1


def test_survivors_never_overlap(spark):
    """Invariant on the driver data: no two kept flights of one aircraft overlap."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from hangar.sources import driver_views

    src = driver_views.load(spark, "/root/testdata/sf0.001")
    clean, _ = quality.split_overlapping(quality.swap_reversed_times(src.flights))
    flown = clean.where(~F.col("cancelled") & F.col("aircraftregistration").isNotNull()
                        & F.col("actualdeparture").isNotNull())
    w = Window.partitionBy("aircraftregistration").orderBy("actualdeparture", "actualarrival")
    bad = (flown.withColumn("nxt", F.lead("actualdeparture").over(w))
           .where(F.col("actualarrival") > F.col("nxt")).count())
    assert bad == 0


# ---- J1/J2, J3 ---------------------------------------------------------------

def test_reports_split_by_known_aircraft(spark, reports_df):
    dim = spark.createDataFrame([(1, "XY-001", "M1", "Airbus")],
                                "aircraftid int, aircraftregistration string, model string, "
                                "manufacturer string")
    reports = reports_df([("XY-001", dt.date(2024, 1, 1), "PIREP", 1),
                          ("XY-999", dt.date(2024, 1, 1), "MAREP", 2)])
    known, rejects = quality.split_known_aircraft(reports, dim)
    assert [r.aircraftregistration for r in known.collect()] == ["XY-001"]
    assert [r.aircraftregistration for r in rejects.collect()] == ["XY-999"]


def test_years_restrict_maintenance_and_reports(flights_df, reports_df):
    no_sched = (REG, False, ts(2, 1), ts(2, 2), None, ts(2, 2))  # dropped by P6
    flights = quality.with_flight_day(flights_df([flight(ts(1, 1), ts(1, 2)), no_sched]))
    assert flights.count() == 1
    years = quality.flight_years(flights)
    assert [r.year for r in years.collect()] == [2024]
    reports = reports_df([("XY-001", dt.date(2024, 5, 1), "PIREP", 1),
                          ("XY-001", dt.date(2034, 5, 1), "PIREP", 1)])
    kept = quality.restrict_to_years(reports, "reportingdate", years).collect()
    assert [r.reportingdate.year for r in kept] == [2024]


def test_required_columns_fail_with_count(reports_df):
    reports = reports_df([(None, dt.date(2024, 1, 1), "PIREP", 1),
                          (None, dt.date(2024, 1, 2), "PIREP", 1)])
    with pytest.raises(ValueError, match="'aircraftregistration': 2"):
        quality.require_no_nulls(reports, ["aircraftregistration"], "reports")
