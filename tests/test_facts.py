"""Measures, daily aggregates and both fact tables on hand-written rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from hangar.operators import dimensions, facts, quality
from hangar.plans.etl import build
from hangar.sources.driver_views import OperationalSources
from tests.conftest import ts

REG = "XY-001"


def measures(flights_df, rows):
    return facts.flight_measures(quality.with_flight_day(flights_df(rows)))


def test_delay_window_is_strict(flights_df):
    sched = ts(1, 10)

    def arriving(minutes, cancelled=False):
        arr = sched + dt.timedelta(minutes=minutes)
        return (REG, cancelled, ts(1, 8), None if cancelled else arr, ts(1, 8), sched)

    rows = [arriving(15), arriving(15.01), arriving(359.99), arriving(360),
            arriving(100, cancelled=True)]
    out = measures(flights_df, rows).orderBy("delay_us").collect()
    delays = sorted(round(r.delay_us / 60e6, 2) for r in out)
    assert delays == [0.0, 0.0, 0.0, 15.01, 359.99]
    assert sum(r.delays for r in out) == 2


def test_null_arrival_counts_a_takeoff_without_hours(flights_df):
    r = measures(flights_df, [(REG, False, ts(1, 8), None, ts(1, 8), ts(1, 10))]).first()
    assert (r.takeoffs, r.flight_us, r.delay_us, r.delays) == (1, 0, 0, 0)


def test_cancelled_flight(flights_df):
    r = measures(flights_df, [(REG, True, None, None, ts(1, 8), ts(1, 10))]).first()
    assert (r.takeoffs, r.flight_us, r.cancellations) == (0, 0, 1)


def test_maintenance_attributed_to_start_day(maintenance_df):
    rows = [(REG, dt.datetime(2023, 12, 31, 12), dt.datetime(2024, 1, 2, 12), True),
            (REG, dt.datetime(2023, 12, 30, 0), None, False)]  # no end: 0 days
    daily = facts.daily_maintenance(facts.maintenance_measures(maintenance_df(rows)))
    out = {r.date: (r.ADOSS, r.ADOSU) for r in daily.collect()}
    assert out == {dt.date(2023, 12, 31): (2.0, 0.0), dt.date(2023, 12, 30): (0.0, 0.0)}


def _tiny_sources(spark, flights_df, maintenance_df, reports_df, aircraft_lookup_df, personnel_df,
                  flights=None, maintenance=None, reports=None, lookup=None, personnel=None):
    return OperationalSources(
        flights=flights_df(flights or [(REG, False, ts(1, 8), ts(1, 10), ts(1, 8), ts(1, 10))]),
        maintenance=maintenance_df(maintenance or []),
        reports=reports_df(reports or []),
        aircraft_lookup=aircraft_lookup_df(lookup or [(REG, "MSN1", "A320", "Airbus")]),
        personnel_lookup=personnel_df(personnel or [(7, "BCN")]),
    )


def test_fact_rows_for_report_and_maintenance_only_days(spark, flights_df, maintenance_df,
                                                        reports_df, aircraft_lookup_df,
                                                        personnel_df):
    src = _tiny_sources(
        spark, flights_df, maintenance_df, reports_df, aircraft_lookup_df, personnel_df,
        maintenance=[(REG, ts(3, 0), ts(3, 12), False)],
        reports=[(REG, dt.date(2024, 1, 2), "PIREP", 7), (REG, dt.date(2024, 1, 4), "OTHER", 7),
                 ("XY-404", dt.date(2024, 1, 2), "MAREP", 7)])
    wh = build(src)
    fact = wh.daily_aircraft_stats.join(wh.dates, "dateid").orderBy("date").collect()
    got = [(r.date.day, r.takeoffs, r.flighthours, r.ADOSU, r.pilotreports,
            r.maintenancereports) for r in fact]
    assert got == [(1, 1, 2.0, 0.0, 0, 0), (2, 0, 0.0, 0.0, 1, 0), (3, 0, 0.0, 0.5, 0, 0),
                   (4, 0, 0.0, 0.0, 0, 0)]
    # the union form and the full-outer-join form agree
    joined = facts.attach_daily_keys(
        facts.daily_measures_join_form(wh.flight_measures, wh.maintenance_measures,
                                       wh.report_measures), wh.aircrafts, wh.dates)
    assert sorted(joined.collect()) == sorted(wh.daily_aircraft_stats.collect())


def test_unknown_aircraft_has_no_fact_rows(spark, flights_df, maintenance_df, reports_df,
                                           aircraft_lookup_df, personnel_df):
    src = _tiny_sources(spark, flights_df, maintenance_df, reports_df, aircraft_lookup_df,
                        personnel_df,
                        flights=[(REG, False, ts(1, 8), ts(1, 10), ts(1, 8), ts(1, 10)),
                                 ("XY-404", False, ts(1, 8), ts(1, 10), ts(1, 8), ts(1, 10))])
    wh = build(src)
    assert wh.daily_aircraft_stats.count() == 1
    assert wh.dates.count() == 1


def test_duplicate_registration_keeps_smallest(aircraft_lookup_df):
    dim = dimensions.aircraft_dimension(aircraft_lookup_df([
        (REG, "1", "B737", "Boeing"), (REG, "2", "A320", "Airbus"), ("XY-002", "3", "A330", "Airbus")]))
    rows = dim.orderBy("aircraftid").collect()
    assert [(r.aircraftid, r.aircraftregistration, r.model) for r in rows] == [
        (1, REG, "A320"), (2, "XY-002", "A330")]


def test_total_maintenance_per_airport(spark, flights_df, maintenance_df, reports_df,
                                       aircraft_lookup_df, personnel_df):
    marep = [(REG, dt.date(2024, 1, 1), "MAREP", 7), (REG, dt.date(2024, 1, 1), "MAREP", 8),
             ("XY-002", dt.date(2024, 1, 1), "MAREP", 8), (REG, dt.date(2024, 1, 1), "MAREP", None)]
    src = _tiny_sources(
        spark, flights_df, maintenance_df, reports_df, aircraft_lookup_df, personnel_df,
        reports=marep,
        lookup=[(REG, "1", "A320", "Airbus"), ("XY-002", "2", "A330", "Airbus")],
        personnel=[(7, "BCN"), (8, "BCN"), (8, "MAD")])  # reporter 8 listed at two airports
    wh = build(src)
    out = (wh.total_maintenance_reports.join(wh.airports, "airportid")
           .join(wh.aircrafts, "aircraftid")
           .select("aircraftregistration", "airportcode", "takeoffs", "flighthours", "reports")
           .orderBy("aircraftregistration", "airportcode").collect())
    assert [tuple(r) for r in out] == [
        (REG, "BCN", 1, 2.0, 2), (REG, "MAD", 1, 2.0, 1),
        ("XY-002", "BCN", 0, 0.0, 1), ("XY-002", "MAD", 0, 0.0, 1)]


def test_empty_reports_input(spark, flights_df, maintenance_df, reports_df, aircraft_lookup_df,
                             personnel_df):
    wh = build(_tiny_sources(spark, flights_df, maintenance_df, reports_df, aircraft_lookup_df,
                             personnel_df))
    row = wh.daily_aircraft_stats.first()
    assert (row.pilotreports, row.maintenancereports) == (0, 0)
    assert wh.total_maintenance_reports.count() == 0


def test_flight_hours_are_exact_sums(flights_df):
    rows = [(REG, False, ts(1, 0), ts(1, 1) + dt.timedelta(microseconds=1), ts(1, 0), ts(1, 1))] * 3
    daily = facts.daily_flights(measures(flights_df, rows)).first()
    assert daily.takeoffs == 3
    assert abs(daily.flighthours - 3.0) < 1e-6
    assert measures(flights_df, rows).agg(F.sum("flight_us")).first()[0] == 3 * 3_600_000_001
