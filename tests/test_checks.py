"""Integrity checks report seeded violations rule by rule."""

from __future__ import annotations

import datetime as dt

from hangar import schemas
from hangar.operators import checks


def _tables(spark):
    ac = spark.createDataFrame([(1, "XY-001", "A320", "Airbus"), (2, "XY-001", "A330", "Airbus")],
                               schemas.DIM_AIRCRAFT.simpleString())
    dates = spark.createDataFrame([(1, dt.date(2024, 1, 1), 202401, 2024)],
                                  schemas.DIM_DATE.simpleString())
    airports = spark.createDataFrame([(1, "BCN")], schemas.DIM_AIRPORT.simpleString())
    fact_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.FACT_DAILY)
    daily = spark.createDataFrame(
        [(1, 1, 1, 2.0, 0.0, 0.0, 0, 0, 0.0, 0, 0),
         (1, 1, 1, 2.0, 0.0, 0.0, 0, 0, 0.0, 0, 0),     # duplicate primary key
         (9, 3, 1, None, 0.0, 0.0, 0, 0, 0.0, 0, 0)],   # orphan date and aircraft, null hours
        fact_schema)
    total = spark.createDataFrame([(1, 1, 1, 2.0, 1)],
                                  "airportid int, aircraftid int, takeoffs int, "
                                  "flighthours float, reports int")
    return {"aircrafts": ac, "dates": dates, "airports": airports,
            "daily_aircraft_stats": daily, "total_maintenance_reports": total}


def test_checks_count_violations(spark):
    got = {r.rule: r.violations for r in checks.all_violations(_tables(spark)).collect()}
    bad = {k: v for k, v in got.items() if v}
    assert bad == {
        "not_null:daily_aircraft_stats.flighthours": 1,
        "primary_key:daily_aircraft_stats(dateid,aircraftid)": 1,
        "unique:aircrafts(aircraftregistration)": 1,
        "foreign_key:daily_aircraft_stats.aircraftid->aircrafts": 1,
        "foreign_key:daily_aircraft_stats.dateid->dates": 1,
    }
    assert len(got) == 26 + 8 + 4
