"""Readers, text coercion, the driver mapping and surrogate keys."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from hangar.functions.keys import ordered_ids
from hangar.functions.temporal import text_to_date, text_to_id
from hangar.sources import driver_views, readers


def test_text_dates_and_ids(spark):
    df = spark.createDataFrame([("2024-01-05", "12"), ("2024-1-5", "12.0"),
                                ("2024-01-05 10:30", " 7 "), ("x", "x")], "d string, i string")
    out = df.select(text_to_date("d").alias("d"), text_to_id("i").alias("i")).collect()
    assert [r.d for r in out] == [dt.date(2024, 1, 5), dt.date(2024, 1, 5), None, None]
    assert [r.i for r in out] == [12, 12, 7, None]


def test_text_ids_are_exact_or_null(spark):
    texts = ["12.7", "9007199254740993", "NaN", "1e300", "-4", "9223372036854775808", "1e3", "",
             None, "Infinity"]
    df = spark.createDataFrame([(t,) for t in texts], "i string")
    out = [r.i for r in df.select(text_to_id("i").alias("i")).collect()]
    assert out == [None, 9007199254740993, None, None, -4, None, 1000, None, None, None]


def test_registrations_stay_distinct(spark):
    supplier = spark.range(100_000).selectExpr("id AS s_suppkey", "cast(id % 25 AS int) AS s_nationkey")
    lookup = driver_views.aircraft_lookup(supplier)
    assert lookup.select("aircraft_reg_code").distinct().count() == lookup.count() == 85_714
    assert lookup.where("aircraft_reg_code = 'XY-005'").count() == 1


def test_csv_lookups(spark):
    folder = tempfile.mkdtemp(prefix="hangar-csv-")
    ac, pers = os.path.join(folder, "aircraft.csv"), os.path.join(folder, "personnel.csv")
    with open(ac, "w", encoding="utf-8") as f:
        f.write("aircraft_reg_code,manufacturer_serial_number,aircraft_model,aircraft_manufacturer\n"
                "XY-ABC,1001,A320,Airbus\nXY-DEF,1002,B737,Boeing\nXY-GHI,1003,E190,Embraer\n")
    with open(pers, "w", encoding="utf-8") as f:
        f.write("reporteurid,airport\n12,BCN\n13.0,MAD\nabc,LHR\n")
    lookup = readers.read_aircraft_lookup(spark, ac)
    assert lookup.count() == 3
    makers = {r.aircraftregistration: r.manufacturer
              for r in readers.registrations_per_manufacturer(lookup).collect()}
    assert makers == {"XY-ABC": "Airbus", "XY-DEF": "Boeing"}
    people = readers.read_personnel_lookup(spark, pers).collect()
    assert [(r.reporteurid, r.airport) for r in people] == [(12, "BCN"), (13, "MAD"), (None, "LHR")]


def test_source_projection_folds_case(spark):
    raw = spark.createDataFrame([("XY-1", dt.date(2024, 1, 1), "PIREP", 5, "extra")],
                                "aircraftregistration string, reportingdate date, "
                                "reporteurclass string, reporteurID bigint, other string")
    out = readers.project_reports(raw)
    assert out.columns == ["aircraftregistration", "reportingdate", "reporteurclass", "reporteurid"]


def test_jdbc_options():
    opts = readers.jdbc_options("jdbc:postgresql://db/x", "u", "p", partition_column="id",
                                lower_bound="1", upper_bound="100", num_partitions=8)
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "id"
    assert opts["preferTimestampNTZ"] == "true"
    assert readers.SOURCE_TABLES["flights"] == '"AIMS"."flights"'
    with pytest.raises(ValueError):
        readers.jdbc_options("jdbc:postgresql://db/x", "u", "p", partition_column="id")


def test_driver_mapping_counts(spark):
    src = driver_views.load(spark, "/root/testdata/sf0.001")
    assert src.flights.count() == 6000
    assert src.flights.where("cancelled").count() == 1001
    assert src.maintenance.count() == 1500 and src.reports.count() == 1500
    assert src.aircraft_lookup.count() == 9


def test_ordered_ids_equal_row_number(spark):
    df = spark.range(0, 500).select((F.col("id") * 7919 % 1000).cast("string").alias("k")).distinct()
    got = ordered_ids(df, "id", ["k"], F.substring("k", 1, 1))
    want = df.withColumn("id", F.row_number().over(Window.orderBy("k")))
    assert sorted(got.collect()) == sorted(want.collect())


def test_durations_ignore_the_session_time_zone(spark):
    """Wall-clock differences across a DST transition of the session zone."""
    from hangar.functions.temporal import micros_between

    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")  # DST began at 00:00
    try:
        df = spark.sql("select timestamp_ntz'1997-10-05 23:30:00' a, "
                       "timestamp_ntz'1997-10-06 00:30:00.000001' b")
        row = df.select(micros_between("a", "b").alias("ab"),
                        micros_between("b", "a").alias("ba")).first()
        assert (row.ab, row.ba) == (3_600_000_001, -3_600_000_001)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_read_source_from_csv_casts_to_declared_types(spark):
    folder = tempfile.mkdtemp(prefix="hangar-src-")
    path = os.path.join(folder, "flights.csv")
    with open(path, "w", encoding="utf-8") as f:
        f.write("AircraftRegistration,cancelled,actualdeparture,actualarrival,"
                "scheduleddeparture,scheduledarrival,extra\n"
                "XY-001,false,2024-01-01 08:00:00,2024-01-01 10:00:00,"
                "2024-01-01 08:00:00,2024-01-01 09:50:00,x\n")
    df = readers.read_source(spark, "flights", path, fmt="csv", options={"header": "true"})
    assert df.columns == readers.FLIGHT_COLUMNS
    row = df.first()
    assert row.cancelled is False
    assert row.actualarrival == dt.datetime(2024, 1, 1, 10, 0)
    assert dict(df.dtypes)["scheduledarrival"] == "timestamp_ntz"
