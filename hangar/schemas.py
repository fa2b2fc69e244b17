"""Declared schemas: source tables, lookups and the warehouse.

Nothing is inferred.  Timestamps are ``TimestampNTZType`` (wall-clock times
without a zone, as the operational system stores them).
"""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()
TS, D, R = T.TimestampNTZType(), T.DateType(), T.FloatType()


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# --- operational sources -------------------------------------------------

FLIGHTS = _struct(
    ("aircraftregistration", S, True),
    ("cancelled", B, True),
    ("actualdeparture", TS, True),
    ("actualarrival", TS, True),
    ("scheduleddeparture", TS, True),
    ("scheduledarrival", TS, True),
)

MAINTENANCE = _struct(
    ("aircraftregistration", S, True),
    ("scheduleddeparture", TS, True),
    ("scheduledarrival", TS, True),
    ("programmed", B, True),
)

REPORTS = _struct(
    ("aircraftregistration", S, True),
    ("reportingdate", D, True),
    ("reporteurclass", S, True),
    ("reporteurid", L, True),
)

# --- lookups (CSV files in the operational layout) ----------------------

AIRCRAFT_LOOKUP = _struct(
    ("aircraft_reg_code", S, True),
    ("manufacturer_serial_number", S, True),
    ("aircraft_model", S, True),
    ("aircraft_manufacturer", S, True),
)

# ids are read as text and coerced (numeric text like "12.0" is accepted)
PERSONNEL_LOOKUP_TEXT = _struct(("reporteurid", S, True), ("airport", S, True))
PERSONNEL_LOOKUP = _struct(("reporteurid", L, True), ("airport", S, True))

# --- warehouse -----------------------------------------------------------

DIM_AIRCRAFT = _struct(
    ("aircraftid", I, False),
    ("aircraftregistration", S, False),
    ("model", S, False),
    ("manufacturer", S, False),
)

DIM_DATE = _struct(
    ("dateid", I, False),
    ("date", D, False),
    ("month", I, False),
    ("year", I, False),
)

DIM_AIRPORT = _struct(("airportid", I, False), ("airportcode", S, False))

FACT_DAILY = _struct(
    ("dateid", I, False),
    ("aircraftid", I, False),
    ("takeoffs", I, False),
    ("flighthours", R, False),
    ("ADOSS", R, False),
    ("ADOSU", R, False),
    ("delays", I, False),
    ("cancellations", I, False),
    ("delayduration", R, False),
    ("pilotreports", I, False),
    ("maintenancereports", I, False),
)

FACT_TOTAL_MAINTENANCE = _struct(
    ("airportid", I, False),
    ("aircraftid", I, False),
    ("takeoffs", I, False),
    ("flighthours", R, False),
    ("reports", I, False),
)

KEYS_AIRCRAFT = _struct(("aircraftid", I, False), ("aircraftregistration", S, False))
KEYS_AIRPORT = _struct(("airportid", I, False), ("airportcode", S, False))

# per (manufacturer, year, bucket of aircraft ids): sums of the measures and the
# aircraft as a bitmap, so that distinct aircraft of any years can be counted
AIRCRAFT_SETS = T.StructType([
    T.StructField("manufacturer", T.StringType()), T.StructField("year", T.IntegerType()),
    T.StructField("bucket", T.LongType()), T.StructField("aircraft", T.BinaryType()),
    *[T.StructField(n, T.DoubleType() if n in "HSUM" else T.LongType()) for n in "HTSUDCMPR"]])
LOOKUP_REJECTS = _struct(("lookup", S, True), ("line", S, True))

# natural and foreign keys of the warehouse, used by the integrity checks
PRIMARY_KEYS = {
    "aircrafts": ["aircraftid"],
    "dates": ["dateid"],
    "airports": ["airportid"],
    "daily_aircraft_stats": ["dateid", "aircraftid"],
    "total_maintenance_reports": ["airportid", "aircraftid"],
}
UNIQUE_KEYS = {
    "aircrafts": ["aircraftregistration"],
    "dates": ["date"],
    "airports": ["airportcode"],
}
FOREIGN_KEYS = {
    "daily_aircraft_stats": [("aircraftid", "aircrafts"), ("dateid", "dates")],
    "total_maintenance_reports": [("airportid", "airports"), ("aircraftid", "aircrafts")],
}
WAREHOUSE_SCHEMAS = {
    "aircrafts": DIM_AIRCRAFT,
    "dates": DIM_DATE,
    "airports": DIM_AIRPORT,
    "daily_aircraft_stats": FACT_DAILY,
    "total_maintenance_reports": FACT_TOTAL_MAINTENANCE,
}
# key maps, kept from refresh to refresh
KEY_MAP_SCHEMAS = {"aircraft_keys": KEYS_AIRCRAFT, "airport_keys": KEYS_AIRPORT}
