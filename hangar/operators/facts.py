"""Measures, daily aggregates and the two fact tables.

Durations stay integer microseconds until after aggregation; each sum is
divided once and cast to REAL (FLOAT) at the end, so results do not depend on
the order in which rows are summed.  Per (day, aircraft) and per aircraft
the flown durations are sums of non-overlapping intervals (the overlap rule
ran before), which keeps the BIGINT sums far from overflow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangar.functions.keys import broadcast_calendar
from hangar.functions.temporal import (
    MICROS_PER_DAY,
    MICROS_PER_HOUR,
    MICROS_PER_MINUTE,
    day_of,
    micros_between,
)

REG = "aircraftregistration"
KEYS = ["date", REG]
DELAY_MIN_EXCLUSIVE_US = 15 * MICROS_PER_MINUTE  # delays count above 15 minutes
DELAY_MAX_EXCLUSIVE_US = 360 * MICROS_PER_MINUTE  # ... and below 6 hours

MEASURES = ["takeoffs", "flighthours", "ADOSS", "ADOSU", "delays", "cancellations",
            "delayduration", "pilotreports", "maintenancereports"]
INT_MEASURES = ["takeoffs", "delays", "cancellations", "pilotreports", "maintenancereports"]


def _real(us_sum, per_unit: int):
    return (us_sum.cast("double") / F.lit(float(per_unit))).cast("float")


# ---- per-row measures ------------------------------------------------------

def flight_measures(flights: DataFrame) -> DataFrame:
    """P9-P12 per flight: day key, flown microseconds, takeoff, delay
    microseconds (only 15 < minutes < 360 and not cancelled), flags.

    Input: cleaned flights with a ``date`` column (see ``with_flight_day``).
    """
    cancelled = F.col("cancelled")
    flown_us = F.when(cancelled, F.lit(0)).otherwise(
        F.coalesce(micros_between("actualdeparture", "actualarrival"), F.lit(0)))
    late_us = micros_between("scheduledarrival", "actualarrival")
    counted = (~cancelled) & (late_us > DELAY_MIN_EXCLUSIVE_US) & (late_us < DELAY_MAX_EXCLUSIVE_US)
    counted = F.coalesce(counted, F.lit(False))
    return flights.select(
        "date", REG,
        flown_us.cast("bigint").alias("flight_us"),
        (~cancelled).cast("int").alias("takeoffs"),
        F.when(counted, late_us).otherwise(F.lit(0)).cast("bigint").alias("delay_us"),
        counted.cast("int").alias("delays"),
        cancelled.cast("int").alias("cancellations"),
    )


def maintenance_measures(maintenance: DataFrame) -> DataFrame:
    """P13/P14 per event: day of the scheduled start; out-of-service time split
    into scheduled (``programmed``) and unscheduled; a missing end counts 0.
    All of the time is attributed to the start day (no clipping)."""
    us = F.coalesce(micros_between("scheduleddeparture", "scheduledarrival"), F.lit(0))
    programmed = F.col("programmed")
    return maintenance.select(
        day_of("scheduleddeparture").alias("date"), REG,
        F.when(programmed, us).otherwise(F.lit(0)).cast("bigint").alias("scheduled_us"),
        F.when(programmed, F.lit(0)).otherwise(us).cast("bigint").alias("unscheduled_us"),
    )


def report_measures(reports: DataFrame) -> DataFrame:
    """P15 per report: day key and the two role flags (PIREP, MAREP)."""
    cls = F.col("reporteurclass")
    return reports.select(
        F.col("reportingdate").alias("date"), REG,
        F.coalesce((cls == "PIREP").cast("int"), F.lit(0)).alias("pilotreports"),
        F.coalesce((cls == "MAREP").cast("int"), F.lit(0)).alias("maintenancereports"),
    )


# ---- daily aggregates (A1-A3) -----------------------------------------------

def daily_flights(measures: DataFrame) -> DataFrame:
    """A1: per (day, aircraft) flown hours, takeoffs, delays, cancellations,
    delay minutes.  Rows without registration form no group."""
    return (
        measures.where(F.col(REG).isNotNull()).groupBy(*KEYS)
        .agg(_real(F.sum("flight_us"), MICROS_PER_HOUR).alias("flighthours"),
             F.sum("takeoffs").cast("int").alias("takeoffs"),
             F.sum("delays").cast("int").alias("delays"),
             F.sum("cancellations").cast("int").alias("cancellations"),
             _real(F.sum("delay_us"), MICROS_PER_MINUTE).alias("delayduration"))
    )


def daily_maintenance(measures: DataFrame) -> DataFrame:
    """A2: per (day, aircraft) scheduled and unscheduled days out of service."""
    return (
        measures.where(F.col(REG).isNotNull()).groupBy(*KEYS)
        .agg(_real(F.sum("scheduled_us"), MICROS_PER_DAY).alias("ADOSS"),
             _real(F.sum("unscheduled_us"), MICROS_PER_DAY).alias("ADOSU"))
    )


def daily_reports(measures: DataFrame) -> DataFrame:
    """A3: per (day, aircraft) pilot and maintenance reports."""
    return (
        measures.where(F.col(REG).isNotNull()).groupBy(*KEYS)
        .agg(F.sum("pilotreports").cast("int").alias("pilotreports"),
             F.sum("maintenancereports").cast("int").alias("maintenancereports"))
    )


# ---- D4: daily fact ----------------------------------------------------------

SUM_COLUMNS = ["takeoffs", "flight_us", "scheduled_us", "unscheduled_us", "delays",
               "cancellations", "delay_us", "pilotreports", "maintenancereports"]


def daily_sums(flights_m: DataFrame, maint_m: DataFrame, reports_m: DataFrame) -> DataFrame:
    """J4/J5 in union form: one row per (day, registration) present in any
    input, with exact BIGINT sums (durations in microseconds).

    All measures are additive with "missing = 0", so the full outer joins of
    the three daily aggregates equal a union of zero-padded rows followed by
    ONE aggregation (one shuffle, partial aggregation before it).  Rows
    without a registration are kept as their own groups: they still place
    their day in the date dimension but never reach a fact.
    """
    zero = F.lit(0).cast("bigint")

    def pad(df: DataFrame) -> DataFrame:
        return df.select(*KEYS, *[(F.col(c) if c in df.columns else zero).cast("bigint").alias(c)
                                  for c in SUM_COLUMNS])

    rows = pad(flights_m).unionByName(pad(maint_m)).unionByName(pad(reports_m))
    return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUM_COLUMNS])


def fact_measures(sums: DataFrame) -> DataFrame:
    """The nine fact measures from ``daily_sums`` (INT counts, REAL
    hours/days/minutes), only for rows with a registration."""
    return sums.where(F.col(REG).isNotNull()).select(
        *KEYS,
        F.col("takeoffs").cast("int").alias("takeoffs"),
        _real(F.col("flight_us"), MICROS_PER_HOUR).alias("flighthours"),
        _real(F.col("scheduled_us"), MICROS_PER_DAY).alias("ADOSS"),
        _real(F.col("unscheduled_us"), MICROS_PER_DAY).alias("ADOSU"),
        F.col("delays").cast("int").alias("delays"),
        F.col("cancellations").cast("int").alias("cancellations"),
        _real(F.col("delay_us"), MICROS_PER_MINUTE).alias("delayduration"),
        F.col("pilotreports").cast("int").alias("pilotreports"),
        F.col("maintenancereports").cast("int").alias("maintenancereports"),
    )


def daily_measures(flights_m: DataFrame, maint_m: DataFrame, reports_m: DataFrame) -> DataFrame:
    """D4 before key lookup: fact measures per (day, aircraft)."""
    return fact_measures(daily_sums(flights_m, maint_m, reports_m))


def daily_measures_join_form(flights_m: DataFrame, maint_m: DataFrame,
                             reports_m: DataFrame) -> DataFrame:
    """The same rows as ``daily_measures`` by the original route: aggregate
    each input, full-outer-join them on (day, aircraft), fill gaps with 0.
    Kept as an independent check of the union form."""
    joined = (daily_flights(flights_m)
              .join(daily_reports(reports_m), KEYS, "full")
              .join(daily_maintenance(maint_m), KEYS, "full"))
    return joined.select(
        *KEYS,
        *[F.coalesce(F.col(m), F.lit(0)).cast("int" if m in INT_MEASURES else "float").alias(m)
          for m in MEASURES])


def attach_daily_keys(daily: DataFrame, aircraft_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Natural keys -> surrogate keys; rows for an unknown aircraft or day
    are dropped (inner joins).  The date dimension is broadcast (bounded by
    the calendar); the aircraft dimension is broadcast by Spark when its
    measured size allows, else joined by shuffle."""
    return (
        daily.join(broadcast_calendar(date_dim.select("dateid", "date")), "date")
        .join(aircraft_dim.select("aircraftid", REG), REG)
        .select("dateid", "aircraftid", *MEASURES)
    )


# ---- D5: total maintenance reports per airport -------------------------------

def aircraft_totals(flights_m: DataFrame) -> DataFrame:
    """A4: per aircraft, all takeoffs and flown hours (from per-flight
    measures or from ``daily_sums``; both carry takeoffs and flight_us)."""
    return (
        flights_m.where(F.col(REG).isNotNull()).groupBy(REG)
        .agg(F.sum("takeoffs").alias("takeoffs"), F.sum("flight_us").alias("flight_us"))
    )


def marep_counts(reports: DataFrame) -> DataFrame:
    """P7 + A5: MAREP reports per (reporter, aircraft); no reporter, no group."""
    return (
        reports.where((F.col("reporteurclass") == "MAREP") & F.col("reporteurid").isNotNull()
                      & F.col(REG).isNotNull())
        .groupBy("reporteurid", REG).agg(F.count(F.lit(1)).alias("count"))
    )


def airport_report_totals(counts: DataFrame, personnel: DataFrame) -> DataFrame:
    """J6 + A6: reporters -> airports, summed per (aircraft, airport).

    ``personnel`` is the raw lookup (reporteurid, airport): a reporter listed
    at two airports counts at both.  Counts are pre-aggregated per
    (reporter, aircraft) before this join, so a prolific reporter adds one row
    per aircraft, not one per report.
    """
    return (
        counts.join(personnel.select("reporteurid", "airport")
                    .where(F.col("reporteurid").isNotNull() & F.col("airport").isNotNull()),
                    "reporteurid")
        .groupBy(REG, "airport").agg(F.sum("count").alias("reports"))
    )


def total_maintenance_rows(airport_totals: DataFrame, totals: DataFrame) -> DataFrame:
    """J7 + P17: the aircraft's totals repeated on each of its airports; an
    aircraft with reports but no flights gets 0 takeoffs and 0 hours."""
    return (
        airport_totals.join(totals, REG, "left")
        .select(REG, F.col("airport").alias("airportcode"),
                F.coalesce(F.col("takeoffs"), F.lit(0)).cast("int").alias("takeoffs"),
                _real(F.coalesce(F.col("flight_us"), F.lit(0)), MICROS_PER_HOUR).alias("flighthours"),
                F.col("reports").cast("int").alias("reports"))
    )


def attach_total_keys(rows: DataFrame, aircraft_dim: DataFrame, airport_dim: DataFrame) -> DataFrame:
    """Natural keys -> surrogate keys, unknown ones dropped."""
    return (
        rows.join(aircraft_dim.select("aircraftid", REG), REG)
        .join(airport_dim.select("airportid", "airportcode"), "airportcode")
        .select("airportid", "aircraftid", "takeoffs", "flighthours", "reports")
    )
