"""Source-level KPI queries (Q4-Q6): the same KPIs computed straight from the
raw operational tables, without cleaning or the warehouse.

By construction they differ from Q1-Q3: raw rows (no swap, no overlap
removal), delays above 15 minutes with no upper bound, every report class
counted, unknown registrations attributed to a "manufacturer" equal to the
registration itself, and the year as text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangar.functions.numeric import split_micros, split_to_double, sum_split
from hangar.functions.temporal import (
    MICROS_PER_DAY,
    MICROS_PER_HOUR,
    MICROS_PER_MINUTE,
    sql_micros_between,
)
from hangar.plans.warehouse_kpis import rate_sql, utilization_from_sums
from hangar.sources.readers import registrations_per_manufacturer

REG = "aircraftregistration"
GROUP = ["manufacturer", "year"]
DELAY_MIN_EXCLUSIVE_US = 15 * MICROS_PER_MINUTE


def with_manufacturer(df: DataFrame, aircraft_lookup: DataFrame) -> DataFrame:
    """Airbus/Boeing from the lookup, otherwise the registration itself.

    A left join on the registration against one row per registration; Spark
    broadcasts the lookup when its measured size allows and otherwise
    shuffles (with AQE splitting a skewed registration)."""
    makers = registrations_per_manufacturer(aircraft_lookup).withColumnRenamed("manufacturer", "_maker")
    return (df.join(makers, REG, "left")
            .withColumn("manufacturer", F.coalesce(F.col("_maker"), F.col(REG)))
            .drop("_maker"))


def _atomic_rows(flights: DataFrame, maintenance: DataFrame) -> DataFrame:
    """U3 + P18/P19 without the manufacturer; ``year`` is an INT here.

    Written as SQL select items (one JVM call per column)."""
    flown = sql_micros_between("actualdeparture", "actualarrival")
    late = sql_micros_between("scheduledarrival", "actualarrival")
    late_counted = f"coalesce(({late}) > {DELAY_MIN_EXCLUSIVE_US}L, false)"
    f = flights.selectExpr(
        REG, "year(scheduleddeparture) AS year",
        f"CASE WHEN cancelled THEN 0L ELSE {flown} END AS flight_us",
        "CASE WHEN cancelled THEN 0 ELSE 1 END AS cycles",
        "CASE WHEN cancelled THEN 1 ELSE 0 END AS cancellations",
        f"CASE WHEN cancelled THEN 0 WHEN {late_counted} THEN 1 ELSE 0 END AS delays",
        f"CASE WHEN cancelled THEN 0L WHEN {late_counted} THEN {late} ELSE 0L END AS delay_us",
        "0L AS scheduled_us", "0L AS unscheduled_us",
    )
    span = sql_micros_between("scheduleddeparture", "scheduledarrival")
    m = maintenance.selectExpr(
        REG, "year(scheduleddeparture) AS year",
        "0L AS flight_us", "0 AS cycles", "0 AS cancellations", "0 AS delays", "0L AS delay_us",
        f"CASE WHEN coalesce(programmed, false) THEN {span} ELSE 0L END AS scheduled_us",
        f"CASE WHEN coalesce(programmed, false) THEN 0L ELSE {span} END AS unscheduled_us",
    )
    return f.unionByName(m)


def source_atomic(flights: DataFrame, maintenance: DataFrame, aircraft_lookup: DataFrame) -> DataFrame:
    """U3 + P18/P19: one row per flight and per maintenance event with
    conditional measures (durations in microseconds) and its manufacturer."""
    rows = _atomic_rows(flights, maintenance)
    return with_manufacturer(rows.withColumn("year", F.col("year").cast("string")),
                             aircraft_lookup)


DURATIONS = ("flight_us", "scheduled_us", "unscheduled_us", "delay_us")


def _by_aircraft_year(rows: DataFrame, durations: tuple[str, ...], counts: tuple[str, ...],
                      extra_keys: tuple[str, ...] = ()) -> DataFrame:
    """Pre-aggregate atomic rows per (registration, year[, extra]) before any
    join: map-side partial sums collapse even one very busy aircraft, and the
    manufacturer lookup then joins a few rows per aircraft and year."""
    split = rows.selectExpr(REG, "year", *extra_keys, *counts,
                            *[p for d in durations for p in split_micros(d, d)])
    return split.groupBy(REG, "year", *extra_keys).agg(
        *[F.expr(f"sum({c}) AS {c}") for c in counts],
        *[p for d in durations for p in sum_split(d)])


def _roll_up(per: DataFrame, aircraft_lookup: DataFrame, durations: tuple[str, ...],
             counts: tuple[str, ...], extra_keys: tuple[str, ...] = (),
             count_aircraft: bool = False) -> DataFrame:
    """Attribute each (registration, year) to its manufacturer and sum up to
    (manufacturer, year[, extra]); ``n`` counts the non-null registrations,
    i.e. the distinct aircraft of the group."""
    keyed = with_manufacturer(per, aircraft_lookup)
    aggs = [F.expr(f"sum({c}) AS {c}") for c in counts]
    aggs += [p for d in durations for p in sum_split(d)]
    if count_aircraft:
        aggs.append(F.expr(f"count({REG}) AS n"))
    g = keyed.groupBy("manufacturer", "year", *extra_keys).agg(*aggs)
    return g.selectExpr("manufacturer", "cast(year as string) AS year", *extra_keys,
                        *counts, *[f"{split_to_double(d)} AS {d}" for d in durations],
                        *(["n"] if count_aircraft else []))


def utilization(flights: DataFrame, maintenance: DataFrame, aircraft_lookup: DataFrame) -> DataFrame:
    """Q4: utilization KPIs per (manufacturer, year) from the raw tables."""
    counts = ("cycles", "delays", "cancellations")
    rows = _atomic_rows(flights, maintenance)
    g = _roll_up(_by_aircraft_year(rows, DURATIONS, counts), aircraft_lookup, DURATIONS,
                 counts, count_aircraft=True)
    g = g.selectExpr(
        *GROUP,
        f"flight_us / {float(MICROS_PER_HOUR)!r}D AS H", "cycles AS T",
        f"scheduled_us / {float(MICROS_PER_DAY)!r}D AS S",
        f"unscheduled_us / {float(MICROS_PER_DAY)!r}D AS U",
        "delays AS D", "cancellations AS C",
        f"delay_us / {float(MICROS_PER_MINUTE)!r}D AS M", "n")
    return utilization_from_sums(g).orderBy(*GROUP)


def flight_totals(flights: DataFrame, aircraft_lookup: DataFrame) -> DataFrame:
    """Per (manufacturer, year of scheduled departure) flown hours and cycles."""
    flown = sql_micros_between("actualdeparture", "actualarrival")
    rows = flights.selectExpr(
        REG, "year(scheduleddeparture) AS year",
        f"CASE WHEN cancelled THEN 0L ELSE {flown} END AS flight_us",
        "CASE WHEN cancelled THEN 0 ELSE 1 END AS cycles")
    per = _by_aircraft_year(rows, ("flight_us",), ("cycles",))
    g = _roll_up(per, aircraft_lookup, ("flight_us",), ("cycles",))
    return g.selectExpr(*GROUP, f"flight_us / {float(MICROS_PER_HOUR)!r}D AS H", "cycles AS T")


def report_counts(reports: DataFrame, aircraft_lookup: DataFrame, by_role: bool) -> DataFrame:
    """Reports of every class per (manufacturer, year[, role])."""
    extra = ("role",) if by_role else ()
    rows = reports.selectExpr(REG, "year(reportingdate) AS year", "reporteurclass AS role",
                              "1 AS counter")
    per = _by_aircraft_year(rows, (), ("counter",), extra)
    return _roll_up(per, aircraft_lookup, (), ("counter",), extra)


def _rates(counts: DataFrame, totals: DataFrame, keys: list[str]) -> DataFrame:
    """J12 (inner join on manufacturer and year) + the two rates."""
    return counts.join(totals, GROUP).selectExpr(
        *keys,
        f"{rate_sql('counter', 'H', 1000.0, 3, 3)} AS RRh",
        f"{rate_sql('counter', 'T', 100.0, 2, 2)} AS RRc",
    ).orderBy(*keys)


def reporting(flights: DataFrame, reports: DataFrame, aircraft_lookup: DataFrame) -> DataFrame:
    """Q5: reporting rates per (manufacturer, year) from the raw tables."""
    return _rates(report_counts(reports, aircraft_lookup, False),
                  flight_totals(flights, aircraft_lookup), GROUP)


def reporting_by_role(flights: DataFrame, reports: DataFrame, aircraft_lookup: DataFrame) -> DataFrame:
    """Q6: reporting rates per (manufacturer, year, report class)."""
    return _rates(report_counts(reports, aircraft_lookup, True),
                  flight_totals(flights, aircraft_lookup), GROUP + ["role"])
