"""Data-quality rules.  Rules that remove rows also expose the rejected rows
(written by the pipeline).

* ``swap_reversed_times``   BR-22: actual arrival <= departure -> swap (P4)
* ``mark_overlapping``      BR-21: flag a flight that overlaps the next (W1);
  ``split_overlapping`` gives (clean, rejects)
* ``split_known_aircraft``  BR-3 : reports on unknown aircraft (J1/J2)
* ``flight_years`` / ``restrict_to_years``: maintenance and reports only for
  years that cleaned flights cover (A12/J3); flights without a scheduled
  departure are dropped (P6)
* ``null_counts`` / ``require_no_nulls``: columns whose nulls abort the run
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hangar.functions.temporal import day_of

REG, CANCELLED = "aircraftregistration", "cancelled"
DEP, ARR = "actualdeparture", "actualarrival"
SDEP, SARR = "scheduleddeparture", "scheduledarrival"


# ---- preconditions (C4, T13) ----------------------------------------------

def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: the number of nulls per column (one pass, column-pruned scan)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])


def require_no_nulls(df: DataFrame, columns: list[str], table: str) -> None:
    """Fail the run, with the counts, if any of ``columns`` holds a null."""
    refuse_nulls(null_counts(df, columns).first().asDict(), table)


def required_counts(columns: list[str]) -> list[Column]:
    """Aggregates for ``observe``: the nulls of each required column, counted while
    a stage is written."""
    return [F.count_if(F.col(c).isNull()).alias(c) for c in columns]


def refuse_nulls(counts: dict[str, int], table: str) -> None:
    """Fail the run if a required column was seen to hold nulls."""
    bad = {c: n for c, n in counts.items() if n}
    if bad:
        raise ValueError(f"{table}: null values in required columns {bad}")


# ---- P4: swapped actual times ----------------------------------------------

def reversed_times(cancelled: Column, dep: Column, arr: Column) -> Column:
    """Rule predicate: a flown flight whose arrival is not after its departure.

    Equal times count as a violation (the swap is then a no-op)."""
    return (~cancelled) & dep.isNotNull() & arr.isNotNull() & (arr <= dep)


def swap_reversed_times(flights: DataFrame) -> DataFrame:
    """Swap actual departure and arrival where the rule is violated.

    Both new columns are computed from the old values in one projection.
    """
    bad = F.coalesce(reversed_times(F.col(CANCELLED), F.col(DEP), F.col(ARR)), F.lit(False))
    return flights.withColumns(
        {DEP: F.when(bad, F.col(ARR)).otherwise(F.col(DEP)),
         ARR: F.when(bad, F.col(DEP)).otherwise(F.col(ARR))}
    )


def count_reversed_times(flights: DataFrame) -> DataFrame:
    """One row with the number of rule violations (for the run log)."""
    return flights.agg(reversed_count().alias("violations"))


def reversed_count() -> Column:
    """Aggregate: rule violations (also for ``observe``)."""
    return F.count_if(reversed_times(F.col(CANCELLED), F.col(DEP), F.col(ARR)))


# ---- W1: overlapping flights -----------------------------------------------

def flight_order() -> list[Column]:
    """Order of one aircraft's flown flights; later keys only break ties."""
    return [F.col(DEP).asc(), F.col(ARR).asc_nulls_last(),
            F.col(SDEP).asc_nulls_last(), F.col(SARR).asc_nulls_last()]


OVERLAPS = "overlaps"


#: Minutes in a bucket of departures.
BUCKETS = {"day": 1440, "hour": 60, "minute": 1}


def _bucket(bucket: str) -> Column:
    """Integer, order-preserving bucket of a departure: minutes since 1970-01-01
    of the wall clock, rounded down, so no time zone is involved."""
    day = F.datediff(F.to_date(F.col(DEP)), F.lit("1970-01-01").cast("date")).cast("bigint")
    minute = day * 1440 + F.hour(F.col(DEP)) * 60 + F.minute(F.col(DEP))
    return minute - minute % BUCKETS[bucket]


#: Flights that one window partition may hold; aircraft with more are split by time.
BUSY = 500_000
#: Slots that aircraft are counted in: a task sends no more rows than that.
SLOTS = 16_384


def mark_overlapping(flights: DataFrame, bucket: str = "hour", busy: int = BUSY) -> DataFrame:
    """All flights plus a boolean ``overlaps``: true for every flown flight
    that is still in the air when the next one of the same aircraft departs.

    Flights of an aircraft are ordered by actual departure (then arrival and
    the scheduled times to break ties).  A flight overlaps when its arrival
    is strictly later than the departure of the flight right after it, with
    neighbours taken from the original order (one pass).  Cancelled flights,
    flights without registration and flights without actual departure never
    take part and never overlap; a null arrival never overlaps.

    Scale: flights are read and shuffled once, for a ``lead`` over a window
    partitioned by aircraft; those that don't take part sort last, spread over
    ``SLOTS`` partitions of their aircraft.  An aircraft with over ``busy`` flights
    is partitioned by the bucket of the departure too, so it is spread over as many
    tasks as it has flying hours, whatever the data.  Aircraft are counted by a hash
    of the registration (``SLOTS`` counts at most, from each task and in all); all
    aircraft of a slot with over ``busy`` flights count as busy, which changes no
    result.  The last flight of a bucket needs the first departure of the aircraft's
    next non-empty bucket: a summary of the busy aircraft with one row per (aircraft,
    bucket) -- pre-aggregated map-side, bounded per aircraft by the hours of history
    (8,766 a year) -- finds it, and one "ghost" row per bucket that departs then is
    unioned into the same window input, where it sorts after the bucket's flights.
    """
    if bucket not in BUCKETS:
        raise ValueError(f"bucket must be 'day', 'hour' or 'minute', not {bucket!r}")
    cols = flights.columns
    takes_part = F.coalesce(
        (~F.col(CANCELLED)) & F.col(REG).isNotNull() & F.col(DEP).isNotNull(), F.lit(False)
    )
    slot = F.pmod(F.hash(REG), F.lit(SLOTS)).alias("_slot")
    crowded = F.broadcast(  # at most SLOTS rows
        flights.where(F.col(REG).isNotNull()).groupBy(slot).agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > busy).select("_slot", F.lit(True).alias("_busy")))
    parts = F.when(~F.col("_flown"), F.pmod(F.hash(*cols), F.lit(SLOTS)).cast("bigint")).when(
        F.col("_busy"), _bucket(bucket))
    placed = (
        flights.select(*cols, takes_part.alias("_flown"), slot).join(crowded, "_slot", "left")
        .select(*cols, "_flown", parts.alias("_bucket"), F.lit(False).alias("_ghost"))
    )
    # per busy (aircraft, bucket): first departure of the next non-empty bucket
    ghosts = (
        flights.where(takes_part).select(REG, DEP, slot).join(crowded, "_slot")
        .groupBy(REG, _bucket(bucket).alias("_bucket")).agg(F.min(DEP).alias("_first"))
        .withColumn(DEP, F.lead("_first").over(Window.partitionBy(REG).orderBy("_bucket")))
        .where(F.col(DEP).isNotNull())
        .select(REG, DEP, "_bucket", F.lit(True).alias("_flown"), F.lit(True).alias("_ghost"))
    )
    within = Window.partitionBy(REG, "_bucket").orderBy(F.col("_flown").desc(), *flight_order())
    return (
        placed.unionByName(ghosts, allowMissingColumns=True)
        .withColumn("_next", F.lead(F.when(F.col("_flown"), F.col(DEP))).over(within))
        .where(~F.col("_ghost"))
        .withColumn(OVERLAPS, F.coalesce(F.col("_flown") & (F.col(ARR) > F.col("_next")), F.lit(False)))
        .select(*cols, OVERLAPS)
    )


def split_overlapping(flights: DataFrame, bucket: str = "hour") -> tuple[DataFrame, DataFrame]:
    """``(clean, rejects)`` of ``mark_overlapping``.  The pipeline stages the
    marked flights once and filters them twice instead."""
    marked = mark_overlapping(flights, bucket)
    return (marked.where(~F.col(OVERLAPS)).drop(OVERLAPS),
            marked.where(F.col(OVERLAPS)).drop(OVERLAPS))


# ---- J1/J2: reports on known aircraft ----------------------------------------

KNOWN = "known"


def mark_known_aircraft(reports: DataFrame, aircraft_dim: DataFrame) -> DataFrame:
    """All reports plus a boolean ``known``: their registration is in the dimension.

    A left join with the dimension's distinct registrations adds no rows; both the
    valid reports and the rejects are filters of the result."""
    known = aircraft_dim.select(REG).distinct().withColumn(KNOWN, F.lit(True))
    return reports.join(known, REG, "left").select(
        *reports.columns, F.coalesce(F.col(KNOWN), F.lit(False)).alias(KNOWN))


def split_known_aircraft(reports: DataFrame, aircraft_dim: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Reports whose registration is in the aircraft dimension, and the rest.

    Semi/anti joins on the registration; the dimension is one row per
    aircraft, so Spark broadcasts it when its measured size is under the
    broadcast threshold and shuffles otherwise.
    """
    known = aircraft_dim.select(REG)
    return (reports.join(known, REG, "left_semi"),
            reports.join(known, REG, "left_anti"))


# ---- P6/A12/J3: flight years ------------------------------------------------

def with_flight_day(flights: DataFrame) -> DataFrame:
    """The day key of a flight is its scheduled departure day; flights
    without one cannot be placed and are dropped."""
    return flights.withColumn("date", day_of(SDEP)).where(F.col("date").isNotNull())


def flight_years(flights_with_day: DataFrame) -> DataFrame:
    """Distinct years of the cleaned flights (one INT column ``year``).

    Bounded: a DATE's year lies in 1..9999, so this has at most 9,999 rows
    whatever the data volume.
    """
    return flights_with_day.select(F.year("date").alias("year")).distinct()


def restrict_to_years(df: DataFrame, date_col: str, years: DataFrame) -> DataFrame:
    """Keep rows whose ``date_col`` falls in one of ``years``."""
    return (df.withColumn("_year", F.year(date_col))
            .join(F.broadcast(years.withColumnRenamed("year", "_year")), "_year", "left_semi")
            .drop("_year"))
