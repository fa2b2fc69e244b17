"""Warehouse KPI queries (Q1-Q3) over the daily fact and its dimensions.

The formulas are kept exactly as defined for the warehouse, including their
quirks: TakeOff and TDR use integer division, ADD is scaled by 100, ADIS
assumes 365 days, and DU/DC divide the already-rounded FH/TakeOff.  A zero
denominator yields NULL.  Rounding is half away from zero on DOUBLE
(``r_sql``) and the result is cast to DECIMAL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangar.functions.keys import broadcast_calendar
from hangar.functions.numeric import dec_sql as dec
from hangar.functions.numeric import div_sql as div
from hangar.functions.numeric import idiv_sql as idiv
from hangar.functions.numeric import r_sql as r

GROUP = ["manufacturer", "year"]


def dated(fact: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Fact rows with their year.  Where the fact is stored by year, the year joins
    too: days that are filtered in the date dimension then prune the fact's
    partitions, statically (a year) or at run time (days, months)."""
    keys = ["dateid", "year"] if "year" in fact.columns else ["dateid"]
    return fact.join(broadcast_calendar(date_dim.select("dateid", "year")), keys)


def in_years(date_dim: DataFrame, first: int, last: int) -> DataFrame:
    """The days of a range of years."""
    return date_dim.where(F.col("date").between(F.make_date(F.lit(first), F.lit(1), F.lit(1)),
                                                F.make_date(F.lit(last), F.lit(12), F.lit(31))))


def star(fact: DataFrame, aircraft_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Fact joined to date and aircraft.  The date dimension is
    broadcast (bounded by the calendar); the aircraft dimension is broadcast
    by Spark when its measured size allows."""
    return (dated(fact, date_dim)
            .join(aircraft_dim.select("aircraftid", "manufacturer"), "aircraftid"))


_MEASURES = {"H": "flighthours", "T": "takeoffs", "S": "ADOSS", "U": "ADOSU", "D": "delays",
             "C": "cancellations", "M": "delayduration", "P": "pilotreports",
             "R": "maintenancereports"}


def _sums(fact: DataFrame, aircraft_dim: DataFrame, date_dim: DataFrame,
          count_aircraft: bool = True) -> DataFrame:
    """Per (manufacturer, year): the nine measure sums and, if asked, ``n``,
    the number of distinct aircraft with a fact row.

    Without ``n`` this is one aggregation over the star join (partial sums
    before the only shuffle).  With ``n`` it aggregates per (aircraft, year)
    first -- only the date dimension is needed for that -- so the
    manufacturer join sees one row per aircraft and year and the distinct
    count becomes a plain count.
    """
    if not count_aircraft:
        return (star(fact, aircraft_dim, date_dim).groupBy(*GROUP)
                .agg(*[F.sum(col).alias(k) for k, col in _MEASURES.items()]))
    return (_per_aircraft(fact, aircraft_dim, date_dim).groupBy(*GROUP)
            .agg(*[F.sum(k).alias(k) for k in _MEASURES], F.count(F.lit(1)).alias("n")))


def _per_aircraft(fact: DataFrame, aircraft_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    """The measure sums of each aircraft and year, with its manufacturer."""
    per = (dated(fact, date_dim).groupBy("aircraftid", "year")
           .agg(*[F.sum(col).alias(k) for k, col in _MEASURES.items()]))
    return per.join(aircraft_dim.select("aircraftid", "manufacturer"), "aircraftid")


def aircraft_sets(fact: DataFrame, aircraft_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Per (manufacturer, year, bucket of ids): the measure sums and which aircraft have
    a fact row, as a bitmap.  A few rows per manufacturer and year (a bucket holds
    32,768 ids), from which the distinct aircraft of any range of years follow."""
    return (_per_aircraft(fact, aircraft_dim, date_dim)
            .groupBy(*GROUP, F.bitmap_bucket_number("aircraftid").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("aircraftid")).alias("aircraft"),
                 *[F.sum(k).alias(k) for k in _MEASURES]))


def utilization_span(sets: DataFrame, first: int, last: int) -> DataFrame:
    """Utilization per manufacturer over a range of years taken together: the number
    of distinct aircraft (or-ed bitmaps) and the KPIs that don't assume one year."""
    g = (sets.where(F.col("year").between(first, last)).groupBy("manufacturer", "bucket")
         .agg(F.bitmap_or_agg("aircraft").alias("aircraft"), *[F.sum(k).alias(k) for k in _MEASURES])
         .groupBy("manufacturer")
         .agg(F.sum(F.bitmap_count("aircraft")).alias("n"), *[F.sum(k).alias(k) for k in _MEASURES]))
    return g.selectExpr(
        "manufacturer", f"{first} AS first_year", f"{last} AS last_year", "n AS aircraft",
        f"{dec(r(div('H', 'n'), 2))} AS FH",
        f"{dec(r('cast(' + idiv('T', 'n') + ' as double)', 2))} AS TakeOff",
        f"{dec(r(div('S', 'n'), 2))} AS ADOSS",
        f"{dec(r(div('U', 'n'), 2))} AS ADOSU",
        f"{dec('100.0D * ' + r(div('D', 'T'), 4))} AS DYR",
        f"{dec('100.0D * ' + r(div('C', 'T'), 4))} AS CNR",
    ).orderBy("manufacturer")


def utilization_from_sums(g: DataFrame) -> DataFrame:
    """K1-K12 from per-group sums H T S U D C M and aircraft count n."""
    fh = r(div("H", "n"), 2)
    takeoff = r(f"cast({idiv('T', 'n')} as double)", 2)
    ados = r(div("S + U", "n"), 2)
    adis = f"(365.0D - {ados})"
    return g.selectExpr(
        *GROUP,
        f"{dec(fh)} AS FH",
        f"{dec(takeoff)} AS TakeOff",
        f"{dec(r(div('S', 'n'), 2))} AS ADOSS",
        f"{dec(r(div('U', 'n'), 2))} AS ADOSU",
        f"{dec(ados)} AS ADOS",
        f"{dec(adis)} AS ADIS",
        f"{dec(r(div(fh, f'{adis} * 24'), 2))} AS DU",
        f"{dec(r(div(takeoff, adis), 2))} AS DC",
        f"{dec('100.0D * ' + r(div('D', 'T'), 4))} AS DYR",
        f"{dec('100.0D * ' + r(div('C', 'T'), 4))} AS CNR",
        f"{dec('100.0D - ' + r(f'cast({idiv('100 * (D + C)', 'T')} as double)', 2))} AS TDR",
        f"{dec('100.0D * ' + r(div('M', 'D'), 2))} AS ADD",
    )


def rate_sql(reports: str, per: str, scale: float, digits: int, precision_scale: int) -> str:
    """``scale * round(reports / per, digits)`` as DECIMAL(10, precision_scale)."""
    return dec(f"{scale!r}D * {r(div(reports, per), digits)}", 10, precision_scale)


def utilization(fact: DataFrame, aircraft_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Q1: utilization KPIs per manufacturer and year (14 columns)."""
    return utilization_from_sums(_sums(fact, aircraft_dim, date_dim)).orderBy(*GROUP)


def reporting(fact: DataFrame, aircraft_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Q2: reports per 1000 flight hours (RRh) and per 100 cycles (RRc)."""
    g = _sums(fact, aircraft_dim, date_dim, count_aircraft=False)
    return g.selectExpr(
        *GROUP,
        f"{rate_sql('P + R', 'H', 1000.0, 3, 3)} AS RRh",
        f"{rate_sql('P + R', 'T', 100.0, 2, 2)} AS RRc",
    ).orderBy(*GROUP)


def reporting_by_role(fact: DataFrame, aircraft_dim: DataFrame, date_dim: DataFrame) -> DataFrame:
    """Q3: the Q2 rates for PIREP and MAREP separately, one row per role.

    One aggregation yields both roles' rates; ``unpivot`` turns them into
    rows (instead of scanning the fact once per role).
    """
    g = _sums(fact, aircraft_dim, date_dim, count_aircraft=False)

    def rates(col: str) -> str:
        return (f"named_struct('RRh', {rate_sql(col, 'H', 1000.0, 3, 3)}, "
                f"'RRc', {rate_sql(col, 'T', 100.0, 2, 2)})")

    wide = g.selectExpr(*GROUP, f"{rates('P')} AS PIREP", f"{rates('R')} AS MAREP")
    return (
        wide.unpivot(GROUP, ["PIREP", "MAREP"], "role", "rates")
        .select(*GROUP, "role", "rates.RRh", "rates.RRc")
        .orderBy(*GROUP, "role")
    )
