"""Dimensions (D1-D3) with surrogate keys numbered in natural-key order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangar.functions.keys import extended_ids, ordered_ids
from hangar.functions.temporal import month_key


def rename_aircraft_lookup(lookup: DataFrame) -> DataFrame:
    """Lookup columns -> warehouse names; the serial number is dropped."""
    return lookup.select(
        F.col("aircraft_reg_code").alias("aircraftregistration"),
        F.col("aircraft_model").alias("model"),
        F.col("aircraft_manufacturer").alias("manufacturer"),
    )


def rename_personnel_lookup(lookup: DataFrame) -> DataFrame:
    """P2 + A10: (reporteurid, airportcode), distinct pairs."""
    return lookup.select(
        F.col("reporteurid"), F.col("airport").alias("airportcode")
    ).dropDuplicates(["reporteurid", "airportcode"])


def aircraft_keys(lookup: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(aircraftid, aircraftregistration) of every registration seen so far."""
    keys = rename_aircraft_lookup(lookup).select("aircraftregistration").where(
        F.col("aircraftregistration").isNotNull()).distinct()
    return extended_ids(known, keys, "aircraftid", "aircraftregistration",
                        F.substring("aircraftregistration", 1, 4))


def airport_keys(personnel: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(airportid, airportcode) of every airport seen so far."""
    codes = rename_personnel_lookup(personnel).select("airportcode").where(
        F.col("airportcode").isNotNull()).distinct()
    return extended_ids(known, codes, "airportid", "airportcode", F.substring("airportcode", 1, 1))


def aircraft_dimension(lookup: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """One row per registration of the lookup, with its id from ``keys`` (by
    default a first refresh: 1..n by registration).

    Insert-if-absent semantics: the first row of a registration wins.  Input
    order does not exist in a distributed read, so on duplicate keys the
    smallest (model, manufacturer) is kept -- a map-side ``min`` aggregate.
    """
    first = (
        rename_aircraft_lookup(lookup)
        .where(F.col("aircraftregistration").isNotNull())
        .groupBy("aircraftregistration")
        .agg(F.min(F.struct("model", "manufacturer")).alias("_first"))
        .select("aircraftregistration", "_first.model", "_first.manufacturer")
    )
    keys = aircraft_keys(lookup) if keys is None else keys
    return first.join(keys, "aircraftregistration").select(
        "aircraftid", "aircraftregistration", "model", "manufacturer")


def airport_dimension(personnel: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """One row per airport code of the lookup, with its id from ``keys`` (by
    default a first refresh: 1..n by code)."""
    keys = airport_keys(personnel) if keys is None else keys
    codes = rename_personnel_lookup(personnel).select("airportcode").distinct()
    return keys.join(codes, "airportcode", "left_semi").select("airportid", "airportcode")


def date_dimension(*day_sets: DataFrame) -> DataFrame:
    """D3 (U1/A11/O4): distinct days of all inputs (each a ``date`` column),
    with month key YYYYMM and year; ids 1..n in date order."""
    days = None
    for ds in day_sets:
        d = ds.select("date").where(F.col("date").isNotNull())
        days = d if days is None else days.unionByName(d)
    days = days.distinct()
    return ordered_ids(days, "dateid", ["date"], F.year("date")).select(
        "dateid", "date", month_key("date").alias("month"), F.year("date").alias("year")
    )
