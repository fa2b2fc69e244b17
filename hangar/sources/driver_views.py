"""Operational sources derived from the driver's TPC-H-style tables.

The test harness ships ``supplier customer lineitem orders ...`` parquet
tables, not an airline's operational database.  This module derives the five
operational inputs from them with plain column expressions, so every query
reads the given tables and its work grows with them:

* aircraft lookup  <- supplier (every 7th supplier left out: unknown aircraft)
* personnel lookup <- customer (every 13th left out: unmatched reporters)
* flights          <- lineitem (one flight per line item)
* maintenance      <- orders
* post-flight reports <- orders

The mapping is fixed (the DuckDB oracle repeats it as CTEs); its constants
are listed together below.  All outputs carry the operational column names
and types of ``hangar.schemas``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---- fixed values of the mapping (must equal the oracle's) -------------
AIRCRAFT_SKIP_MOD, AIRCRAFT_SKIP_REM = 7, 3  # supplier keys left out of the lookup
PERSONNEL_SKIP_MOD = 13  # customer keys left out of the personnel lookup
NULL_REG_MOD, NULL_REG_REM = 983, 3  # flights with a null registration
NULL_ARRIVAL_MOD, NULL_ARRIVAL_REM = 991, 2  # flights with a null actual arrival
NULL_SCHED_DEP_MOD, NULL_SCHED_DEP_REM = 997, 1  # flights with a null scheduled departure
SWAP_LINENUMBER, SWAP_MOD = 7, 5  # flights whose actual times are recorded swapped
FAR_FUTURE_MOD = 50  # maintenance (rem 1) and reports (rem 0) shifted 3650 days
FAR_FUTURE_MINUTES = 5_256_000
NULL_MAINT_ARRIVAL_MOD, NULL_MAINT_ARRIVAL_REM = 499, 4
NULL_REPORTER_MOD, NULL_REPORTER_REM = 487, 5
PIREP_PRIORITIES = ("1-URGENT", "2-HIGH")
OTHER_PRIORITY = "5-LOW"


@dataclass(frozen=True)
class OperationalSources:
    flights: DataFrame
    maintenance: DataFrame
    reports: DataFrame
    aircraft_lookup: DataFrame
    personnel_lookup: DataFrame
    #: (lookup, line): malformed lines, where the lookups are read from CSV files.
    lookup_rejects: DataFrame | None = None


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _minutes(e: Column) -> Column:
    return e.cast("int") * F.expr("INTERVAL '1' MINUTE")


def _padded(prefix: str, value: Column, width: int) -> Column:
    """Prefix and number, zero-padded to at least ``width`` digits (null stays null)."""
    number = value.cast("bigint")
    digits = number.cast("string")
    zeros = F.repeat(F.lit("0"), F.lit(width) - F.length(digits))
    return F.when(number < 0, F.format_string(f"{prefix}%0{width}d", number)).otherwise(
        F.concat(F.lit(prefix), zeros, digits))


def aircraft_lookup(supplier: DataFrame) -> DataFrame:
    """Aircraft lookup in its CSV layout (registration, serial, model, maker)."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    return supplier.where(key % AIRCRAFT_SKIP_MOD != AIRCRAFT_SKIP_REM).select(
        _padded("XY-", key, 3).alias("aircraft_reg_code"),
        _padded("MSN", key, 6).alias("manufacturer_serial_number"),
        _padded("M", nation, 2).alias("aircraft_model"),
        F.when(nation % 2 == 0, F.lit("Airbus")).otherwise(F.lit("Boeing")).alias(
            "aircraft_manufacturer"
        ),
    )


def personnel_lookup(customer: DataFrame) -> DataFrame:
    """Maintenance personnel lookup (reporteurid, airport)."""
    return customer.where(F.col("c_custkey") % PERSONNEL_SKIP_MOD != 0).select(
        F.col("c_custkey").alias("reporteurid"),
        _padded("N", F.col("c_nationkey"), 2).alias("airport"),
    )


def flights(lineitem: DataFrame) -> DataFrame:
    ok = F.col("l_orderkey")
    sd = F.col("l_shipdate") + _minutes((F.col("l_partkey") * 37) % 1440)
    dur = (60 + F.col("l_quantity") * 12).cast("int")
    dly = ((ok * 13 + F.col("l_linenumber") * 101) % 480).cast("int") - 60
    cancelled = (F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")
    swp = (F.col("l_linenumber") == SWAP_LINENUMBER) & (ok % SWAP_MOD == 0)
    sa, d0, a0 = sd + _minutes(dur), sd + _minutes(dly), sd + _minutes(dur + dly)
    return lineitem.select(
        F.when(ok % NULL_REG_MOD == NULL_REG_REM, F.lit(None))
        .otherwise(_padded("XY-", F.col("l_suppkey"), 3))
        .alias("aircraftregistration"),
        cancelled.alias("cancelled"),
        F.when(cancelled, F.lit(None)).when(swp, a0).otherwise(d0).alias("actualdeparture"),
        F.when(cancelled | (ok % NULL_ARRIVAL_MOD == NULL_ARRIVAL_REM), F.lit(None))
        .when(swp, d0)
        .otherwise(a0)
        .alias("actualarrival"),
        F.when(ok % NULL_SCHED_DEP_MOD == NULL_SCHED_DEP_REM, F.lit(None))
        .otherwise(sd)
        .alias("scheduleddeparture"),
        sa.alias("scheduledarrival"),
    )


def maintenance(orders: DataFrame, n_aircraft_keys: Column) -> DataFrame:
    ok = F.col("o_orderkey")
    shift = F.when(ok % FAR_FUTURE_MOD == 1, F.lit(FAR_FUTURE_MINUTES)).otherwise(F.lit(0))
    start = F.col("o_orderdate") + _minutes((ok % 24) * 60 + shift)
    end = F.col("o_orderdate") + _minutes((ok % 24 + 1 + ok % 60) * 60 + shift)
    return orders.select(
        _padded("XY-", F.col("o_custkey") % n_aircraft_keys, 3).alias("aircraftregistration"),
        start.alias("scheduleddeparture"),
        F.when(ok % NULL_MAINT_ARRIVAL_MOD == NULL_MAINT_ARRIVAL_REM, F.lit(None))
        .otherwise(end)
        .alias("scheduledarrival"),
        (F.col("o_orderstatus") == "F").alias("programmed"),
    )


def reports(orders: DataFrame, n_aircraft_keys: Column) -> DataFrame:
    ok, prio = F.col("o_orderkey"), F.col("o_orderpriority")
    shift = F.when(ok % FAR_FUTURE_MOD == 0, F.lit(FAR_FUTURE_MINUTES)).otherwise(F.lit(0))
    return orders.select(
        _padded("XY-", (ok * 7) % n_aircraft_keys, 3).alias("aircraftregistration"),
        F.to_date(F.col("o_orderdate") + _minutes(shift)).alias("reportingdate"),
        F.when(prio.isin(*PIREP_PRIORITIES), F.lit("PIREP"))
        .when(prio == OTHER_PRIORITY, F.lit("OTHER"))
        .otherwise(F.lit("MAREP"))
        .alias("reporteurclass"),
        F.when(ok % NULL_REPORTER_MOD == NULL_REPORTER_REM, F.lit(None))
        .otherwise(F.col("o_custkey"))
        .alias("reporteurid"),
    )


def load(spark: SparkSession, sf_dir: str) -> OperationalSources:
    """All five operational inputs for one scale-factor folder (lazy)."""
    supplier = _table(spark, sf_dir, "supplier")
    orders = _table(spark, sf_dir, "orders")
    # scalar subquery (evaluated once, no join): number of supplier rows
    n_keys = supplier.select(F.count(F.lit(1))).scalar()
    return OperationalSources(
        flights=flights(_table(spark, sf_dir, "lineitem")),
        maintenance=maintenance(orders, n_keys),
        reports=reports(orders, n_keys),
        aircraft_lookup=aircraft_lookup(supplier),
        personnel_lookup=personnel_lookup(_table(spark, sf_dir, "customer")),
    )
