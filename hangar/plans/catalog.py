"""Registry of every query the library answers, over the driver's tables.

Each entry takes ``(spark, sf_dir)`` and returns a lazy DataFrame built from
the tables in ``sf_dir`` (mapped to the operational sources by
``hangar.sources.driver_views``).  Keys match ``hangar.oracles.ORACLES``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hangar import schemas
from hangar.operators import checks, dimensions, facts
from hangar.plans import source_kpis, warehouse_kpis
from hangar.plans.etl import Warehouse, build, checkpointed, from_tables, open_sets, open_warehouse, publish, read_rejects
from hangar.session import staging_path
from hangar.sources import driver_views, text_inputs
from hangar.sources.readers import coerce_personnel, read_lookup, registrations_per_manufacturer

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _src(spark: SparkSession, sf_dir: str) -> driver_views.OperationalSources:
    return driver_views.load(spark, sf_dir)


_BUILT: dict[tuple, Warehouse] = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and time of the tables that the warehouse is built from."""
    sc, out = spark.sparkContext, []
    for name in ("supplier", "customer", "lineitem", "orders"):
        path = sc._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{name}.parquet")
        fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
        out.append((fs.getContentSummary(path).getLength(),
                    fs.getFileStatus(path).getModificationTime()))
    return tuple(out)


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    """Warehouse stages over ``sf_dir``; shared stages are checkpointed.

    One build per application and state of the folder: later queries of the
    same session start from the checkpointed stages instead of rebuilding them,
    and tables that were rewritten are read anew.  The first query to ask for a
    stage pays for it.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _state(spark, sf_dir))
    if key not in _BUILT:
        _BUILT[key] = build(_src(spark, sf_dir), from_tables)
    return _BUILT[key]


_STORED: dict[tuple, str] = {}


def _stored(spark: SparkSession, sf_dir: str) -> str:
    """Folder of a published warehouse over ``sf_dir`` (once per application and
    state of the tables), with a log of rejects of two runs, one of them repeated."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), _state(spark, sf_dir))
    if key not in _STORED:
        root = staging_path(spark, "warehouse")
        for run in ("first", "second", "first"):
            publish(spark, _wh(spark, sf_dir), root, run, rejects_format="parquet")
        _STORED[key] = root
    return _STORED[key]


# ---- sources ---------------------------------------------------------------

@query("scan_flights")
def scan_flights(spark, sf_dir):
    return _src(spark, sf_dir).flights


@query("scan_maintenance")
def scan_maintenance(spark, sf_dir):
    return _src(spark, sf_dir).maintenance


@query("scan_reports")
def scan_reports(spark, sf_dir):
    return _src(spark, sf_dir).reports


@query("registrations_per_manufacturer")
def registrations(spark, sf_dir):
    return registrations_per_manufacturer(_src(spark, sf_dir).aircraft_lookup)


# ---- dimensions --------------------------------------------------------------

@query("dim_aircraft")
def dim_aircraft(spark, sf_dir):
    return _wh(spark, sf_dir).aircrafts


@query("dim_airport")
def dim_airport(spark, sf_dir):
    return _wh(spark, sf_dir).airports


@query("dim_date")
def dim_date(spark, sf_dir):
    return _wh(spark, sf_dir).dates


# ---- quality rules -----------------------------------------------------------

@query("swap_times")
def swap_times(spark, sf_dir):
    return _wh(spark, sf_dir).flights_swapped


@query("overlap_clean")
def overlap_clean(spark, sf_dir):
    return _wh(spark, sf_dir).flights_clean


@query("overlap_rejects")
def overlap_rejects(spark, sf_dir):
    return _wh(spark, sf_dir).overlap_rejects


@query("reports_valid")
def reports_valid(spark, sf_dir):
    return _wh(spark, sf_dir).reports_known


@query("reports_rejects")
def reports_rejects(spark, sf_dir):
    return _wh(spark, sf_dir).reports_rejects


@query("valid_years_reports")
def valid_years_reports(spark, sf_dir):
    return _wh(spark, sf_dir).reports_valid


@query("valid_years_maintenance")
def valid_years_maintenance(spark, sf_dir):
    return _wh(spark, sf_dir).maintenance_valid


# ---- measures and aggregates -------------------------------------------------

@query("flight_measures")
def flight_measures(spark, sf_dir):
    return _wh(spark, sf_dir).flight_measures


@query("daily_flights")
def daily_flights(spark, sf_dir):
    return facts.daily_flights(_wh(spark, sf_dir).flight_measures)


@query("daily_maintenance")
def daily_maintenance(spark, sf_dir):
    return facts.daily_maintenance(_wh(spark, sf_dir).maintenance_measures)


@query("daily_reports")
def daily_reports(spark, sf_dir):
    return facts.daily_reports(_wh(spark, sf_dir).report_measures)


@query("fact_daily")
def fact_daily(spark, sf_dir):
    return _wh(spark, sf_dir).daily_aircraft_stats


@query("fact_daily_join_form")
def fact_daily_join_form(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    daily = facts.daily_measures_join_form(wh.flight_measures, wh.maintenance_measures,
                                           wh.report_measures)
    return facts.attach_daily_keys(daily, wh.aircrafts, wh.dates)


@query("aircraft_totals")
def aircraft_totals(spark, sf_dir):
    t = facts.aircraft_totals(_wh(spark, sf_dir).flight_measures)
    return t.select("aircraftregistration", F.col("takeoffs").cast("bigint").alias("takeoffs"),
                    (F.col("flight_us").cast("double") / F.lit(3.6e9)).cast("float")
                    .alias("flighthours"))


@query("marep_counts")
def marep_counts(spark, sf_dir):
    return facts.marep_counts(_wh(spark, sf_dir).reports_valid)


@query("fact_total_maintenance")
def fact_total_maintenance(spark, sf_dir):
    return _wh(spark, sf_dir).total_maintenance_reports


# ---- KPI queries -------------------------------------------------------------

@query("kpi_utilization")
def kpi_utilization(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return warehouse_kpis.utilization(wh.daily_aircraft_stats, wh.aircrafts, wh.dates)


@query("kpi_reporting")
def kpi_reporting(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return warehouse_kpis.reporting(wh.daily_aircraft_stats, wh.aircrafts, wh.dates)


@query("kpi_reporting_by_role")
def kpi_reporting_by_role(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return warehouse_kpis.reporting_by_role(wh.daily_aircraft_stats, wh.aircrafts, wh.dates)


# ---- the stored warehouse ------------------------------------------------------

FIRST_YEAR, LAST_YEAR = 1994, 1996


@query("kpi_utilization_years")
def kpi_utilization_years(spark, sf_dir):
    """Q1 of a range of years on the fact stored by year: only their partitions are read."""
    t = open_warehouse(spark, _stored(spark, sf_dir), register_views=False)
    return warehouse_kpis.utilization(
        t["daily_aircraft_stats"], t["aircrafts"],
        warehouse_kpis.in_years(t["dates"], FIRST_YEAR, LAST_YEAR))


@query("kpi_utilization_span")
def kpi_utilization_span(spark, sf_dir):
    """Utilization over a range of years as a whole, from the stored sets of aircraft."""
    return warehouse_kpis.utilization_span(
        open_sets(spark, _stored(spark, sf_dir)), FIRST_YEAR, LAST_YEAR)


@query("overlap_rejects_log")
def overlap_rejects_log(spark, sf_dir):
    """S7 over all runs."""
    return read_rejects(spark, _stored(spark, sf_dir), "overlapping_flights")


@query("reports_rejects_log")
def reports_rejects_log(spark, sf_dir):
    """S8 over all runs."""
    return read_rejects(spark, _stored(spark, sf_dir), "invalid_reports")


@query("dim_aircraft_kept_ids")
def dim_aircraft_kept_ids(spark, sf_dir):
    """D1 after a refresh that knew the Boeing aircraft only."""
    lookup = _src(spark, sf_dir).aircraft_lookup
    before = dimensions.aircraft_keys(lookup.where("aircraft_manufacturer = 'Boeing'"))
    return dimensions.aircraft_dimension(
        lookup, dimensions.aircraft_keys(lookup, checkpointed("aircraft_keys", before)))


@query("dim_airport_kept_ids")
def dim_airport_kept_ids(spark, sf_dir):
    """D2 after a refresh that knew the airports after N12 only."""
    lookup = _src(spark, sf_dir).personnel_lookup
    before = dimensions.airport_keys(lookup.where("airport > 'N12'"))
    return dimensions.airport_dimension(
        lookup, dimensions.airport_keys(lookup, checkpointed("airport_keys", before)))


@query("source_manufacturer")
def source_manufacturer(spark, sf_dir):
    s = _src(spark, sf_dir)
    regs = s.flights.select("aircraftregistration").unionByName(
        s.maintenance.select("aircraftregistration")).unionByName(
        s.reports.select("aircraftregistration")).distinct()
    return source_kpis.with_manufacturer(regs, s.aircraft_lookup)


@query("source_atomic")
def source_atomic(spark, sf_dir):
    s = _src(spark, sf_dir)
    return source_kpis.source_atomic(s.flights, s.maintenance, s.aircraft_lookup)


@query("source_utilization")
def source_utilization(spark, sf_dir):
    s = _src(spark, sf_dir)
    return source_kpis.utilization(s.flights, s.maintenance, s.aircraft_lookup)


@query("source_reporting")
def source_reporting(spark, sf_dir):
    s = _src(spark, sf_dir)
    return source_kpis.reporting(s.flights, s.reports, s.aircraft_lookup)


@query("source_reporting_by_role")
def source_reporting_by_role(spark, sf_dir):
    s = _src(spark, sf_dir)
    return source_kpis.reporting_by_role(s.flights, s.reports, s.aircraft_lookup)


# ---- integrity checks and text coercion ---------------------------------------

def _tables(spark, sf_dir):
    wh = _wh(spark, sf_dir)
    return {"aircrafts": wh.aircrafts, "dates": wh.dates, "airports": wh.airports,
            "daily_aircraft_stats": wh.daily_aircraft_stats,
            "total_maintenance_reports": wh.total_maintenance_reports}


@query("check_nulls")
def check_nulls(spark, sf_dir):
    return checks.not_null_violations(_tables(spark, sf_dir))


@query("check_keys")
def check_keys(spark, sf_dir):
    return checks.key_violations(_tables(spark, sf_dir))


@query("check_refs")
def check_refs(spark, sf_dir):
    return checks.reference_violations(_tables(spark, sf_dir))


@query("csv_text_dates")
def csv_text_dates(spark, sf_dir):
    return text_inputs.text_dates(spark.read.parquet(f"{sf_dir}/orders.parquet"))


@query("csv_text_ids")
def csv_text_ids(spark, sf_dir):
    return text_inputs.text_ids(spark.read.parquet(f"{sf_dir}/orders.parquet"))


def _lookup_csv(spark, sf_dir):
    """The personnel CSV with malformed lines, as a file of this session's staging."""
    path = staging_path(spark, "personnel_csv")
    text_inputs.lookup_lines(spark.read.parquet(f"{sf_dir}/customer.parquet")).write.text(path)
    return read_lookup(spark, path, schemas.PERSONNEL_LOOKUP_TEXT, header=False)


@query("csv_lookup_rows")
def csv_lookup_rows(spark, sf_dir):
    return coerce_personnel(_lookup_csv(spark, sf_dir)[0])


@query("csv_lookup_rejects")
def csv_lookup_rejects(spark, sf_dir):
    return _lookup_csv(spark, sf_dir)[1]
