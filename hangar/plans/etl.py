"""The full-refresh pipeline: sources -> rules -> dimensions -> facts -> tables.

``build`` composes every step as lazy DataFrames.  ``run_full_refresh`` adds
the side effects: precondition checks, staged tables in the shared
checkpoint folder (so multi-consumer intermediates are computed once and a
lost executor only re-runs the stage that wrote them), the constraint checks,
the warehouse tables and the reject files.
"""

from __future__ import annotations

import logging
import os
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import cached_property, partial
from threading import RLock

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from hangar import schemas
from hangar.functions.keys import broadcast_calendar
from hangar.operators import checks, dimensions, facts, quality
from hangar.plans import store, warehouse_kpis
from hangar.sources.driver_views import OperationalSources
from hangar.session import staging_path

log = logging.getLogger(__name__)

Materialize = Callable[[str, DataFrame], DataFrame]

# stages read by more than one later stage: these are materialized
SHARED_STAGES = ("aircraft_keys", "airport_keys", "aircrafts", "airports", "flights_swapped",
                 "flights_marked", "reports_marked", "flight_years", "daily_sums", "dates",
                 "daily_aircraft_stats", "aircraft_sets", "total_maintenance_reports")


def lazy(_name: str, df: DataFrame) -> DataFrame:
    """No materialization: one plan from the sources to the result."""
    return df


def checkpointed(name: str, df: DataFrame) -> DataFrame:
    """Stored under ``spark.checkpoint.dir``: cuts the lineage so later plans start
    from the stored rows (and a lost executor does not recompute the stage), and
    keeps every plan small.  Parquet, so later plans read only the columns they use."""
    path = staging_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.parquet(path)


def from_tables(name: str, df: DataFrame) -> DataFrame:
    """``checkpointed``, for sources that are stored tables: the swapped flights are one
    projection of theirs, which is read again sooner than written and read."""
    return df if name == "flights_swapped" else checkpointed(name, df)


class stage(cached_property):
    """An attribute that is built once, also when several threads ask for it at the
    same time: the others wait.  A stage only asks for stages before it, so threads
    never wait for each other in a circle."""

    def __get__(self, instance, owner=None):
        if instance is None:
            return self
        with instance.locks.setdefault(self.attrname, RLock()):
            return super().__get__(instance, owner)


class Warehouse:
    """The warehouse as a set of lazily built stages.

    Each attribute is built on first access from the stages it needs;
    stages in ``SHARED_STAGES`` pass through ``materialize`` once.
    """

    def __init__(self, src: OperationalSources, materialize: Materialize = lazy,
                 overlap_bucket: str = "hour", known_keys: dict[str, DataFrame] | None = None,
                 observe: bool = False):
        self.src = src
        self._materialize = materialize
        self._bucket = overlap_bucket
        self._known = known_keys or {}
        self._observe = observe
        #: Counts taken of the sources while a stage that reads them is written.
        self.seen: dict[str, Observation] = {}
        self.locks: dict[str, RLock] = {}

    def _counted(self, name: str, df: DataFrame, *counts) -> DataFrame:
        if not self._observe:
            return df
        self.seen[name] = Observation(f"{name}_{uuid.uuid4().hex}")
        return df.observe(self.seen[name], *counts)

    def _stage(self, name: str, df: DataFrame) -> DataFrame:
        return self._materialize(name, df) if name in SHARED_STAGES else df

    # -- key maps and dimensions from the lookups
    @stage
    def aircraft_keys(self) -> DataFrame:
        return self._stage("aircraft_keys", dimensions.aircraft_keys(
            self.src.aircraft_lookup, self._known.get("aircraft_keys")))

    @stage
    def airport_keys(self) -> DataFrame:
        return self._stage("airport_keys", dimensions.airport_keys(
            self.src.personnel_lookup, self._known.get("airport_keys")))

    @stage
    def aircrafts(self) -> DataFrame:
        return self._stage("aircrafts", dimensions.aircraft_dimension(
            self.src.aircraft_lookup, self.aircraft_keys))

    @stage
    def airports(self) -> DataFrame:
        return self._stage("airports", dimensions.airport_dimension(
            self.src.personnel_lookup, self.airport_keys))

    # -- flights: swap, then overlap removal
    @stage
    def flights_swapped(self) -> DataFrame:
        """Staged by the one pass over the source; nulls in ``cancelled`` and
        reversed times are counted on the way."""
        counted = self._counted("flights", self.src.flights, *quality.required_counts(["cancelled"]),
                                quality.reversed_count().alias("reversed"))
        return self._stage("flights_swapped", quality.swap_reversed_times(counted))

    @stage
    def flights_marked(self) -> DataFrame:
        """Every flight once, flagged ``overlaps`` (staged: both the clean
        flights and the rejects are filters of it)."""
        return self._stage("flights_marked",
                           quality.mark_overlapping(self.flights_swapped, self._bucket))

    @stage
    def flights_clean(self) -> DataFrame:
        return self.flights_marked.where(~F.col(quality.OVERLAPS)).drop(quality.OVERLAPS)

    @stage
    def overlap_rejects(self) -> DataFrame:
        return self.flights_marked.where(F.col(quality.OVERLAPS)).drop(quality.OVERLAPS)

    # -- reports on known aircraft
    @stage
    def reports_marked(self) -> DataFrame:
        """Every report once, flagged ``known`` (staged: valid reports and rejects
        are filters of it)."""
        counted = self._counted("reports", self.src.reports,
                                *quality.required_counts(["aircraftregistration"]))
        return self._stage("reports_marked", quality.mark_known_aircraft(counted, self.aircrafts))

    @stage
    def reports_known(self) -> DataFrame:
        return self.reports_marked.where(F.col(quality.KNOWN)).drop(quality.KNOWN)

    @stage
    def reports_rejects(self) -> DataFrame:
        return self.reports_marked.where(~F.col(quality.KNOWN)).drop(quality.KNOWN)

    # -- flight years
    @stage
    def flights_dated(self) -> DataFrame:
        return quality.with_flight_day(self.flights_clean)

    @stage
    def flight_years(self) -> DataFrame:
        """At most 9,999 rows; staged because maintenance, reports and the
        per-airport fact all filter on it."""
        return self._stage("flight_years", quality.flight_years(self.flights_dated))

    @stage
    def maintenance_valid(self) -> DataFrame:
        counted = self._counted("maintenance", self.src.maintenance,
                                *quality.required_counts(["programmed"]))
        m = counted.withColumn("_day", F.to_date("scheduleddeparture"))
        return quality.restrict_to_years(m, "_day", self.flight_years).drop("_day")

    @stage
    def reports_valid(self) -> DataFrame:
        return quality.restrict_to_years(self.reports_known, "reportingdate", self.flight_years)

    # -- per-row measures
    @stage
    def flight_measures(self) -> DataFrame:
        return facts.flight_measures(self.flights_dated)

    @stage
    def maintenance_measures(self) -> DataFrame:
        return facts.maintenance_measures(self.maintenance_valid)

    @stage
    def report_measures(self) -> DataFrame:
        return facts.report_measures(self.reports_valid)

    # -- daily sums, date dimension and facts
    @stage
    def daily_sums(self) -> DataFrame:
        """One row per (day, registration) of any input (staged: the date
        dimension, the daily fact and the aircraft totals all read it)."""
        return self._stage("daily_sums", facts.daily_sums(
            self.flight_measures, self.maintenance_measures, self.report_measures))

    @stage
    def dates(self) -> DataFrame:
        return self._stage("dates", dimensions.date_dimension(self.daily_sums))

    @stage
    def stats_by_year(self) -> DataFrame:
        """The daily fact with its year, staged in the order that it is published in."""
        fact = facts.attach_daily_keys(facts.fact_measures(self.daily_sums), self.aircrafts, self.dates)
        return self._stage("daily_aircraft_stats", by_year(with_year(fact, self.dates)))

    @stage
    def daily_aircraft_stats(self) -> DataFrame:
        return self.stats_by_year.drop("year")

    @stage
    def aircraft_sets(self) -> DataFrame:
        return self._stage("aircraft_sets", warehouse_kpis.aircraft_sets(
            self.stats_by_year, self.aircrafts, self.dates))

    @stage
    def total_maintenance_reports(self) -> DataFrame:
        rows = facts.total_maintenance_rows(
            facts.airport_report_totals(facts.marep_counts(self.reports_valid),
                                        self.src.personnel_lookup),
            facts.aircraft_totals(self.daily_sums))
        return self._stage("total_maintenance_reports",
                           facts.attach_total_keys(rows, self.aircrafts, self.airports))


def build(src: OperationalSources, materialize: Materialize = lazy,
          overlap_bucket: str = "hour", known_keys: dict[str, DataFrame] | None = None,
          observe: bool = False) -> Warehouse:
    return Warehouse(src, materialize, overlap_bucket, known_keys, observe)


#: Stages that can run side by side, each in its order; the rest needs them all.
INDEPENDENT = (("flights_swapped", "flights_marked", "flight_years"),
               ("aircraft_keys", "aircrafts", "reports_marked"), ("airport_keys", "airports"))
WAREHOUSE_TABLES = ["aircrafts", "airports", "dates", "daily_aircraft_stats",
                    "total_maintenance_reports"]


#: Sets of aircraft, kept beside the fact.
SETS = "aircraft_sets"
#: Key maps, kept from refresh to refresh beside the tables.
KEY_MAPS = ["aircraft_keys", "airport_keys"]
REJECT_SCHEMAS = {"overlapping_flights": schemas.FLIGHTS, "invalid_reports": schemas.REPORTS,
                  "malformed_lookup_lines": schemas.LOOKUP_REJECTS}


def together(spark: SparkSession, *work: Callable):
    """Runs jobs that don't need each other at the same time: the tail of one leaves
    executors free that the next can use.  The first error is raised at the end."""
    with ThreadPoolExecutor(len(work)) as pool:
        return [job.result() for job in [pool.submit(inheritable_thread_target(spark)(f)) for f in work]]


def with_year(fact: DataFrame, dates: DataFrame) -> DataFrame:
    """The daily fact with the year that it is partitioned by."""
    return fact.join(broadcast_calendar(dates.select("dateid", "year")), "dateid").select(
        *fact.columns, "year")


#: Parts of a year: aircraft by the remainder of their ids.
PARTS = 64


def by_year(fact: DataFrame) -> DataFrame:
    """The fact with year as it is stored: rows of a part of the aircraft and a year are
    brought together (small parts in one task, a large one in several), or each task
    would write a file for each year and hold a few rows of each aircraft."""
    part = F.pmod("aircraftid", F.lit(PARTS))
    return fact.withColumn("_part", part).hint("rebalance", "year", "_part").drop("_part")


def publish(spark: SparkSession, wh: Warehouse, out_dir: str, run: str,
            rejects_format: str = "csv") -> tuple[store.Snapshot, dict[str, str]]:
    """Writes tables, key maps and rejects as a version of ``out_dir`` and shows it."""
    new = store.Publication(spark, out_dir, run, rejects_format)

    def reject(rule: str, df: DataFrame) -> tuple[str, str]:
        spark.sparkContext.setJobDescription(f"hangar refresh: rejects {rule}")
        rows = Observation(f"{rule}_{new.version}")
        path = new.reject(rule, df.observe(rows, F.count(F.lit(1)).alias("n")))
        log.info("rule %s: %d rows rejected", rule, rows.get["n"])
        return f"rejects/{rule}", path

    def table(name: str) -> tuple[str, str]:
        spark.sparkContext.setJobDescription(f"hangar refresh: publish {name}")
        by = store.PARTITIONS.get(name, ())
        return name, new.table(name, wh.stats_by_year if by else getattr(wh, name), by)

    rejects = {"overlapping_flights": wh.overlap_rejects, "invalid_reports": wh.reports_rejects}
    if wh.src.lookup_rejects is not None:
        rejects["malformed_lookup_lines"] = wh.src.lookup_rejects
    written = together(spark, *[partial(reject, rule, df) for rule, df in rejects.items()],
                       *[partial(table, name) for name in [*KEY_MAPS, *WAREHOUSE_TABLES, SETS]])
    return new.commit(), dict(written)


def known_keys(spark: SparkSession, out_dir: str) -> dict[str, DataFrame]:
    """Key maps of the published version (none before the first)."""
    last = store.current(spark, out_dir)
    return store.read_tables(spark, out_dir, last, KEY_MAPS) if last else {}


def run_full_refresh(spark: SparkSession, src: OperationalSources, out_dir: str,
                     run_id: str | None = None, overlap_bucket: str = "hour",
                     rejects_format: str = "csv") -> dict[str, str]:
    """Rebuild the warehouse under ``out_dir`` (S9-S15) and write the rejects.

    All stages, the warehouse tables included, are first written to the shared
    checkpoint folder.  The preconditions (C4/T13: no null ``cancelled``,
    ``programmed`` or report registration) are counted by the stages that read the
    sources, so each source is read once; a null fails the run after that stage.
    The declared constraints (C1-C3) are checked on the staged tables, and a
    violation stops the run with the rules and their counts.  Then tables, key maps
    (ids given to an aircraft or airport stay) and rejects are written as a new
    version, which replaces the last one at once (``store``); whatever fails before
    that leaves the published warehouse as it is.  Rejects are CSV with a header
    like the operational logs (``rejects_format`` "parquet" suits very large runs).
    The staged copies go at the end, also of a failed run.  Returns the written
    paths by table name.
    """
    run = run_id or uuid.uuid4().hex[:12]
    staging = os.path.dirname(staging_path(spark, "any", f"{run}-{uuid.uuid4().hex[:8]}"))

    def materialize(name: str, df: DataFrame) -> DataFrame:
        path = os.path.join(staging, name)
        spark.sparkContext.setJobDescription(f"hangar refresh: {name}")
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    wh = build(src, materialize, overlap_bucket, known_keys(spark, out_dir), observe=True)
    def stages(*names: str) -> None:
        for name in names:
            getattr(wh, name)
            for table in [t for t in REQUIRED if t in wh.seen and name == REQUIRED[t][0]]:
                counts = wh.seen[table].get
                quality.refuse_nulls({c: counts[c] for c in REQUIRED[table][1:]}, table)

    try:
        together(spark, *[partial(stages, *names) for names in INDEPENDENT])
        stages("daily_sums", "dates")
        together(spark, partial(stages, "daily_aircraft_stats"), partial(stages, "total_maintenance_reports"))
        log.info("rule BR-22: %d flights with reversed times were swapped", wh.seen["flights"].get["reversed"])
        spark.sparkContext.setJobDescription("hangar refresh: constraints")
        tables = {name: getattr(wh, name) for name in WAREHOUSE_TABLES}
        found = together(spark, *[check(tables).where("violations > 0").collect for check in checks.ALL])
        broken = [r for rules in found for r in rules]  # one row per rule
        if broken:
            raise ValueError("the new warehouse breaks its constraints, nothing was published: "
                             + ", ".join(f"{r.rule} ({r.violations})" for r in broken))
        _, written = publish(spark, wh, out_dir, run, rejects_format)
    finally:
        spark.sparkContext.setJobDescription(None)
        store.delete_folder(spark, staging)
    log.info("warehouse refreshed under %s", out_dir)
    return written


#: Stage that reads a source, and the columns that may hold no null.
REQUIRED = {"flights": ("flights_swapped", "cancelled"),
            "reports": ("reports_marked", "aircraftregistration"),
            "maintenance": ("daily_sums", "programmed")}


def open_warehouse(spark: SparkSession, out_dir: str, register_views: bool = True) -> dict[str, DataFrame]:
    """Open the published warehouse for querying (optionally as temp views).

    The pointer is read once, so all tables are of one refresh, and stay so while
    later ones publish; columns and types are checked against the declared ones.
    """
    snapshot = store.current(spark, out_dir)
    if snapshot is None:
        raise ValueError(f"{out_dir}: no warehouse was published here")
    tables = store.read_tables(spark, out_dir, snapshot, WAREHOUSE_TABLES)
    if register_views:
        for name, df in tables.items():
            df.createOrReplaceTempView(name)
    return tables


def open_sets(spark: SparkSession, out_dir: str) -> DataFrame:
    """The sets of aircraft of the published warehouse."""
    snapshot = store.current(spark, out_dir)
    if snapshot is None:
        raise ValueError(f"{out_dir}: no warehouse was published here")
    return store.read_tables(spark, out_dir, snapshot, [SETS])[SETS]


def read_rejects(spark: SparkSession, out_dir: str, rule: str) -> DataFrame:
    """The rejected rows of all runs, with their ``run``."""
    return store.read_rejects(spark, out_dir, rule, REJECT_SCHEMAS[rule])
