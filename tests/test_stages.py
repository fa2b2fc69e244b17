"""Stages: built once, stored once, published without a further shuffle of the fact."""

from __future__ import annotations

import glob
import threading
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from hangar.plans import etl, store
from hangar.sources import driver_views
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def made(spark):
    """A warehouse that threads asked for all at once, and the stages it stored."""
    stored, together = [], threading.Barrier(6)

    def noted(name, df):
        stored.append(name)
        time.sleep(0.2)
        return etl.from_tables(name, df)

    wh = etl.build(driver_views.load(spark, SF_SMALL), noted)

    def ask(name):
        together.wait()
        return getattr(wh, name)

    names = ["daily_aircraft_stats", "aircraft_sets", "dates", "total_maintenance_reports",
             "overlap_rejects", "reports_valid"]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(ask, names))
    return wh, stored


def test_threads_build_each_stage_once(made):
    _, stored = made
    assert sorted(stored) == sorted(set(stored)) and set(stored) <= set(etl.SHARED_STAGES)


def test_publishing_again_computes_no_stage(spark, made, tmp_path):
    wh, stored = made
    before = len(set(stored) | {"airport_keys", "airports"})
    for run in ("first", "second", "first"):
        etl.publish(spark, wh, str(tmp_path), run, "parquet")
    assert len(stored) == before
    sets = etl.open_sets(spark, str(tmp_path))
    assert sets.exceptAll(wh.aircraft_sets).isEmpty() and sets.count() == wh.aircraft_sets.count()


def test_the_fact_is_laid_out_once(made, tmp_path):
    """Rows of a year and part of the aircraft lie together in the stage, so that
    writing it by year shuffles nothing and sums by aircraft and year combine."""
    wh, _ = made
    plan = wh.stats_by_year._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    part = F.pmod("aircraftid", F.lit(etl.PARTS))
    files = (wh.stats_by_year.select("year", part.alias("part"), F.input_file_name().alias("file")).distinct()
             .groupBy("year", "part").count())
    assert files.where("count > 1").isEmpty()
    store.write_table(wh.stats_by_year, str(tmp_path / "fact"), ("year",))
    years = wh.dates.select("year").distinct().count()
    assert len(glob.glob(str(tmp_path / "fact/*/*.parquet"))) <= years * wh.stats_by_year.rdd.getNumPartitions()


def test_stored_stages_are_read_by_column(made):
    wh, _ = made
    plan = wh.flights_marked.select("overlaps")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<overlaps:boolean>" in plan
