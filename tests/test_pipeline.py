"""Full refresh on the sf0.001 tables: write, reopen, check, query."""

from __future__ import annotations

import dataclasses
import os
import tempfile

import pytest

from hangar.operators import checks
from hangar.plans import etl, warehouse_kpis
from hangar.session import staging_path
from hangar.sources import driver_views
from tests.conftest import SF_SMALL


def test_full_refresh_writes_a_consistent_warehouse(spark):
    out = tempfile.mkdtemp(prefix="hangar-wh-")
    written = etl.run_full_refresh(spark, driver_views.load(spark, SF_SMALL), out)
    for name in etl.WAREHOUSE_TABLES:
        assert os.path.isdir(written[name])
    tables = etl.open_warehouse(spark, out)
    assert tables["aircrafts"].count() == 9
    assert tables["airports"].count() == 25
    assert tables["dates"].count() == 2380
    assert tables["daily_aircraft_stats"].count() == 6617
    assert tables["total_maintenance_reports"].count() == 193
    assert spark.read.csv(written["rejects/overlapping_flights"], header=True).count() == 262
    assert spark.read.csv(written["rejects/invalid_reports"], header=True).count() == 150
    violations = checks.all_violations(tables).where("violations > 0").collect()
    assert violations == []
    q1 = warehouse_kpis.utilization(tables["daily_aircraft_stats"], tables["aircrafts"],
                                    tables["dates"])
    assert q1.count() == 14
    # reports total preserved into the per-airport fact
    assert tables["total_maintenance_reports"].agg({"reports": "sum"}).first()[0] == 502


def test_refresh_refuses_broken_tables_and_keeps_rejects(spark):
    out = tempfile.mkdtemp(prefix="hangar-wh-")
    src = driver_views.load(spark, SF_SMALL)
    first = etl.run_full_refresh(spark, src, out, run_id="one")
    bad = src.aircraft_lookup.unionByName(spark.range(1).selectExpr(
        "'XY-NEW' AS aircraft_reg_code", "'1' AS manufacturer_serial_number",
        "cast(null AS string) AS aircraft_model", "cast(null AS string) AS aircraft_manufacturer"))
    with pytest.raises(ValueError, match=r"not_null:aircrafts.model \(1\)"):
        etl.run_full_refresh(spark, dataclasses.replace(src, aircraft_lookup=bad), out, run_id="bad")
    assert etl.open_warehouse(spark, out)["aircrafts"].count() == 9
    second = etl.run_full_refresh(spark, src, out, run_id="two")
    for rule in ("rejects/overlapping_flights", "rejects/invalid_reports"):
        log = os.path.dirname(os.path.dirname(first[rule]))
        assert log == os.path.dirname(os.path.dirname(second[rule]))
        assert sorted(os.listdir(log)) == ["run=one", "run=two"]
    staging = os.path.dirname(os.path.dirname(staging_path(spark, "x", "two")))
    assert not any(name.startswith(("one-", "bad-", "two-")) for name in os.listdir(staging))


def test_entry_smoke(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() == 14
    from hangar.plans.catalog import QUERIES

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())
