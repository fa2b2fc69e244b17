"""Versions of the warehouse, ids that stay, the log of rejects, observed counts."""

from __future__ import annotations

import dataclasses
import os

import pytest
from pyspark.sql import functions as F

from hangar import schemas
from hangar.plans import etl, store, warehouse_kpis
from hangar.sources import driver_views, readers
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def src(spark, tmp_path_factory):
    """The operational sources as stored tables."""
    root = str(tmp_path_factory.mktemp("sources"))
    mapped = driver_views.load(spark, SF_SMALL)
    tables = {}
    for f in dataclasses.fields(mapped):
        if getattr(mapped, f.name) is None:
            continue
        getattr(mapped, f.name).write.parquet(f"{root}/{f.name}")
        tables[f.name] = spark.read.parquet(f"{root}/{f.name}")
    return driver_views.OperationalSources(**tables)


def kpis(tables):
    args = tables["daily_aircraft_stats"], tables["aircrafts"], tables["dates"]
    return [q(*args).collect() for q in (warehouse_kpis.utilization, warehouse_kpis.reporting,
                                         warehouse_kpis.reporting_by_role)]


def aircraft(spark, *names):
    return spark.createDataFrame([(n, "1", "M1", "Airbus") for n in names], schemas.AIRCRAFT_LOOKUP)


def test_failure_midway_leaves_the_old_warehouse_whole(spark, src, tmp_path, monkeypatch):
    out = str(tmp_path)
    etl.run_full_refresh(spark, src, out, run_id="one")
    before, want = store.current(spark, out), kpis(etl.open_warehouse(spark, out))
    fewer = dataclasses.replace(src, flights=src.flights.where("not cancelled"))
    writes, write = [], store.write_table

    def third_fails(df, path, by=()):
        writes.append(path)
        if len(writes) == 3:
            raise OSError("no space")
        write(df, path, by)

    monkeypatch.setattr(store, "write_table", third_fails)
    with pytest.raises(OSError, match="no space"):
        etl.run_full_refresh(spark, fewer, out, run_id="two")
    assert store.current(spark, out) == before
    assert kpis(etl.open_warehouse(spark, out)) == want
    assert [r.run for r in etl.read_rejects(spark, out, "overlapping_flights").select("run").distinct().collect()] == ["one"]
    monkeypatch.undo()
    etl.run_full_refresh(spark, fewer, out, run_id="three")
    assert kpis(etl.open_warehouse(spark, out)) != want
    # what the failed refresh left is gone
    assert not any(v.startswith("two-") for v in os.listdir(f"{out}/versions"))
    assert not os.listdir(f"{out}/rejects/invalid_reports/run=two")


@pytest.fixture(scope="module")
def built(spark, src):
    """Stages of the whole sources, and of a few rows of them."""
    few = dataclasses.replace(src, flights=src.flights.limit(100), reports=src.reports.limit(50))
    return etl.build(src, etl.checkpointed), etl.build(few, etl.checkpointed)


def test_readers_keep_the_version_they_opened(spark, built, tmp_path):
    out, (whole, few) = str(tmp_path), built
    etl.publish(spark, whole, out, "one")
    opened = etl.open_warehouse(spark, out)
    want = kpis(opened)
    etl.publish(spark, few, out, "two")
    assert kpis(opened) == want
    assert kpis(etl.open_warehouse(spark, out)) != want


def test_ids_stay_when_an_aircraft_that_sorts_first_comes(spark, src, tmp_path):
    out = str(tmp_path)
    etl.run_full_refresh(spark, src, out)
    ids = lambda: {r.aircraftregistration: r.aircraftid for r in etl.open_warehouse(spark, out)["aircrafts"].collect()}
    first = ids()
    gone = min(first)
    lookup = src.aircraft_lookup.where(F.col("aircraft_reg_code") != gone)
    etl.run_full_refresh(spark, dataclasses.replace(
        src, aircraft_lookup=lookup.unionByName(aircraft(spark, "AA-001", "ZZ-001"))), out)
    second = ids()
    assert second == {k: v for k, v in first.items() if k != gone} | {
        "AA-001": len(first) + 1, "ZZ-001": len(first) + 2}
    # an aircraft that comes back has the id it had, and no id is given twice
    etl.run_full_refresh(spark, dataclasses.replace(
        src, aircraft_lookup=src.aircraft_lookup.unionByName(aircraft(spark, "BB-001"))), out)
    assert ids() == first | {"BB-001": len(first) + 3}
    fact = etl.open_warehouse(spark, out)["daily_aircraft_stats"]
    assert fact.where(F.col("aircraftid") == first[gone]).count() > 0


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_rejects_are_a_log_of_runs(spark, built, tmp_path, fmt):
    out, (whole, few) = str(tmp_path), built
    assert etl.read_rejects(spark, out, "invalid_reports").count() == 0
    for run, stages in (("a", whole), ("b", few), ("c", whole), ("a", few)):
        etl.publish(spark, stages, out, run, fmt)
    log = etl.read_rejects(spark, out, "invalid_reports")
    assert log.columns == [*schemas.REPORTS.names, "run"]
    counts = {r.run: r["count"] for r in log.groupBy("run").count().collect()}
    assert counts["a"] == counts["b"] < counts["c"] == 150  # the repeated run replaced its part
    flights = etl.read_rejects(spark, out, "overlapping_flights").where("run = 'c'").drop("run")
    assert sorted(map(str, flights.collect())) == sorted(map(str, whole.overlap_rejects.collect()))
    with pytest.raises(ValueError, match="log of rejects"):
        store.Publication(spark, out, "d", "orc")


def test_old_versions_go_and_their_part_of_the_log_stays(spark, built, tmp_path):
    out = str(tmp_path)
    for run in "abcd":
        etl.publish(spark, built[1], out, run)
    assert sorted(v[0] for v in os.listdir(f"{out}/versions")) == ["b", "c", "d"]
    runs = etl.read_rejects(spark, out, "invalid_reports").select("run").distinct().collect()
    assert sorted(r.run for r in runs) == list("abcd")


def test_a_refresh_does_not_overwrite_one_that_came_between(spark, built, tmp_path):
    slow = store.Publication(spark, str(tmp_path), "slow")
    slow.table("aircrafts", built[0].aircrafts)
    etl.publish(spark, built[1], str(tmp_path), "quick")
    with pytest.raises(ValueError, match="published meanwhile"):
        slow.commit()
    assert store.current(spark, str(tmp_path)).version.startswith("quick-")


def test_opening_checks_pointer_and_schemas(spark, built, tmp_path):
    out = str(tmp_path)
    with pytest.raises(ValueError, match="no warehouse"):
        etl.open_warehouse(spark, out)
    bad = store.Publication(spark, out, "bad")
    for name in etl.WAREHOUSE_TABLES:
        by = store.PARTITIONS.get(name, ())
        df = getattr(built[1], name)
        df = etl.with_year(df, built[1].dates) if by else df
        bad.table(name, df.withColumn("airportid", F.col("airportid").cast("bigint"))
                  if name == "airports" else df, by)
    bad.commit()
    with pytest.raises(ValueError, match="airports of version bad-"):
        etl.open_warehouse(spark, out)


@pytest.mark.parametrize("table,column", [("flights", "cancelled"), ("reports", "aircraftregistration"),
                                          ("maintenance", "programmed")])
def test_nulls_are_counted_on_the_way(spark, src, tmp_path, table, column):
    rows = getattr(src, table)
    bad = rows.withColumn(column, F.when(F.lit(False), F.col(column))).limit(3).unionByName(rows)
    with pytest.raises(ValueError, match=rf"{table}: null values in required columns \{{'{column}': 3\}}"):
        etl.run_full_refresh(spark, dataclasses.replace(src, **{table: bad}), str(tmp_path))
    assert store.current(spark, str(tmp_path)) is None


def test_each_source_is_read_once(spark, src, tmp_path):
    """The staging writes alone read the sources."""
    plans = []

    def noted(name, df):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString(),
                      [p for p in df.inputFiles()]))
        return etl.checkpointed(name, df)

    wh = etl.build(src, noted, observe=True)
    for name in etl.SHARED_STAGES:
        getattr(wh, name)
    for table in ("flights", "reports", "maintenance"):
        own = set(getattr(src, table).inputFiles())
        assert [name for name, _, files in plans if own & set(files)] == [etl.REQUIRED[table][0]]
    assert wh.seen["flights"].get["reversed"] == etl.quality.count_reversed_times(src.flights).first()[0]


def test_days_of_some_years_prune_the_fact(spark, built, tmp_path):
    out = str(tmp_path)
    etl.publish(spark, built[0], out, "one")
    t = etl.open_warehouse(spark, out, register_views=False)
    assert {p for p in os.listdir(f"{out}/{store.current(spark, out).tables['daily_aircraft_stats']}")
            if p.startswith("year=")} == {f"year={r.year}" for r in t["dates"].select("year").distinct().collect()}
    some = warehouse_kpis.utilization(t["daily_aircraft_stats"], t["aircrafts"],
                                      warehouse_kpis.in_years(t["dates"], 1994, 1995))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    whole = warehouse_kpis.utilization(t["daily_aircraft_stats"], t["aircrafts"], t["dates"])
    assert some.collect() == [r for r in whole.collect() if r.year in (1994, 1995)]


def test_malformed_lookup_lines_are_logged(spark, built, tmp_path):
    air, people, wrong = (str(tmp_path / n) for n in ("air.csv", "people.csv", "wrong.csv"))
    with open(air, "w", encoding="utf-8") as f:
        f.write("aircraft_reg_code,manufacturer_serial_number,aircraft_model,aircraft_manufacturer\n"
                "XY-001,1,A320,Airbus\nXY-002,2,B737\nXY-003,3,B737,Boeing,x\n")
    with open(people, "w", encoding="utf-8") as f:
        f.write('reporteurid,airport\n12,BCN\n13\n"14","MAD"\nx,LHR\n15,"A,B"\n')
    with open(wrong, "w", encoding="utf-8") as f:
        f.write("airport,reporteurid\nBCN,12\n")
    assert [r.aircraft_reg_code for r in readers.read_aircraft_lookup(spark, air).collect()] == ["XY-001"]
    assert [tuple(r) for r in readers.read_personnel_lookup(spark, people).collect()] == [
        (12, "BCN"), (14, "MAD"), (None, "LHR"), (15, "A,B")]
    with pytest.raises(Exception, match="CSV header"):
        readers.read_personnel_lookup(spark, wrong).collect()
    few = etl.build(dataclasses.replace(built[1].src, lookup_rejects=readers.lookup_rejects(spark, air, people)))
    for name in etl.SHARED_STAGES:
        few.__dict__[name] = getattr(built[1], name)
    etl.publish(spark, few, str(tmp_path / "wh"), "one")
    log = etl.read_rejects(spark, str(tmp_path / "wh"), "malformed_lookup_lines").collect()
    assert sorted(tuple(r) for r in log) == [
        ("aircraft", "XY-002,2,B737", "one"), ("aircraft", "XY-003,3,B737,Boeing,x", "one"),
        ("personnel", "13", "one")]


def test_aircraft_of_several_years_count_once(spark):
    """Ids in several buckets; the bitmaps give the distinct aircraft of any years."""
    ids = spark.range(1, 100_001, 7).select(F.col("id").cast("int").alias("aircraftid"))
    aircrafts = ids.withColumn("manufacturer", F.when(F.col("aircraftid") % 2 == 0, "Airbus").otherwise("Boeing"))
    dates = spark.createDataFrame([(1, 2001), (2, 2002), (3, 2003)], "dateid int, year int")
    fact = ids.join(dates, (F.col("aircraftid") + F.col("dateid")) % 3 != 0).select(
        "dateid", "aircraftid", *[F.lit(1).alias(c) for c in warehouse_kpis._MEASURES.values()])
    sets = warehouse_kpis.aircraft_sets(fact, aircrafts, dates)
    assert sets.select("bucket").distinct().count() == 4
    joined = fact.join(aircrafts, "aircraftid").join(dates, "dateid")
    for first, last in ((2001, 2001), (2002, 2003), (2001, 2003)):
        want = {r[0]: r[1] for r in joined.where(F.col("year").between(first, last)).groupBy("manufacturer")
                .agg(F.count_distinct("aircraftid")).collect()}
        got = {r.manufacturer: r.aircraft for r in warehouse_kpis.utilization_span(sets, first, last).collect()}
        assert got == want


def test_reference_checks_do_not_shuffle_the_fact(spark, built):
    tables = {name: getattr(built[0], name) for name in etl.WAREHOUSE_TABLES}
    plan = etl.checks.reference_violations(tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 4 and plan.count("Aggregate [dateid") == 1
    tables["aircrafts"] = tables["aircrafts"].where("aircraftid > 1")
    want = tables["daily_aircraft_stats"].where("aircraftid = 1").count()
    got = {r.rule: r.violations for r in etl.checks.reference_violations(tables).collect()}
    assert got["foreign_key:daily_aircraft_stats.aircraftid->aircrafts"] == want > 0
