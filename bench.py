"""Benchmark: ETL full refresh + the six KPI queries at one scale factor.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS
(default 8), BENCH_REPEAT (default 5; best of N per query).

Steps (one Spark session, like a long-running warehouse service):
1. extract: the operational sources are derived from the driver tables and
   stored once as parquet -- the "source system" (timed as ``extract``);
2. etl: full refresh of the warehouse from those sources (``etl``);
3. q1-q3: warehouse KPI queries over the written star schema;
4. q4-q6: the same KPIs straight from the source tables.

Prints one JSON line; ``value`` is the sum of the best times of q1-q6.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from hangar.plans import etl, source_kpis, warehouse_kpis  # noqa: E402
from hangar.session import ensure_checkpoint_dir, local_session  # noqa: E402
from hangar.sources import driver_views  # noqa: E402


def _timed(fn):
    t0 = time.perf_counter()
    out = fn()
    return out, time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "5"))
    spark = local_session(cpus, shuffle_partitions=cpus)
    root = os.path.join(ensure_checkpoint_dir(spark), "hangar-bench", uuid.uuid4().hex[:10])
    src_dir, wh_dir = os.path.join(root, "sources"), os.path.join(root, "warehouse")

    # 1. the source system
    mapped = driver_views.load(spark, sf_dir)

    def extract():
        # the operational tables are stored as several files, like any source
        # system of size (the driver's parquet files hold a single row group,
        # which Spark can only read with one task)
        for name in ("flights", "maintenance", "reports"):
            (getattr(mapped, name).repartition(cpus).write.mode("overwrite")
             .parquet(os.path.join(src_dir, name)))
        for name in ("aircraft_lookup", "personnel_lookup"):
            getattr(mapped, name).write.mode("overwrite").parquet(os.path.join(src_dir, name))

    _, t_extract = _timed(extract)
    src = driver_views.OperationalSources(
        **{name: spark.read.parquet(os.path.join(src_dir, name))
           for name in ("flights", "maintenance", "reports", "aircraft_lookup",
                        "personnel_lookup")})

    # 2. ETL
    _, t_etl = _timed(lambda: etl.run_full_refresh(spark, src, wh_dir))

    # 3./4. queries
    wh = etl.open_warehouse(spark, wh_dir, register_views=False)
    fact, ac, dates = wh["daily_aircraft_stats"], wh["aircrafts"], wh["dates"]
    plans = {
        "q1_utilization": lambda: warehouse_kpis.utilization(fact, ac, dates),
        "q2_reporting": lambda: warehouse_kpis.reporting(fact, ac, dates),
        "q3_reporting_by_role": lambda: warehouse_kpis.reporting_by_role(fact, ac, dates),
        "q4_source_utilization": lambda: source_kpis.utilization(
            src.flights, src.maintenance, src.aircraft_lookup),
        "q5_source_reporting": lambda: source_kpis.reporting(
            src.flights, src.reports, src.aircraft_lookup),
        "q6_source_reporting_by_role": lambda: source_kpis.reporting_by_role(
            src.flights, src.reports, src.aircraft_lookup),
    }
    times, rows = {}, {}
    for name, plan in plans.items():
        best = None
        for _ in range(max(1, repeat)):
            out, t = _timed(lambda: plan().collect())
            best = t if best is None else min(best, t)
            rows[name] = len(out)
        times[name] = round(best, 4)
    result = {
        "metric": "kpi_queries_total",
        "value": round(sum(times.values()), 4),
        "unit": "sec",
        "queries": {**times, "extract": round(t_extract, 3), "etl": round(t_etl, 3)},
        "rows": rows,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
