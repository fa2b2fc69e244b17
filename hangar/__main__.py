"""Command line: ``python -m hangar <command> ...``

refresh   rebuild the warehouse (full refresh) from operational sources
query     run one KPI query on a warehouse (q1-q3) or on the sources (q4-q6);
          the whole result goes to --out, or as CSV to standard output

Sources are either a folder of driver tables (``--driver-tables``), a folder
with one parquet table per source (``--sources``: flights, maintenance,
reports, aircraft_lookup, personnel_lookup), or a JDBC database plus the two
lookup CSV files (``--jdbc-url`` ...).
"""

from __future__ import annotations

import argparse
import csv
import os
import sys

from pyspark.sql import DataFrame, SparkSession

from hangar.plans import etl, source_kpis, warehouse_kpis
from hangar.session import CHECKPOINT_CONF, ensure_checkpoint_dir
from hangar.sources import driver_views, readers

SOURCE_NAMES = ("flights", "maintenance", "reports", "aircraft_lookup", "personnel_lookup")


def _jdbc(args, name: str) -> dict[str, str]:
    """Options of one table; ``--jdbc-partition name=column:lower:upper:count``
    reads it by that many range queries instead of one cursor."""
    ranges = dict(p.split("=", 1) for p in args.jdbc_partition)
    column, lower, upper, count = (ranges[name].rsplit(":", 3) if name in ranges
                                   else (None, None, None, None))
    return readers.jdbc_options(
        args.jdbc_url, args.jdbc_user, os.environ.get("HANGAR_JDBC_PASSWORD", ""),
        partition_column=column, lower_bound=lower, upper_bound=upper,
        num_partitions=int(count) if count else None)


def _print_all(df: DataFrame) -> None:
    """Every row as CSV on standard output, one partition at a time."""
    out = csv.writer(sys.stdout)
    out.writerow(df.columns)
    for row in df.toLocalIterator():
        out.writerow(row)


def _sources(spark: SparkSession, args) -> driver_views.OperationalSources:
    if args.driver_tables:
        return driver_views.load(spark, args.driver_tables)
    if args.sources:
        return driver_views.OperationalSources(
            **{n: spark.read.parquet(os.path.join(args.sources, n)) for n in SOURCE_NAMES})
    if args.jdbc_url:
        tables = {name: readers.read_source(spark, name, fmt="jdbc", options=_jdbc(args, name))
                  for name in ("flights", "maintenance", "reports")}
        return driver_views.OperationalSources(
            **tables,
            aircraft_lookup=readers.read_aircraft_lookup(spark, args.aircraft_csv),
            personnel_lookup=readers.read_personnel_lookup(spark, args.personnel_csv),
            lookup_rejects=readers.lookup_rejects(spark, args.aircraft_csv, args.personnel_csv),
        )
    raise SystemExit("give --driver-tables, --sources or --jdbc-url")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="hangar")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("refresh", "query"):
        s = sub.add_parser(name)
        s.add_argument("--driver-tables")
        s.add_argument("--sources")
        s.add_argument("--jdbc-url")
        s.add_argument("--jdbc-user", default="")
        s.add_argument("--jdbc-partition", action="append", default=[],
                       help="name=column:lower:upper:count, once per table")
        s.add_argument("--aircraft-csv")
        s.add_argument("--personnel-csv")
        s.add_argument("--checkpoint-dir", help="folder that all executors share, if "
                       "spark.checkpoint.dir is not set already")
        s.add_argument("--master", help="e.g. local[8]; default: from spark-submit")
    sub.choices["refresh"].add_argument("--out", required=True)
    q = sub.choices["query"]
    q.add_argument("name", choices=["q1", "q2", "q3", "q4", "q5", "q6"])
    q.add_argument("--warehouse")
    q.add_argument("--out", help="folder for the result; default: CSV on standard output")
    q.add_argument("--format", default="csv", choices=["csv", "parquet", "json", "orc"])
    args = p.parse_args(argv)

    builder = SparkSession.builder.appName(f"hangar-{args.command}")
    if args.master:
        builder = builder.master(args.master).config("spark.ui.enabled", "false")
    if args.checkpoint_dir:
        builder = builder.config(CHECKPOINT_CONF, args.checkpoint_dir)
    spark = builder.getOrCreate()
    if not spark.conf.get(CHECKPOINT_CONF, None):
        raise SystemExit(f"set {CHECKPOINT_CONF} or give --checkpoint-dir")
    ensure_checkpoint_dir(spark)
    if args.command == "refresh":
        written = etl.run_full_refresh(spark, _sources(spark, args), args.out)
        for name, path in written.items():
            print(f"{name}\t{path}")
        return 0
    if args.name in ("q1", "q2", "q3"):
        if not args.warehouse:
            raise SystemExit("q1-q3 need --warehouse")
        t = etl.open_warehouse(spark, args.warehouse, register_views=False)
        fn = {"q1": warehouse_kpis.utilization, "q2": warehouse_kpis.reporting,
              "q3": warehouse_kpis.reporting_by_role}[args.name]
        df = fn(t["daily_aircraft_stats"], t["aircrafts"], t["dates"])
    else:
        s = _sources(spark, args)
        df = {"q4": lambda: source_kpis.utilization(s.flights, s.maintenance, s.aircraft_lookup),
              "q5": lambda: source_kpis.reporting(s.flights, s.reports, s.aircraft_lookup),
              "q6": lambda: source_kpis.reporting_by_role(s.flights, s.reports,
                                                          s.aircraft_lookup)}[args.name]()
    if args.out:
        df.write.format(args.format).option("header", True).mode("overwrite").save(args.out)
    else:
        _print_all(df)
    return 0


if __name__ == "__main__":
    sys.exit(main())
