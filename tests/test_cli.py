"""The command line refreshes a warehouse and answers a query."""

from __future__ import annotations

import os
import tempfile

from hangar.__main__ import main
from tests.conftest import SF_SMALL


def test_cli_refresh_and_query(spark, capsys):
    out = os.path.join(tempfile.mkdtemp(prefix="hangar-cli-"), "wh")
    assert main(["refresh", "--driver-tables", SF_SMALL, "--out", out]) == 0
    assert "daily_aircraft_stats" in capsys.readouterr().out
    assert main(["query", "q2", "--warehouse", out]) == 0
    printed = capsys.readouterr().out
    assert "RRh" in printed and "Airbus" in printed


def test_cli_gives_whole_results(spark, capsys):
    folder = os.path.join(tempfile.mkdtemp(prefix="hangar-cli-"), "q6")
    tables = "/root/testdata/sf0.01"
    assert main(["query", "q6", "--driver-tables", tables, "--out", folder, "--format", "parquet"]) == 0
    assert main(["query", "q6", "--driver-tables", tables]) == 0
    printed = capsys.readouterr().out.strip().splitlines()
    assert len(printed) - 1 == spark.read.parquet(folder).count() > 100
