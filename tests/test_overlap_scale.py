"""The overlap rule where some aircraft count as busy, and what it shuffles."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from hangar import schemas
from hangar.operators import quality

START = dt.datetime(1969, 12, 30)


def some_flights(n, seed=1):
    rng, rows = random.Random(seed), []
    at = lambda: START + dt.timedelta(minutes=rng.randrange(6000))
    for _ in range(n):
        dep = at()
        rows.append((rng.choice(["A", "B", "B", "B", None]), rng.random() < 0.1,
                     dep if rng.random() > 0.05 else None,
                     dep + dt.timedelta(minutes=rng.randrange(200)) if rng.random() > 0.05 else None,
                     at() if rng.random() > 0.1 else None, at()))
    return rows + rows[:20]  # some rows twice


def overlapping(rows):
    """The rule by a loop over each aircraft's flights."""
    last, out = dt.datetime.max, []
    flown = lambda r: not r[1] and r[0] is not None and r[2] is not None
    for reg in {r[0] for r in rows if flown(r)}:
        own = sorted((r for r in rows if flown(r) and r[0] == reg), key=lambda r: (r[2], r[3] or last, r[4] or last, r[5]))
        out += [a for a, b in zip(own, own[1:]) if a[3] and a[3] > b[2]]
    return out


@pytest.mark.parametrize("bucket", ["day", "hour", "minute"])
@pytest.mark.parametrize("busy", [0, 200, quality.BUSY])
def test_busy_aircraft_have_the_same_overlaps(spark, bucket, busy):
    rows = some_flights(300)
    marked = quality.mark_overlapping(spark.createDataFrame(rows, schemas.FLIGHTS), bucket, busy).collect()
    assert sorted(str(tuple(r)[:6]) for r in marked) == sorted(map(str, rows))
    assert sorted(str(tuple(r)[:6]) for r in marked if r.overlaps) == sorted(map(str, overlapping(rows)))


def test_few_flights_of_many_aircraft_make_no_further_rows(spark, tmp_path):
    """One row in the shuffle for each flight: no summary of hours beside them."""
    path = str(tmp_path / "flights")
    spark.createDataFrame(some_flights(300), schemas.FLIGHTS).write.parquet(path)
    marked = quality.mark_overlapping(spark.read.parquet(path))
    marked.collect()
    plan = marked._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Window") == 1 and "min(actualdeparture" not in plan
