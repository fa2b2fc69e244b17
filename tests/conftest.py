from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from hangar import schemas  # noqa: E402
from hangar.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="hangar-test-ckpt-")
    s = local_session(4, 4, app="hangar-tests", extra={"spark.checkpoint.dir": ckpt})
    yield s
    s.stop()


def ts(day: int, hour: float = 0.0) -> dt.datetime:
    """Timestamp on 2024-01-<day> at ``hour`` (fractional hours allowed)."""
    return dt.datetime(2024, 1, day) + dt.timedelta(hours=hour)


@pytest.fixture
def flights_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, schemas.FLIGHTS)
    return make


@pytest.fixture
def maintenance_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, schemas.MAINTENANCE)
    return make


@pytest.fixture
def reports_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, schemas.REPORTS)
    return make


@pytest.fixture
def aircraft_lookup_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, schemas.AIRCRAFT_LOOKUP)
    return make


@pytest.fixture
def personnel_df(spark):
    def make(rows):
        return spark.createDataFrame(rows, schemas.PERSONNEL_LOOKUP)
    return make
