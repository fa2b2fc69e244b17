"""KPI arithmetic: rounding, integer division, zero denominators."""

from __future__ import annotations

from decimal import Decimal

import pytest

from hangar.plans import warehouse_kpis


def sums(spark, **kw):
    base = dict(manufacturer="Airbus", year=2024, H=0.0, T=0, S=0.0, U=0.0, D=0, C=0, M=0.0,
                P=0, R=0, n=1)
    base.update(kw)
    schema = ("manufacturer string, year int, H double, T bigint, S double, U double, D bigint, "
              "C bigint, M double, P bigint, R bigint, n bigint")
    return spark.createDataFrame([tuple(base[k] for k in base)], schema)


def kpis(spark, **kw):
    return warehouse_kpis.utilization_from_sums(sums(spark, **kw)).first()


@pytest.mark.parametrize("hours,expected", [(1.005, "1.00"), (0.285, "0.28"), (2.675, "2.68"),
                                            (1.5, "1.50"), (0.125, "0.13")])
def test_rounding_is_half_away_on_the_double(spark, hours, expected):
    assert kpis(spark, H=hours, T=1).FH == Decimal(expected)


def test_takeoff_uses_integer_division(spark):
    assert kpis(spark, T=7, n=2).TakeOff == Decimal("3.00")


def test_tdr_is_a_whole_number(spark):
    assert kpis(spark, D=1, C=1, T=3).TDR == Decimal("34.00")


def test_add_is_scaled_by_100(spark):
    assert kpis(spark, M=50.0, D=2, T=10).ADD == Decimal("2500.00")


def test_dc_and_du_use_rounded_inputs(spark):
    row = kpis(spark, H=730.0, T=730, S=0.0, U=0.0, n=1)
    assert row.ADIS == Decimal("365.00")
    assert row.DU == Decimal("0.08")   # 730 / (365 * 24)
    assert row.DC == Decimal("2.00")


def test_zero_denominators_give_null(spark):
    row = kpis(spark, T=0, D=0, C=0)
    assert row.DYR is None and row.CNR is None and row.TDR is None and row.ADD is None
    row = kpis(spark, S=365.0, U=0.0, T=1)
    assert row.ADIS == Decimal("0.00") and row.DU is None and row.DC is None


def test_reporting_rates(spark):
    fact = spark.createDataFrame(
        [(1, 1, 2, 4.0, 0.0, 0.0, 0, 0, 0.0, 3, 1)],
        "dateid int, aircraftid int, takeoffs int, flighthours float, ADOSS float, ADOSU float, "
        "delays int, cancellations int, delayduration float, pilotreports int, "
        "maintenancereports int")
    ac = spark.createDataFrame([(1, "XY-001", "A320", "Airbus")],
                               "aircraftid int, aircraftregistration string, model string, "
                               "manufacturer string")
    dates = spark.createDataFrame([(1, 2024)], "dateid int, year int")
    q2 = warehouse_kpis.reporting(fact, ac, dates).first()
    assert (q2.RRh, q2.RRc) == (Decimal("1000.000"), Decimal("200.00"))
    q3 = {r.role: (r.RRh, r.RRc) for r in warehouse_kpis.reporting_by_role(fact, ac, dates).collect()}
    assert q3 == {"PIREP": (Decimal("750.000"), Decimal("150.00")),
                  "MAREP": (Decimal("250.000"), Decimal("50.00"))}
