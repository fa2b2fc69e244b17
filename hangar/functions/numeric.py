"""Numeric helpers that reproduce the KPI arithmetic exactly.

``r_sql`` multiplies by 10^k, rounds half away from zero to an integer and
divides back, all in DOUBLE.  That is the arithmetic the warehouse queries
are defined with; ``round(x, k)`` on a DOUBLE rounds the shortest decimal
string instead and differs on values such as 1.005.  The KPI formulas nest
dozens of operators, so these helpers produce SQL expression text: one JVM
call per output column instead of one per operator node.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# ---- exact sums of microsecond durations -----------------------------------
# A BIGINT sum of microseconds overflows after ~292,000 years of total
# duration -- reachable when one key gathers a large share of 100 TB of
# flights.  Splitting each value into whole seconds and the microsecond rest
# keeps both partial sums far inside BIGINT while staying exact, and both
# are plain BIGINT additions (no per-row DECIMAL arithmetic).
_MICROS = 1_000_000


def split_micros(us: str, name: str) -> list[str]:
    """SQL select items ``{name}_s`` / ``{name}_r`` with us = s * 1e6 + r."""
    return [f"cast(({us}) as bigint) div {_MICROS}L AS {name}_s",
            f"cast(({us}) as bigint) % {_MICROS}L AS {name}_r"]


def sum_split(name: str) -> list[Column]:
    """Aggregates of the split parts (null when every input is null)."""
    return [F.expr(f"sum({name}_s) AS {name}_s"), F.expr(f"sum({name}_r) AS {name}_r")]


def split_to_double(name: str) -> str:
    """SQL text: recombine summed parts exactly (DECIMAL(38,0)), then DOUBLE."""
    return (f"cast(cast({name}_s as decimal(38,0)) * cast({_MICROS} as decimal(38,0))"
            f" + cast({name}_r as decimal(38,0)) as double)")


# ---- KPI arithmetic as SQL text ------------------------------------------------

def r_sql(x: str, digits: int) -> str:
    """round(x * 10^k) / 10^k in DOUBLE, ties away from zero."""
    scale = f"{float(10**digits)!r}D"
    return f"(round(({x}) * {scale}, 0) / {scale})"


def div_sql(num: str, den: str) -> str:
    """DOUBLE division; a zero or null denominator gives NULL, never an error."""
    return f"try_divide(cast(({num}) as double), cast(({den}) as double))"


def idiv_sql(num: str, den: str) -> str:
    """BIGINT division truncating toward zero; a zero denominator gives NULL."""
    return (f"(CASE WHEN cast(({den}) as bigint) <> 0 "
            f"THEN cast(({num}) as bigint) div cast(({den}) as bigint) END)")


def dec_sql(x: str, precision: int = 10, scale: int = 2) -> str:
    """Cast an already-rounded DOUBLE to DECIMAL(p, s)."""
    return f"cast(({x}) as decimal({precision},{scale}))"
