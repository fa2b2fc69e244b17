"""Durations, day/month keys and text coercion for temporal and id columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_HOUR = 3_600_000_000
MICROS_PER_DAY = 86_400_000_000


def micros_between(start: str, end: str) -> Column:
    """``end - start`` in whole microseconds (null if either side is null).

    Wall-clock difference of two TIMESTAMP_NTZ values: the day-time interval
    ``end - start`` is taken apart field by field, which involves no time
    zone (``timestampdiff`` on TIMESTAMP_NTZ goes through the session zone
    and is off by the DST shift across a transition; ``unix_micros`` rejects
    TIMESTAMP_NTZ).  Summing the exact integer and dividing once keeps
    aggregates independent of row order.  Arguments are column names.
    """
    return F.expr(sql_micros_between(start, end))


def sql_micros_between(start: str, end: str) -> str:
    """SQL text of ``micros_between`` (for ``selectExpr``)."""
    iv = f"(`{end}` - `{start}`)"
    return (f"(extract(DAY FROM {iv}) * 86400000000L + extract(HOUR FROM {iv}) * 3600000000L"
            f" + extract(MINUTE FROM {iv}) * 60000000L"
            f" + cast(extract(SECOND FROM {iv}) * 1000000 as bigint))")


def day_of(ts: Column | str) -> Column:
    """Calendar day of a timestamp: the day key of every fact row."""
    return F.to_date(F.col(ts) if isinstance(ts, str) else ts)


def month_key(day: Column | str) -> Column:
    """YYYYMM as an integer, e.g. 2024-01-05 -> 202401."""
    day = F.col(day) if isinstance(day, str) else day
    return (F.year(day) * 100 + F.month(day)).cast("int")


def text_to_date(text: Column | str) -> Column:
    """Parse ``yyyy-M-d`` text to a DATE; anything else (incl. a time part) -> null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.to_date(F.try_to_timestamp(text, F.lit("yyyy-M-d")))


def text_to_id(text: Column | str) -> Column:
    """Numeric text (``12``, ``12.0``, `` 7 ``) to BIGINT, exactly.

    Fractions (``12.7``), non-numbers (``NaN``, ``x``) and numbers beyond a
    BIGINT (``1e300``) -> null: an id is never rounded to another one.
    """
    text = F.col(text) if isinstance(text, str) else text
    number = F.trim(text).try_cast("decimal(38,18)")
    return F.when(number == F.floor(number), number.try_cast("bigint"))
