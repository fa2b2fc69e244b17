"""Column-expression helpers, all JVM-side (no Python UDFs)."""

from hangar.functions.numeric import dec_sql, div_sql, idiv_sql, r_sql
from hangar.functions.temporal import (
    MICROS_PER_DAY,
    MICROS_PER_HOUR,
    MICROS_PER_MINUTE,
    day_of,
    micros_between,
    month_key,
    sql_micros_between,
    text_to_date,
    text_to_id,
)

__all__ = [
    "MICROS_PER_DAY",
    "MICROS_PER_HOUR",
    "MICROS_PER_MINUTE",
    "day_of",
    "dec_sql",
    "div_sql",
    "idiv_sql",
    "micros_between",
    "month_key",
    "r_sql",
    "sql_micros_between",
    "text_to_date",
    "text_to_id",
]
