"""Text-typed inputs (P3, F5, F6): CSV files deliver dates and ids as text.

``text_dates`` / ``text_ids`` derive text columns from ``orders`` -- clean,
unpadded, with an extra time part, padded with blanks, or broken on
purpose -- and coerce them the way the warehouse does: a date must be
exactly ``yyyy-M-d`` (else null), an id a whole number in any numeric
notation that fits a BIGINT (else null).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hangar.functions.temporal import text_to_date, text_to_id


def text_dates(orders: DataFrame) -> DataFrame:
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    iso = d.cast("string")  # TIMESTAMP_NTZ renders its wall clock, no time zone
    unpadded = F.concat_ws("-", F.year(d).cast("string"), F.month(d).cast("string"),
                           F.dayofmonth(d).cast("string"))
    text = (F.when(k == 0, F.substring(iso, 1, 10))
            .when(k == 1, unpadded)
            .when(k == 2, F.substring(iso, 1, 16))
            .otherwise(F.concat(F.lit("x"), F.col("o_orderkey").cast("string"))))
    return orders.select("o_orderkey", text.alias("text")).withColumn(
        "parsed", text_to_date("text"))


def text_ids(orders: DataFrame) -> DataFrame:
    k, c = F.col("o_orderkey") % 8, F.col("o_custkey").cast("string")
    text = (F.when(k == 0, c)
            .when(k == 1, F.concat(c, F.lit(".0")))
            .when(k == 2, F.concat(F.lit(" "), c, F.lit(" ")))
            .when(k == 4, F.concat(c, F.lit(".7")))
            .when(k == 5, (F.col("o_custkey") + F.lit(9007199254740993)).cast("string"))
            .when(k == 6, F.lit("NaN"))
            .when(k == 7, F.lit("1e300"))
            .otherwise(F.concat(F.lit("id"), c)))
    return orders.select("o_orderkey", text.alias("text")).withColumn(
        "reporteurid", text_to_id("text"))


def lookup_lines(customer: DataFrame) -> DataFrame:
    """One column ``line``: a personnel CSV without header, made out of ``customer``;
    some lines have a field too many or too few, others quotes or an id that is no
    number."""
    k, key = F.col("c_custkey") % 10, F.col("c_custkey").cast("string")
    airport = F.format_string("N%02d", F.col("c_nationkey").cast("bigint"))
    join = lambda *parts: F.concat_ws(",", *parts)
    return customer.select(
        F.when(k == 1, join(key, airport, F.lit("extra"))).when(k == 2, key)
        .when(k == 3, join(key, F.concat(F.lit('"'), airport, F.lit('"'))))
        .when(k == 4, join(F.concat(F.lit("x"), key), airport))
        .when(k == 5, join(key, F.concat(F.lit('"'), airport, F.lit(',T2"'))))
        .otherwise(join(key, airport)).alias("line"))
