"""Readers for the operational sources and the two CSV lookups.

Every reader declares its schema and projects the columns the warehouse
uses, so Catalyst prunes the scan (``ReadSchema`` lists only those columns)
and pushes predicates down to parquet or to the database for JDBC.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hangar import schemas
from hangar.functions.temporal import text_to_id

FLIGHT_COLUMNS = [f.name for f in schemas.FLIGHTS]
MAINTENANCE_COLUMNS = [f.name for f in schemas.MAINTENANCE]
REPORT_COLUMNS = [f.name for f in schemas.REPORTS]

# operational table names in the source database: the schema names are upper
# case there, so they are quoted (unquoted names are folded to lower case)
SOURCE_TABLES = {
    "flights": '"AIMS"."flights"',
    "maintenance": '"AIMS"."maintenance"',
    "reports": '"AMOS"."postflightreports"',
}


def _project(df: DataFrame, schema) -> DataFrame:
    """Select and cast to the declared schema, matching names case-insensitively."""
    by_lower = {c.lower(): c for c in df.columns}
    return df.select(
        *[F.col(by_lower[f.name.lower()]).cast(f.dataType).alias(f.name) for f in schema]
    )


def project_flights(df: DataFrame) -> DataFrame:
    """The six flight columns the warehouse needs."""
    return _project(df, schemas.FLIGHTS)


def project_maintenance(df: DataFrame) -> DataFrame:
    """The four maintenance columns."""
    return _project(df, schemas.MAINTENANCE)


def project_reports(df: DataFrame) -> DataFrame:
    """S3: the four report columns; ``reporteurID`` is folded to ``reporteurid``."""
    return _project(df, schemas.REPORTS)


def read_source(
    spark: SparkSession, name: str, path: str | None = None, fmt: str = "parquet",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read one operational table (flights / maintenance / reports).

    ``fmt="jdbc"`` reads ``SOURCE_TABLES[name]`` through ``options`` (url,
    user, password, driver, partitionColumn, ...); other formats read ``path``.
    """
    project = {"flights": project_flights, "maintenance": project_maintenance,
               "reports": project_reports}[name]
    if fmt == "jdbc":
        opts = dict(options or {})
        opts.setdefault("dbtable", SOURCE_TABLES[name])
        return project(spark.read.format("jdbc").options(**opts).load())
    reader = spark.read.format(fmt).options(**dict(options or {}))
    return project(reader.load(path))


def jdbc_options(
    url: str, user: str, password: str, *, driver: str = "org.postgresql.Driver",
    fetchsize: int = 10_000, partition_column: str | None = None,
    lower_bound: str | None = None, upper_bound: str | None = None,
    num_partitions: int | None = None,
) -> dict[str, str]:
    """Reader options for a partitioned JDBC scan.

    With ``partition_column`` and bounds, Spark opens ``num_partitions``
    parallel range queries instead of one cursor.  The options hold the
    password: never log them.
    """
    # wall-clock times stay wall-clock times: no detour by the session's zone
    opts = {"url": url, "user": user, "password": password, "driver": driver,
            "fetchsize": str(fetchsize), "preferTimestampNTZ": "true"}
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("a partitioned JDBC read needs bounds and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    return opts


_CORRUPT = "_corrupt"


def read_lookup(spark: SparkSession, path: str, schema: T.StructType,
                header: bool = True) -> tuple[DataFrame, DataFrame]:
    """A lookup CSV (comma, UTF-8) as ``(rows, rejects)``.

    Lines that don't have as many fields as the schema go to the rejects (one
    column ``line``, as they stand in the file) instead of into the lookup with
    nulls or without their last fields.  The header must name the declared columns
    in their order, or the read fails.
    """
    whole = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    # without column pruning: it would count fields only as far as they are asked for
    parsed = (spark.read.schema(whole).option("header", header).option("enforceSchema", False)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT)
              .option("columnPruning", False).option("encoding", "UTF-8").csv(path))
    # Spark refuses to read the corrupt column alone, so the others are looked at too
    looked_at = F.length(F.concat_ws("", *schema.names)) >= 0
    return (parsed.where(F.col(_CORRUPT).isNull() & looked_at).drop(_CORRUPT),
            parsed.where(F.col(_CORRUPT).isNotNull() & looked_at).select(F.col(_CORRUPT).alias("line")))


def read_aircraft_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The well-formed lines of the aircraft CSV."""
    return read_lookup(spark, path, schemas.AIRCRAFT_LOOKUP)[0]


def coerce_personnel(rows: DataFrame) -> DataFrame:
    """Personnel ids are numeric text, coerced (bad -> null)."""
    return rows.select(text_to_id("reporteurid").alias("reporteurid"), F.col("airport"))


def read_personnel_lookup(spark: SparkSession, path: str) -> DataFrame:
    """The well-formed lines of the personnel CSV."""
    return coerce_personnel(read_lookup(spark, path, schemas.PERSONNEL_LOOKUP_TEXT)[0])


def lookup_rejects(spark: SparkSession, aircraft_csv: str, personnel_csv: str) -> DataFrame:
    """(lookup, line): the malformed lines of both lookup files, for the reject log."""
    parts = [read_lookup(spark, path, schema)[1].select(F.lit(name).alias("lookup"), "line")
             for name, path, schema in (("aircraft", aircraft_csv, schemas.AIRCRAFT_LOOKUP),
                                        ("personnel", personnel_csv, schemas.PERSONNEL_LOOKUP_TEXT))]
    return parts[0].unionByName(parts[1])


def registrations_per_manufacturer(aircraft_lookup: DataFrame) -> DataFrame:
    """Registrations grouped per manufacturer, only Airbus and Boeing.

    Kept relational -- one (manufacturer, aircraftregistration) row per pair --
    instead of one list per manufacturer, so no group is gathered into a
    single row however large the fleet.  A registration listed under both
    makers belongs to Airbus, which is tested first.
    """
    pairs = aircraft_lookup.where(F.col("aircraft_manufacturer").isin("Airbus", "Boeing"))
    return pairs.groupBy(F.col("aircraft_reg_code").alias("aircraftregistration")).agg(
        F.min("aircraft_manufacturer").alias("manufacturer")
    )
