"""hangar: a PySpark warehouse for airline fleet operations.

Sources (flights, maintenance, post-flight reports, aircraft and personnel
lookups) are read as DataFrames, cleaned by data-quality rules, loaded into
three dimensions and two fact tables, and summarised by utilization and
reporting KPIs, both from the warehouse and straight from the sources.

Subpackages
-----------
sources    readers (parquet / csv / jdbc), projections, driver-table mapping
functions  column helpers: rounding, durations, date keys, surrogate keys
operators  quality rules, dimensions, facts, integrity checks
plans      KPI queries, source-level KPI queries, the full-refresh pipeline
llm        operators of a training-data pipeline (optional)
"""

__version__ = "0.1.0"
