"""Query plans: warehouse KPIs, source-level KPIs and the ETL pipeline."""
