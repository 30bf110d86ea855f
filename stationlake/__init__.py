"""PySpark toolkit for messy hourly station data: ingest, repair, aggregate, check and serve."""
