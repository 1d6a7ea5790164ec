"""User analytics on Spark: cleansing, facts, trends, anomalies and business views."""

from userlake.context import RunContext
from userlake.tables import Tables, tables_from_raw, tables_from_store

__all__ = ["RunContext", "Tables", "tables_from_raw", "tables_from_store"]
