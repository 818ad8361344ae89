"""Typed readers and writers."""

from .tables import read_table, TABLES
from .records import RECORD_SCHEMA, read_records, drop_phantom, land_records
from .categories import read_categories, assignable_categories
from .requests import REQUEST_SCHEMA, requests_to_df

__all__ = ["read_table", "TABLES", "RECORD_SCHEMA", "read_records", "drop_phantom",
           "land_records", "read_categories", "assignable_categories",
           "REQUEST_SCHEMA", "requests_to_df"]
