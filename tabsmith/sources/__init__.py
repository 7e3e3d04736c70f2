"""Sources: file scans (CSV, JSON, XLSX), JDBC tables and a feed registry."""

from tabsmith.sources.files import REJECTED, read_csv, read_json, split_rejected
from tabsmith.sources.jdbc import quote_name, read_jdbc, write_jdbc
from tabsmith.sources.registry import SourceSpec, load_sources, read_source, stage_sources
from tabsmith.sources.xlsx import read_xlsx, sheet_rows

__all__ = [
    "REJECTED",
    "SourceSpec",
    "load_sources",
    "quote_name",
    "read_csv",
    "read_json",
    "read_jdbc",
    "read_source",
    "read_xlsx",
    "sheet_rows",
    "split_rejected",
    "stage_sources",
    "write_jdbc",
]
