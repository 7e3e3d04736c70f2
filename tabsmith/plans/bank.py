"""Bank transactions: clean raw CSV files, then extract failed transactions.

The cleaning order is kept on purpose: whole-row de-duplication runs on the
raw rows, before parsing and trimming, so two rows that differ only in the
spacing of a branch code are both kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tabsmith.operators.quality import (
    cast_double,
    dedupe,
    drop_missing,
    fill,
    parse_dates,
    status_in,
    strip_columns,
)
from tabsmith.sinks import write_csv
from tabsmith.sources.files import read_csv

# The column names and failure statuses the bank jobs work on.
DATE_COL = "Transaction_Date"
AMOUNT_COLS = ("Transaction_Amount", "Fee_Charged")
BRANCH_COL = "Branch_Code"
STATUS_COL = "Transaction_Status"
FAILED_STATUSES = ("Failed", "Declined")


def clean_transactions(
    raw: DataFrame,
    date_col: str = DATE_COL,
    amount_cols: Sequence[str] = AMOUNT_COLS,
    branch_col: str = BRANCH_COL,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """Distinct raw rows -> parse the date (bad or missing rows go) -> amounts
    to double with 0 for missing or unparsable -> branch code without any
    white space. Other columns pass through unchanged."""
    return clean_distinct(dedupe(raw), date_col, amount_cols, branch_col, date_format)


def clean_distinct(
    rows: DataFrame,
    date_col: str = DATE_COL,
    amount_cols: Sequence[str] = AMOUNT_COLS,
    branch_col: str = BRANCH_COL,
    date_format: str = "yyyy-MM-dd",
) -> DataFrame:
    """The steps after the distinct, each row by itself: these run on a stream too."""
    df = parse_dates(rows, [date_col], date_format)
    df = drop_missing(df, [date_col])
    df = cast_double(df, amount_cols)
    df = fill(df, {c: 0.0 for c in amount_cols})
    return strip_columns(df, [branch_col])


def failed_transactions(cleaned: DataFrame, status_col: str = STATUS_COL, statuses: Sequence[str] = FAILED_STATUSES) -> DataFrame:
    return status_in(cleaned, status_col, statuses)


def run_cleaning(spark: SparkSession, raw_path: str, cleaned_path: str, schema=None, glob: str | None = None) -> DataFrame:
    """Job 1: every file under ``raw_path`` (all folder depths) -> cleaned CSV folder.

    All files are read, whatever their names (Spark leaves out only those that
    begin with ``_`` or ``.``); ``glob`` narrows them if the caller asks for it.

    Returns the cleaned folder read back with the cleaned schema (no type
    inference), which is what job 2 consumes; reading the written files
    also cuts the lineage, so a lost executor never re-runs the cleaning.
    """
    raw = read_csv(spark, raw_path, schema=schema, recursive=True, glob=glob)
    cleaned = clean_transactions(raw)
    write_csv(cleaned, cleaned_path)
    return read_csv(spark, cleaned_path, schema=cleaned.schema, by_name=False)


def run_failed_extract(spark: SparkSession, cleaned_path: str, failed_path: str, schema=None) -> DataFrame:
    """Job 2: cleaned CSV folder -> failed/declined transactions CSV folder.

    The status filter is pushed into the CSV scan."""
    cleaned = read_csv(spark, cleaned_path, schema=schema, infer_schema=schema is None)
    failed = failed_transactions(cleaned)
    write_csv(failed, failed_path)
    return read_csv(spark, failed_path, schema=failed.schema, by_name=False)
