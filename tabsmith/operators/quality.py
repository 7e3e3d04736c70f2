"""Data-quality operators: membership filter, missing-value drops and fills,
whole-row de-duplication, type cleaning and the not-empty guard.

Every operator is ``DataFrame -> DataFrame`` over built-in expressions, so
Catalyst can push the filters into the scan and prune columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DoubleType, FloatType, TimestampNTZType, TimestampType

from tabsmith.functions import parse_date, strip_spaces, to_double


def status_in(df: DataFrame, column: str, values: Iterable[str]) -> DataFrame:
    """Keep rows whose ``column`` is one of ``values`` (exact, case-sensitive;
    null never matches). Becomes an ``In`` filter pushed into the scan."""
    return df.filter(F.col(column).isin(list(values)))


def _present(df: DataFrame, name: str) -> Column:
    field = df.schema[name]
    cond = F.col(name).isNotNull()
    if isinstance(field.dataType, (DoubleType, FloatType)):
        cond = cond & ~F.isnan(F.col(name))
    return cond


def drop_missing(df: DataFrame, subset: Sequence[str]) -> DataFrame:
    """Drop rows that are null (or NaN) in any of ``subset``.

    Written as an ``isNotNull`` conjunction rather than ``na.drop`` because the
    latter becomes ``AtLeastNNonNulls``, which no source can take as a pushed
    filter; ``IsNotNull`` reaches Parquet and JDBC scans.
    """
    if not subset:
        return df
    missing = [c for c in subset if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    return df.filter(reduce(lambda a, b: a & b, (_present(df, c) for c in subset)))


def drop_any(df: DataFrame) -> DataFrame:
    """Drop rows with a missing value in any column (null or NaN)."""
    return drop_missing(df, df.columns)


def fill(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace null (and NaN) per column; an unknown column raises."""
    missing = [c for c in values if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    return df.na.fill(dict(values))


def dedupe(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """Whole-row (or ``subset``) distinct.

    Planned as a hash aggregate with a map-side partial step, so duplicates of
    a hot row collapse in each task before the shuffle.
    """
    return df.dropDuplicates(list(subset)) if subset else df.dropDuplicates()


def _as_date(df: DataFrame, name: str, fmt: str) -> Column:
    kind = df.schema[name].dataType
    if isinstance(kind, DateType):
        return F.col(name)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.to_date(name)
    return parse_date(name, fmt)


def parse_dates(df: DataFrame, columns: Sequence[str], fmt: str = "yyyy-MM-dd") -> DataFrame:
    """Columns to dates. Text is parsed with ``fmt`` (no match -> null); a
    column a reader already typed as date or timestamp is kept or truncated
    to its date, so inferred schemas give the same result as text."""
    return df.withColumns({c: _as_date(df, c, fmt) for c in columns})


def cast_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: to_double(c) for c in columns})


def strip_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: strip_spaces(c) for c in columns})


def require_rows(df: DataFrame, message: str = "DataFrame is empty, no data to process") -> DataFrame:
    """Raise ``ValueError`` when ``df`` has no row; otherwise return it.

    ``isEmpty`` stops at the first row found, but it is still a job: call it on
    a persisted frame when the frame is used again afterwards.
    """
    if df.isEmpty():
        raise ValueError(message)
    return df
