"""Column-level parsing, casting and formatting.

Spark 4 runs with ANSI mode on, where ``to_date`` and ``cast`` raise on bad
input. Cleaning must turn bad values into nulls instead, so the ``try_``
forms are used throughout.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith.functions._col import ColumnOrName, to_col

# The text cells pandas' CSV reader treats as missing by default
# (public pandas behaviour). Spark's CSV reader keeps them as text, so feeds
# that were read by pandas need them turned into nulls before any cast.
PANDAS_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)


def parse_date(c: ColumnOrName, fmt: str = "yyyy-MM-dd") -> Column:
    """Text to date; anything that does not match ``fmt`` becomes null."""
    return F.try_to_date(to_col(c).cast("string"), fmt)


def to_double(c: ColumnOrName) -> Column:
    """Any value to double; values that do not parse become null."""
    return to_col(c).try_cast("double")


def null_tokens(c: ColumnOrName, tokens: Iterable[str] = PANDAS_NA_TOKENS) -> Column:
    """Turn missing-value tokens in a text column into real nulls."""
    c = to_col(c)
    return F.when(~c.isin(list(tokens)), c)


def fmt_price(c: ColumnOrName) -> Column:
    """Dollar text with two decimals, e.g. ``$1234.50``."""
    return F.format_string("$%.2f", to_col(c))
