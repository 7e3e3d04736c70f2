"""Column expressions: ``Column -> Column``, all built-in Spark functions."""

from tabsmith.functions.strings import (
    capitalize,
    char_length,
    lower_case,
    strip_spaces,
    swap_case,
    title_case,
    upper_case,
)
from tabsmith.functions.values import (
    PANDAS_NA_TOKENS,
    fmt_price,
    null_tokens,
    parse_date,
    to_double,
)

__all__ = [
    "PANDAS_NA_TOKENS",
    "capitalize",
    "char_length",
    "fmt_price",
    "lower_case",
    "null_tokens",
    "parse_date",
    "strip_spaces",
    "swap_case",
    "title_case",
    "to_double",
    "upper_case",
]
