"""Column-level string functions (case, length, whitespace).

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen; none calls back into Python.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tabsmith.functions._col import ColumnOrName, to_col

# Runs of cased letters or of anything else; Python's str.title() starts a new
# word after every uncased character, which is what splitting into runs models.
CASED_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def upper_case(c: ColumnOrName) -> Column:
    return F.upper(to_col(c))


def lower_case(c: ColumnOrName) -> Column:
    return F.lower(to_col(c))


def _capitalize_run(s: Column) -> Column:
    return F.concat(F.upper(F.substring(s, 1, 1)), F.lower(F.substring(s, 2, 2147483647)))


def title_case(c: ColumnOrName, python_rules: bool = False) -> Column:
    """Upper-case the first letter of every word, lower-case the rest.

    Default is Spark's ``initcap`` (words split on white space only). With
    ``python_rules=True`` a word restarts after any character without case, as in
    Python's ``str.title()`` ("they're" -> "They'Re", "3rd" -> "3Rd").
    """
    c = to_col(c)
    if not python_rules:
        return F.initcap(c)
    runs = F.regexp_extract_all(c, F.lit(CASED_RUNS), 1)
    return F.when(c.isNotNull(), F.concat_ws("", F.transform(runs, _capitalize_run)))


def swap_case(c: ColumnOrName) -> Column:
    """Upper-case letters become lower case and the other way round."""
    c = to_col(c)
    chars = F.split(c, "")
    swapped = F.transform(chars, lambda ch: F.when(F.upper(ch) == ch, F.lower(ch)).otherwise(F.upper(ch)))
    # concat_ws turns a null array into "", so keep null explicitly.
    return F.when(c.isNotNull(), F.concat_ws("", swapped))


def capitalize(c: ColumnOrName) -> Column:
    """First character upper case, the rest lower case (Python ``capitalize``)."""
    return _capitalize_run(to_col(c))


def char_length(c: ColumnOrName) -> Column:
    """Length in characters (code points)."""
    return F.char_length(to_col(c))


def strip_spaces(c: ColumnOrName) -> Column:
    """Remove every white-space character, inner ones included, then trim."""
    return F.trim(F.regexp_replace(to_col(c).cast("string"), r"\s+", ""))
