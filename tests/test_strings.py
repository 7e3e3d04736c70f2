from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsmith.functions import (
    capitalize,
    char_length,
    fmt_price,
    lower_case,
    strip_spaces,
    swap_case,
    title_case,
    upper_case,
)


def _apply(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("s"))).collect()]


def test_golden_values(spark):
    # The string demo's cases, with a name of our own as input.
    name, phrase = "Ada Lovelace", "hi hello good morning"
    assert _apply(spark, [name], upper_case) == ["ADA LOVELACE"]
    assert _apply(spark, [name], lower_case) == ["ada lovelace"]
    assert _apply(spark, [phrase], title_case) == ["Hi Hello Good Morning"]
    assert _apply(spark, [name], swap_case) == ["aDA lOVELACE"]
    assert _apply(spark, [phrase], capitalize) == ["Hi hello good morning"]
    assert _apply(spark, [name], char_length) == [12]


def test_title_rules_differ_after_non_letters(spark):
    s = "they're 3rd-rate x_y"
    assert _apply(spark, [s], title_case) == ["They're 3rd-rate X_y"]
    assert _apply(spark, [s], lambda c: title_case(c, python_rules=True)) == [s.title()]


def test_unicode_and_null(spark):
    values = ["ß straße ÉCOLE", "", None]
    assert _apply(spark, values, swap_case) == ["SS STRASSE école", "", None]
    assert _apply(spark, values, upper_case) == ["SS STRASSE ÉCOLE", "", None]
    assert _apply(spark, values, lambda c: title_case(c, python_rules=True))[1:] == ["", None]
    assert _apply(spark, values, char_length) == [14, 0, None]


def test_strip_spaces(spark):
    values = ["BR 01", "\tBR\t01 ", "007", "  a  b  "]
    assert _apply(spark, values, strip_spaces) == ["BR01", "BR01", "007", "ab"]


def test_fmt_price(spark):
    df = spark.createDataFrame([(1234.5,), (0.005,), (99.999,)], "p double")
    assert [r[0] for r in df.select(fmt_price("p")).collect()] == ["$1234.50", "$0.01", "$100.00"]


ascii_text = st.text(alphabet=st.characters(min_codepoint=32, max_codepoint=126), max_size=30)


@settings(max_examples=5, deadline=None)
@given(st.lists(ascii_text, min_size=1, max_size=40))
def test_matches_python_on_ascii(spark, values):
    assert _apply(spark, values, swap_case) == [v.swapcase() for v in values]
    assert _apply(spark, values, capitalize) == [v.capitalize() for v in values]
    assert _apply(spark, values, lambda c: title_case(c, python_rules=True)) == [v.title() for v in values]
    assert _apply(spark, values, upper_case) == [v.upper() for v in values]
    assert _apply(spark, values, char_length) == [len(v) for v in values]
