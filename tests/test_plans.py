"""Plan regression checks: the properties the design relies on at scale."""

import contextlib
import io

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas")


def _plan(spark, name):
    return entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def _formatted(spark, name):
    """``explain("formatted")``: one line per scan attribute, not abbreviated."""
    buffer = io.StringIO()
    with contextlib.redirect_stdout(buffer):
        entry.queries()[name](spark, SF).explain("formatted")
    return buffer.getvalue()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_pair_joins_and_no_python_in_plans(spark, name):
    plan = _plan(spark, name)
    assert not [node for node in FORBIDDEN if node in plan]


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [In(o_orderstatus, [F,P])]" in _formatted(spark, "status_in")
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderpriority:string>" in _formatted(spark, "strip_spaces")
    bars_range = _formatted(spark, "bars_range")
    assert "EqualTo(o_orderpriority,1-URGENT)" in bars_range
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00), LessThan(o_orderdate,1997-01-01T00:00)" in bars_range
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz,o_orderpriority:string>" in bars_range


def test_top_k_is_limited_before_the_shuffle(spark):
    plan = _plan(spark, "tail_180")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_share_total_is_a_subquery(spark):
    plan = _plan(spark, "event_share")
    assert "Subquery" in plan and "Join" not in plan


def test_currency_dict_needs_no_join(spark):
    from pyspark.sql import functions as F

    from tabsmith.operators import convert

    df = spark.range(3).select(F.lit("Japan").alias("Country"), F.lit(2.0).alias("Amount"))
    plan = convert(df, {"Japan": 0.57})._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
