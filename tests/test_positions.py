"""Row numbers from one range shuffle."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import page, positions, sequence_views
from tabsmith.operators import timeseries
from tabsmith.operators.timeseries import _in_order


@pytest.fixture()
def undated(spark):
    """A third of the rows has no date, another third one single moment."""
    day = dt.datetime(2024, 1, 1)
    rows = [("A", None, float(i)) for i in range(300)] + [("A", day, float(i)) for i in range(300)]
    rows += [(None, day + dt.timedelta(minutes=i), float(i)) for i in range(150)] + [("B", day + dt.timedelta(minutes=i), float(i)) for i in range(150)]
    return spark.createDataFrame(rows, "symbol string, dt timestamp, close double")


@pytest.fixture()
def no_help(spark):
    """Nothing is small enough for a broadcast by size, and small partitions are not merged."""
    keys = {"spark.sql.autoBroadcastJoinThreshold": "1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_one_exchange_of_rows_before_the_windows(undated, no_help):
    for views in (sequence_views(undated, ret="ret", windows=[3], lead="nxt"), sequence_views(undated, windows=[5])):
        plan = views._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan and "rangepartitioning" not in plan


def test_filled_returns_leave_the_rows_where_the_windows_have_them(undated, no_help):
    plan = sequence_views(undated, ret="ret", fill_gaps=True)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line and "Broadcast" not in line]
    assert len(moved) <= 4  # the rows for each of the two readers, and the table with a row per block twice
    joins = plan.split("SortMergeJoin")[1:]
    assert len(joins) == 1 and "coalesce" not in joins[0].splitlines()[0]


def test_undated_and_simultaneous_rows_are_split(spark, undated, no_help):
    laid = _in_order(undated, "symbol")
    by_part = laid.groupBy("symbol", "dt").agg(F.countDistinct("__part").alias("parts"), F.count("*").alias("rows")).filter("rows > 100").collect()
    assert len(by_part) == 2 and all(r["parts"] > 1 for r in by_part)


@pytest.mark.parametrize("most", [0, timeseries.MAX_PIECES])
def test_positions_count_every_row_once(undated, no_help, monkeypatch, most):
    monkeypatch.setattr(timeseries, "MAX_PIECES", most)  # with no piece sent to all tasks, by a shuffle
    rows = positions(undated).collect()
    for symbol, n in (("A", 600), (None, 150), ("B", 150)):
        own = [r for r in rows if r["symbol"] == symbol]
        assert sorted(r["__pos"] for r in own) == list(range(1, n + 1)) and {r["__total"] for r in own} == {n}
        in_order = [r["dt"] for r in sorted(own, key=lambda r: r["__pos"])]
        assert in_order == sorted(in_order, key=lambda d: (d is not None, d))
    assert sorted(r["close"] for r in rows) == sorted(r["close"] for r in undated.collect())


def test_equal_dates_keep_one_order(undated):
    """Pages over rows of one moment are disjoint and repeatable."""
    def pages():
        return [[r["close"] for r in page(undated.filter("symbol = 'A'"), k, 200).orderBy("row_no").collect()] for k in (1, 2, 3)]

    first = pages()
    assert first == pages() and sorted(sum(first, [])) == sorted([float(i) for i in range(300)] * 2)


def test_empty_and_bad_input(undated):
    assert positions(undated.limit(0)).collect() == []
    with pytest.raises(ValueError):
        positions(undated, "decade")
