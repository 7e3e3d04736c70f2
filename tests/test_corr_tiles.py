"""The correlation matrix by tiles of symbols, keyed by dt as it stands."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from tabsmith.operators.stats import corr_matrix, corr_with


def _long(spark, wide, kind="date"):
    long = wide.rename_axis("dt").reset_index().melt("dt", var_name="symbol", value_name="ret").dropna()
    return spark.createDataFrame(long[["symbol", "dt", "ret"]], f"symbol string, dt {kind}, ret double")


def _matrix(df):
    return df.toPandas().pivot(index="symbol_a", columns="symbol_b", values="corr").astype(float)


@pytest.mark.parametrize("tile", [1, 7, 16, 256])
def test_tiles_of_any_size_give_the_same(spark, tile):
    rng = np.random.default_rng(tile)
    wide = pd.DataFrame(rng.normal(size=(700, 20)), columns=[f"S{k:02d}" for k in range(20)], index=[dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(700)])
    wide = wide.mask(rng.random(wide.shape) < 0.2)
    wide["S05"] = np.nan
    wide["S06"] = 3.25
    wide.loc[wide.index[1:], "S07"] = np.nan
    got = _matrix(corr_matrix(_long(spark, wide), list(wide.columns), tile=tile))
    assert got.shape == (20, 20) and got.loc["S05"].isna().all() and got["S06"].isna().all() and got["S07"].isna().all()
    live = [c for c in wide if c not in ("S05", "S06", "S07")]
    np.testing.assert_allclose(got.loc[live, live], wide[live].corr(), atol=1e-10)


def test_many_symbols_use_a_task_per_tile(spark):
    rng = np.random.default_rng(0)
    wide = pd.DataFrame(rng.normal(size=(30, 150)), columns=[f"S{k:03d}" for k in range(150)], index=[dt.date(2020, 1, 1) + dt.timedelta(days=k) for k in range(30)])
    out = corr_matrix(_long(spark, wide), list(wide.columns), tile=10)
    assert "REPARTITION_BY_NUM, [plan_id" in out._jdf.queryExecution().executedPlan().toString()
    assert ", 120), REPARTITION_BY_NUM" in out._jdf.queryExecution().executedPlan().toString()  # 15 strips
    np.testing.assert_allclose(_matrix(out), wide.corr(), atol=1e-10)


def test_intraday_values_count_as_they_stand(spark):
    rng = np.random.default_rng(5)
    moments = [dt.datetime(2024, 1, 1, 9) + dt.timedelta(days=k // 4, hours=k % 4) for k in range(80)]
    wide = pd.DataFrame(rng.normal(size=(80, 3)), columns=["AAPL", "B", "C"], index=moments)
    rets = _long(spark, wide, "timestamp")
    got = _matrix(corr_matrix(rets, ["AAPL", "B", "C"]))
    np.testing.assert_allclose(got, wide.corr(), atol=1e-12)
    with_bench = {r["symbol"]: r["corr"] for r in corr_with(rets, "AAPL").collect()}
    np.testing.assert_allclose([with_bench[c] for c in ("AAPL", "B", "C")], got["AAPL"], atol=1e-12)


def test_several_values_of_one_moment(spark):
    rows = [("A", k, float(k * k % 7)) for k in range(10)] + [("B", k, float(k % 3)) for k in range(10)] + [("B", 4, -9.0), ("A", 2, 50.0)]
    rets = spark.createDataFrame([(s, dt.date(2024, 1, 1) + dt.timedelta(days=k), v) for s, k, v in rows], "symbol string, dt date, ret double")
    greatest = pd.DataFrame(rows, columns=["s", "k", "v"]).groupby(["k", "s"])["v"].max().unstack()
    want = greatest["A"].corr(greatest["B"])
    assert _matrix(corr_matrix(rets, ["A", "B"])).loc["A", "B"] == pytest.approx(want, abs=1e-12)
    assert {r["symbol"]: r["corr"] for r in corr_with(rets, "A").collect()}["B"] == pytest.approx(want, abs=1e-12)


def test_no_rows(spark):
    rets = spark.createDataFrame([], "symbol string, dt date, ret double")
    assert [r["corr"] for r in corr_matrix(rets, ["A", "B"]).collect()] == [None] * 4
