"""Price-bar views checked against brute force in pandas / numpy."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsmith.operators import (
    close_matrix,
    corr_matrix,
    corr_with,
    daily_return,
    extremes,
    fit_next_close,
    histogram,
    kde,
    moving_average,
    page,
    page_info,
    predict_next_close,
    select_bars,
    tail_rows,
    with_indicators,
)
from tabsmith.plans.stocks import returns, stock_views

BAR_SCHEMA = "symbol string, dt date, open double, high double, low double, close double, volume long"


def _series(symbol, n, seed, start=dt.date(2020, 1, 1), step=1, flat=False):
    rng = np.random.default_rng(seed)
    close = np.full(n, 50.0) if flat else np.round(100 * np.exp(np.cumsum(rng.normal(0, 0.02, n))), 2)
    rows = []
    for i in range(n):
        c = float(close[i])
        rows.append((symbol, start + dt.timedelta(days=i * step), c, c + 1.0, c - 1.0, c, 1000 + i))
    return rows


@pytest.fixture(scope="module")
def bars_pd():
    rows = _series("AAA", 250, 1) + _series("BBB", 183, 2, start=dt.date(2020, 2, 1), step=2) + _series("CCC", 49, 3)
    rows += _series("FLAT", 30, 4, flat=True) + _series("ONE", 1, 5)
    return pd.DataFrame(rows, columns=["symbol", "dt", "open", "high", "low", "close", "volume"])


@pytest.fixture(scope="module")
def bars(spark, bars_pd):
    return spark.createDataFrame(bars_pd, BAR_SCHEMA).cache()


def test_returns_and_moving_averages(bars, bars_pd):
    got = with_indicators(bars).toPandas().sort_values(["symbol", "dt"]).reset_index(drop=True)
    exp = bars_pd.sort_values(["symbol", "dt"]).reset_index(drop=True)
    g = exp.groupby("symbol")["close"]
    np.testing.assert_allclose(got["ret"], g.pct_change(fill_method=None), rtol=1e-12, equal_nan=True)
    np.testing.assert_allclose(got["ma50"], g.transform(lambda s: s.rolling(50).mean()), rtol=1e-12, equal_nan=True)
    np.testing.assert_allclose(got["ma200"], g.transform(lambda s: s.rolling(200).mean()), rtol=1e-12, equal_nan=True)
    np.testing.assert_allclose(got["next_close"], g.shift(-1), rtol=0, equal_nan=True)
    # windows fill exactly at 50 and 200 rows
    a = got[got.symbol == "AAA"].reset_index(drop=True)
    assert a["ma50"].isna().sum() == 49 and a["ma200"].isna().sum() == 199
    assert got[got.symbol == "CCC"]["ma50"].isna().all()


def test_moving_average_rename(bars, bars_pd):
    got = moving_average(bars, 3, out="m3").toPandas().sort_values(["symbol", "dt"]).reset_index(drop=True)
    exp = bars_pd.sort_values(["symbol", "dt"]).reset_index(drop=True).groupby("symbol")["close"]
    np.testing.assert_allclose(got["m3"], exp.transform(lambda s: s.rolling(3).mean()), rtol=1e-12, equal_nan=True)
    assert "ma3" not in got.columns


def test_return_edge_cases(spark):
    df = spark.createDataFrame(
        [("Z", dt.date(2020, 1, d), c, c, c, c, 1) for d, c in [(1, 1.0), (2, None), (3, 2.0), (4, 0.0), (5, 3.0)]],
        BAR_SCHEMA,
    )
    plain = [r.ret for r in daily_return(df).orderBy("dt").collect()]
    assert plain[:3] == [None, None, None] and plain[3] == -1.0 and plain[4] is None  # zero previous close -> null
    filled = [r.ret for r in daily_return(df, fill_gaps=True).orderBy("dt").collect()]
    assert filled[:3] == [None, 0.0, 1.0]


def test_select_bars(bars):
    got = select_bars(bars, "aaa", "2020-01-10", "2020-01-20")
    assert got.count() == 10
    with pytest.raises(ValueError):
        select_bars(bars, " ")


def test_tail_and_pages(bars, bars_pd):
    tail = tail_rows(bars, 180)
    counts = {r.symbol: r.total_rows for r in page_info(tail, 5).collect()}
    assert counts == {"AAA": 180, "BBB": 180, "CCC": 49, "FLAT": 30, "ONE": 1}
    last = bars_pd[bars_pd.symbol == "BBB"].sort_values("dt").tail(180)
    got = tail.filter("symbol = 'BBB'").orderBy("dt").toPandas()
    assert list(got["dt"]) == list(last["dt"])
    pages = {r.symbol: r.total_pages for r in page_info(tail, 5).collect()}
    assert pages["AAA"] == 36 and pages["CCC"] == 10 and pages["ONE"] == 1
    p3 = page(tail, 3, 5).filter("symbol = 'BBB'").orderBy("dt").toPandas()
    assert list(p3["row_no"]) == [11, 12, 13, 14, 15] and list(p3["dt"]) == list(last["dt"].iloc[10:15])
    # shift=1 shows rows 2-6 under the label 1-5; the last page of 180 is one short
    shifted = page(tail, 1, 5, shift=1).filter("symbol = 'BBB'").orderBy("dt").toPandas()
    assert list(shifted["dt"]) == list(last["dt"].iloc[1:6])
    assert page(tail, 36, 5, shift=1).filter("symbol = 'BBB'").count() == 4


def test_pages_of_eleven_and_fifteen(spark):
    rows = [("E", dt.date(2021, 1, 1) + dt.timedelta(days=i), 1.0, 1.0, 1.0, 1.0, 1) for i in range(11)]
    rows += [("F", dt.date(2021, 1, 1) + dt.timedelta(days=i), 1.0, 1.0, 1.0, 1.0, 1) for i in range(15)]
    df = spark.createDataFrame(rows, BAR_SCHEMA)
    assert {r.symbol: r.total_pages for r in page_info(df, 5).collect()} == {"E": 3, "F": 3}
    assert page(df, 3, 5).filter("symbol = 'E'").count() == 1
    assert page(df, 3, 5).filter("symbol = 'F'").count() == 5


def test_correlations(bars, bars_pd):
    rets = returns(bars)
    wide = bars_pd.pivot(index="dt", columns="symbol", values="close").sort_index()
    # per-symbol returns on each symbol's own calendar, then aligned by date
    per = bars_pd.sort_values("dt").groupby("symbol")["close"].pct_change(fill_method=None)
    r = bars_pd.assign(ret=per).pivot(index="dt", columns="symbol", values="ret")
    exp = r.corr()
    syms = ["AAA", "BBB", "CCC"]
    got = {(x.symbol_a, x.symbol_b): x.corr for x in corr_matrix(rets, syms).collect()}
    assert len(got) == 9
    for a in syms:
        for b in syms:
            assert got[(a, b)] == pytest.approx(exp.loc[a, b], rel=1e-9)
            assert got[(a, b)] == pytest.approx(got[(b, a)], rel=1e-12)
    assert all(got[(a, a)] == 1.0 for a in syms)
    bench = {x.symbol: x.corr for x in corr_with(rets, "aaa").collect()}
    assert bench["AAA"] == 1.0
    assert bench["AAA"] == pytest.approx(1.0) and bench["BBB"] == pytest.approx(exp.loc["BBB", "AAA"], rel=1e-9)
    assert bench["FLAT"] is None  # flat series: no correlation, and no division error
    assert "ONE" not in bench  # a single bar has no return
    assert wide.shape[1] == 5


def test_next_close_regression(bars, bars_pd):
    fit = {r.symbol: r for r in fit_next_close(bars).collect()}
    a = bars_pd[bars_pd.symbol == "AAA"].sort_values("dt")
    x, y = a["close"].to_numpy()[:-1], a["close"].to_numpy()[1:]
    slope, intercept = np.polyfit(x, y, 1)
    assert fit["AAA"].slope == pytest.approx(slope, rel=1e-9)
    assert fit["AAA"].intercept == pytest.approx(intercept, rel=1e-7)
    assert fit["AAA"].n == 249
    assert fit["FLAT"].slope == 0.0 and fit["FLAT"].intercept == 50.0
    assert "ONE" not in fit  # a single bar has no target
    pred = predict_next_close(bars).filter("symbol = 'AAA'").toPandas()
    assert len(pred) == 249
    assert (pred["next_close"] - pred["predicted"]).sum() == pytest.approx(0.0, abs=1e-6)


def test_histogram_matches_numpy(bars, bars_pd):
    rets = returns(bars)
    got = histogram(rets, "ret", 100).filter("symbol = 'AAA'").toPandas()
    a = bars_pd[bars_pd.symbol == "AAA"].sort_values("dt")["close"].pct_change(fill_method=None).dropna().to_numpy()
    counts, edges = np.histogram(a, bins=100)
    exp = dict(enumerate(counts))  # empty bins included
    assert dict(zip(got["bin"], got["count"])) == exp
    assert got["count"].sum() == len(a)
    for _, row in got.iterrows():
        assert row["bin_lo"] == pytest.approx(edges[row["bin"]], rel=1e-12, abs=1e-15)
    flat = histogram(rets, "ret", 100).filter("symbol = 'FLAT'").collect()
    assert len(flat) == 100 and [(r["bin"], r["count"]) for r in flat if r["count"]] == [(0, 29)]


def test_kde_matches_brute_force(bars, bars_pd):
    rets = returns(bars)
    got = kde(rets, "ret", 200).filter("symbol = 'AAA'").orderBy("i").toPandas()
    a = bars_pd[bars_pd.symbol == "AAA"].sort_values("dt")["close"].pct_change(fill_method=None).dropna().to_numpy()
    h = a.std(ddof=1) * len(a) ** (-0.2)
    grid = np.linspace(a.min(), a.max(), 200)
    dens = np.exp(-0.5 * ((grid[:, None] - a[None, :]) / h) ** 2).sum(axis=1) / (len(a) * h * math.sqrt(2 * math.pi))
    np.testing.assert_allclose(got["x"], grid, rtol=1e-12)
    np.testing.assert_allclose(got["density"], dens, rtol=1e-9)
    # a density over a grid spanning the data integrates to a bit under 1
    assert 0.8 < np.trapezoid(got["density"], got["x"]) <= 1.0


def test_extremes_and_close_matrix(bars, bars_pd):
    got = {r.symbol: r for r in extremes(bars).collect()}
    a = bars_pd[bars_pd.symbol == "AAA"]
    assert got["AAA"].highest == a["high"].max() and got["AAA"].lowest == a["low"].min()
    assert got["AAA"].highest_txt == f"${a['high'].max():.2f}"
    wide = close_matrix(bars, ["aaa", "BBB"]).toPandas().set_index("dt").sort_index()
    exp = bars_pd.pivot(index="dt", columns="symbol", values="close")[["AAA", "BBB"]]
    exp = exp.dropna(how="all")
    assert len(wide) == len(bars_pd[bars_pd.symbol.isin(["AAA", "BBB", "CCC", "FLAT", "ONE"])]["dt"].unique())
    pd.testing.assert_frame_equal(wide.loc[exp.index], exp, check_names=False)


def test_stock_views(bars):
    views = stock_views(bars, ["aaa", "bbb"], start=None, end=None, benchmark="AAA")
    assert views["details"].count() == 10
    assert {r.symbol_a for r in views["correlation"].collect()} == {"AAA", "BBB"}
    assert views["price"].count() == 2
    with pytest.raises(ValueError, match="No data"):
        stock_views(bars, "zzz")


@pytest.mark.parametrize("block,unit", [(4, "month"), (7, "day"), (64, "year"), (5, "week")])
def test_blocked_windows_match_whole_series(spark, bars_pd, block, unit):
    from tabsmith.operators import positions, sequence_views

    # gaps, including a run of missing prices longer than a block
    pdf = bars_pd.copy()
    holes = pdf.index[(pdf.symbol == "AAA") & pdf.index.isin(list(range(20, 31)) + [60, 61, 99])]
    pdf.loc[holes, ["close"]] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), BAR_SCHEMA)
    got = (
        sequence_views(df, ret="ret", windows=[3, 5], lead="nxt", unit=unit, block=block)
        .toPandas()
        .sort_values(["symbol", "dt"])
        .reset_index(drop=True)
    )
    exp = pdf.sort_values(["symbol", "dt"]).reset_index(drop=True)
    g = exp.groupby("symbol")["close"]
    np.testing.assert_allclose(got["ret"].astype(float), g.pct_change(fill_method=None), rtol=1e-12, equal_nan=True)
    np.testing.assert_allclose(got["ma3"].astype(float), g.transform(lambda s: s.rolling(3).mean()), rtol=1e-12, equal_nan=True)
    np.testing.assert_allclose(got["ma5"].astype(float), g.transform(lambda s: s.rolling(5).mean()), rtol=1e-12, equal_nan=True)
    np.testing.assert_allclose(got["nxt"].astype(float), g.shift(-1), rtol=0, equal_nan=True)
    filled = (
        sequence_views(df, ret="ret", fill_gaps=True, unit=unit, block=block)
        .toPandas()
        .sort_values(["symbol", "dt"])
        .reset_index(drop=True)
    )
    padded = g.transform(lambda s: s.ffill())
    exp_filled = padded / padded.groupby(exp["symbol"]).shift(1) - 1
    np.testing.assert_allclose(filled["ret"].astype(float), exp_filled, rtol=1e-12, equal_nan=True)
    pos = positions(df, unit).toPandas().sort_values(["symbol", "dt"]).reset_index(drop=True)
    assert list(pos["__pos"]) == list(exp.groupby("symbol").cumcount() + 1)
    assert list(pos["__total"]) == list(exp.groupby("symbol")["dt"].transform("size"))


def test_intraday_segments(spark):
    from tabsmith.operators import positions, sequence_views

    rows = [("I", dt.datetime(2024, 1, 2, 9, 30) + dt.timedelta(minutes=7 * i), float(100 + i % 13)) for i in range(300)]
    df = spark.createDataFrame(rows, "symbol string, dt timestamp, close double")
    pos = [r["__pos"] for r in positions(df, "hour").orderBy("dt").collect()]
    assert pos == list(range(1, 301))
    got = sequence_views(df, ret="ret", windows=[20], unit="minute", block=16).orderBy("dt").toPandas()
    s = pd.Series([float(100 + i % 13) for i in range(300)])
    np.testing.assert_allclose(got["ma20"].astype(float), s.rolling(20).mean(), rtol=1e-12, equal_nan=True)
    np.testing.assert_allclose(got["ret"].astype(float), s.pct_change(), rtol=1e-12, equal_nan=True)


def test_hot_symbol_is_spread_over_blocks(spark):
    from tabsmith.operators.timeseries import BLK, HALO, _with_halo, positions

    hot = [("HOT", dt.date(2000, 1, 1) + dt.timedelta(days=i), float(i % 17 + 1)) for i in range(3000)]
    cold = [("COLD", dt.date(2000, 1, 1) + dt.timedelta(days=i), 1.0) for i in range(30)]
    df = spark.createDataFrame(hot + cold, "symbol string, dt date, close double")
    framed = _with_halo(positions(df, "month"), back=49, front=1, block=500)
    per_block = {
        (r.symbol, r[BLK]): (r.rows, r.halo)
        for r in framed.groupBy("symbol", BLK).agg(F.count("*").alias("rows"), F.sum(F.col(HALO).cast("int")).alias("halo")).collect()
    }
    hot_blocks = [k for k in per_block if k[0] == "HOT"]
    assert len(hot_blocks) == 6  # 3000 rows in blocks of 500: no task holds the whole symbol
    assert max(v[0] for v in per_block.values()) <= 500 + 49 + 1
    assert per_block[("HOT", 0)] == (501, 1) and per_block[("HOT", 3)] == (550, 50)
    assert per_block[("COLD", 0)] == (30, 0)


def test_fill_gaps_with_windows_and_lead(spark):
    from tabsmith.operators import sequence_views

    closes = [1.0, None, 2.0, None, None, 4.0, 5.0, None]
    df = spark.createDataFrame(
        [("Z", dt.date(2020, 1, 1) + dt.timedelta(days=i), c) for i, c in enumerate(closes)], "symbol string, dt date, close double"
    )
    got = sequence_views(df, ret="ret", windows=[2], lead="nxt", fill_gaps=True, block=3).orderBy("dt").toPandas()
    s = pd.Series(closes, dtype=float)
    padded = s.ffill()
    np.testing.assert_allclose(got["ret"].astype(float), padded / padded.shift(1) - 1, equal_nan=True)
    np.testing.assert_allclose(got["ma2"].astype(float), s.rolling(2).mean(), equal_nan=True)
    np.testing.assert_allclose(got["nxt"].astype(float), s.shift(-1), equal_nan=True)


@pytest.mark.parametrize("n", [1, 49, 50, 199, 200])
def test_window_fill_boundaries(spark, n):
    df = spark.createDataFrame(_series("S", n, 11), BAR_SCHEMA)
    got = with_indicators(df).toPandas()
    assert got["ma50"].notna().sum() == max(0, n - 49)
    assert got["ma200"].notna().sum() == max(0, n - 199)
    assert got["ret"].notna().sum() == n - 1 and got["next_close"].notna().sum() == n - 1
