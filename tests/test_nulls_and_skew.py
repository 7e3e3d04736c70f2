"""Rows with missing keys stay, NaN is missing, files of any name are read, and
no plan sends a hot symbol to one task."""

import datetime as dt
import gzip
import json
import math
import os
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsmith.operators.stats import corr_matrix, corr_with, histogram, kde, pair_corr, predict_next_close
from tabsmith.operators.timeseries import daily_return, moving_average, next_close, page, sequence_views, tail_rows
from tabsmith.plans.bank import run_cleaning
from tabsmith.plans.sales import FINAL_SCHEMA, run_sales_load
from tabsmith.plans.stocks import returns
from tabsmith.session import get_session, shuffle_partitions_for
from tabsmith.sinks import input_roots, load_table, write_csv, write_json_arrays
from tabsmith.sources.files import read_json
from tabsmith.sources.registry import SourceSpec

D = dt.date


def _bars(spark, rows):
    return spark.createDataFrame(rows, "symbol string, dt date, close double")


@pytest.fixture()
def keyless(spark):
    return _bars(spark, [("A", D(2024, 1, 1), 1.0), ("A", D(2024, 1, 2), 2.0), ("A", None, 5.0), (None, D(2024, 1, 1), 3.0), (None, None, 4.0)])


def test_rows_without_keys_stay(keyless):
    for out in (daily_return(keyless), moving_average(keyless, 2), next_close(keyless), daily_return(keyless, fill_gaps=True), page(keyless, 1, 10), tail_rows(keyless, 10)):
        assert out.count() == 5
    got = {(r.symbol, r.dt): r.ret for r in daily_return(keyless).collect()}
    assert got[("A", None)] is None and got[("A", D(2024, 1, 2))] == 1.0
    assert got[("A", D(2024, 1, 1))] == 1.0 / 5.0 - 1  # the undated row comes first
    assert got[(None, D(2024, 1, 1))] == 3.0 / 4.0 - 1


def test_fit_histogram_and_density_keep_the_group_without_symbol(spark):
    rng = np.random.default_rng(1)
    bars = _bars(spark, [(s, D(2024, 1, 1) + dt.timedelta(days=k), float(100 + rng.normal())) for s in ("A", None) for k in range(40)])
    rets = returns(bars)
    assert histogram(rets, "ret", 10).filter("symbol IS NULL").agg(F.sum("count")).first()[0] == 39
    assert kde(rets, "ret", 20).filter("symbol IS NULL AND density > 0").count() > 0
    assert predict_next_close(bars).filter("symbol IS NULL AND predicted IS NOT NULL").count() == 39


def test_nan_is_missing(spark):
    nan = float("nan")
    days = [D(2024, 1, 1) + dt.timedelta(days=k) for k in range(40)]
    rng = np.random.default_rng(2)
    frame = pd.DataFrame({"dt": days, "A": 100 + rng.normal(size=40).cumsum(), "B": 50 + rng.normal(size=40).cumsum()})
    frame.loc[7, "A"] = nan
    bars = _bars(spark, [(s, r["dt"], float(r[s])) for _, r in frame.iterrows() for s in ("A", "B")])
    want = frame[["A", "B"]].pct_change(fill_method=None).corr().loc["A", "B"]
    got = {(r.symbol_a, r.symbol_b): r["corr"] for r in corr_matrix(returns(bars), ["A", "B"]).collect()}
    assert got[("A", "B")] == pytest.approx(want) and got[("A", "A")] == 1.0
    bench = {r.symbol: (r["corr"], r.n_pairs) for r in corr_with(daily_return(bars), "A").collect()}
    assert bench["B"] == (pytest.approx(want), 37)
    pair = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (nan, 1.0), (3.0, 5.9), (4.0, None)], "x double, y double")
    assert pair.agg(pair_corr("x", "y")).first()[0] == pytest.approx(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1])
    averages = moving_average(bars.filter("symbol = 'A'"), 3).orderBy("dt").toPandas()["ma3"]
    want = frame["A"].rolling(3).mean()
    assert averages.isna().tolist() == want.isna().tolist()
    assert averages.dropna().to_numpy() == pytest.approx(want.dropna().to_numpy())


def test_corr_matrix_has_one_plan_for_any_number_of_symbols(spark):
    def nodes(n):
        symbols = [f"S{k}" for k in range(n)]
        rets = spark.createDataFrame([(s, D(2024, 1, 1), 0.5) for s in symbols], "symbol string, dt date, ret double")
        return corr_matrix(rets, symbols)._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert nodes(10) == nodes(60)


def test_corr_matrix_of_many_symbols(spark):
    rng = np.random.default_rng(3)
    wide = pd.DataFrame(rng.normal(size=(120, 80)), columns=[f"S{k:02d}" for k in range(80)], index=[D(2024, 1, 1) + dt.timedelta(days=k) for k in range(120)])
    wide.iloc[5:40, 3] = np.nan
    wide["S10"] = 0.25  # flat
    long = wide.rename_axis("dt").reset_index().melt("dt", var_name="symbol", value_name="ret").dropna()
    rets = spark.createDataFrame(long[["symbol", "dt", "ret"]], "symbol string, dt date, ret double")
    begin = time.time()
    got = corr_matrix(rets, list(wide.columns)).toPandas()
    assert time.time() - begin < 60
    assert len(got) == 80 * 80
    table = got.pivot(index="symbol_a", columns="symbol_b", values="corr")
    want = wide.corr()
    mask = want.notna()
    assert np.allclose(table.to_numpy()[mask.to_numpy()], want.to_numpy()[mask.to_numpy()], atol=1e-10)
    assert table["S10"].isna().all()


def test_no_join_holds_a_hot_symbol(spark):
    rows = [("HOT" if k % 5 else f"S{k}", D(2020, 1, 1) + dt.timedelta(days=k), float(100 + k % 7)) for k in range(400)]
    bars = _bars(spark, rows)
    rets = bars.withColumnRenamed("close", "ret")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for out in (histogram(rets, "ret", 10), kde(rets, "ret", 10), predict_next_close(bars), tail_rows(bars, 5)):
            joins = [line for line in out._jdf.queryExecution().executedPlan().toString().splitlines() if "Join " in line]
            assert joins and all(line.count("symbol#") < 2 or line.count("__part") + line.count("__seg") + line.count("__blk") + line.count("bin") >= 2 for line in joins), joins
        assert histogram(rets, "ret", 10).agg(F.sum("count")).first()[0] == 400
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_density_multiplies_no_rows(spark):
    rets = spark.createDataFrame([("A", float(k)) for k in range(20)], "symbol string, ret double")
    plan = kde(rets, "ret", 50)._jdf.queryExecution().optimizedPlan().toString()
    explodes = [line for line in plan.splitlines() if "Generate" in line]
    assert all("__part" in line for line in explodes)  # only the small table of ranges is repeated


def test_tail_reads_only_the_last_segments(spark):
    rows = [(s, D(2020, 1, 1) + dt.timedelta(days=k), float(k)) for s in ("A", "B") for k in range(300)]
    got = {(r.symbol, r.dt) for r in tail_rows(_bars(spark, rows), 45).collect()}
    assert got == {(s, D(2020, 1, 1) + dt.timedelta(days=k)) for s in ("A", "B") for k in range(255, 300)}


def test_intraday_bars_choose_their_segments(spark):
    rows = [("A", dt.datetime(2024, 1, 1, 9, 0) + dt.timedelta(seconds=k), float(k + 1)) for k in range(300)]
    ticks = spark.createDataFrame(rows, "symbol string, dt timestamp, close double")
    got = next_close(ticks, unit="minute", block=16).orderBy("dt").toPandas()["next_close"]
    assert got.iloc[:-1].tolist() == [float(k + 2) for k in range(299)] and math.isnan(got.iloc[-1])
    assert sequence_views(ticks, ret="ret", unit="hour").count() == 300


def test_raw_files_of_any_name_are_read(spark, tmp_dir):
    head = "Transaction_ID,Transaction_Date,Transaction_Amount,Fee_Charged,Branch_Code,Transaction_Status\n"
    for at, name in enumerate(["a.csv", "deep/b.CSV", "deep/er/c.csv.gz", "part-00000"]):
        path = os.path.join(tmp_dir, "raw", name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        text = head + f"{at},2024-01-0{at + 1},10,1,B {at},Failed\n"
        if name.endswith(".gz"):
            with gzip.open(path, "wt") as f:
                f.write(text)
        else:
            with open(path, "w") as f:
                f.write(text)
    assert run_cleaning(spark, f"{tmp_dir}/raw", f"{tmp_dir}/cleaned").count() == 4
    assert run_cleaning(spark, f"{tmp_dir}/raw", f"{tmp_dir}/some", glob="*.csv").count() == 1


def test_sales_load_reconciles_feeds_without_schemas(spark, tmp_dir):
    with open(f"{tmp_dir}/jp.csv", "w") as f:
        f.write("SaleId,Category,Product,Qty,Sale\nA,Shoes,x,14.0,2.5\nB,Shoes,y,,3\nC,Shoes,z,NA,3\n")
    with open(f"{tmp_dir}/sl.json", "w") as f:
        json.dump([{"SaleId": "D", "Category": "Jeans", "Product": "w", "Qty": 3, "Sale": 7}], f)
    specs = [SourceSpec("csv", f"{tmp_dir}/jp.csv", "Japan"), SourceSpec("json", f"{tmp_dir}/sl.json", "SriLanka")]
    run_sales_load(spark, specs, path=f"{tmp_dir}/out", seed=1)
    got = {r.SaleId: (r.Qty, r.Amount, r.INR_Amount) for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == {"A": (14, 35.0, pytest.approx(19.95)), "D": (3, 21.0, 5.25)}


def test_an_empty_load_leaves_the_table(spark, tmp_dir):
    path = f"{tmp_dir}/table"
    load_table(spark.range(3), path=path)
    with pytest.raises(ValueError, match="No data"):
        load_table(spark.range(0), path=path)
    assert spark.read.parquet(path).count() == 3


def test_a_load_computes_its_rows_once(spark, tmp_dir):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    load_table(spark.range(100).mapInArrow(count, "id long"), path=f"{tmp_dir}/once")
    assert seen.value == 100 and spark.read.parquet(f"{tmp_dir}/once").count() == 100


def test_overwrite_guard_looks_at_folders(spark, tmp_dir):
    spark.range(50).repartition(20).write.parquet(f"{tmp_dir}/a/b")
    df = spark.read.parquet(f"{tmp_dir}/a/b")
    assert len(input_roots(df)) == 1
    for target in (f"{tmp_dir}/a/b", f"{tmp_dir}/a", f"{tmp_dir}/a/b/c"):
        with pytest.raises(ValueError, match="refusing"):
            write_csv(df, target)
    write_csv(df, f"{tmp_dir}/a/bc")


def test_json_arrays_of_bounded_length(spark, tmp_dir):
    df = spark.range(25, numPartitions=2).withColumn("t", F.when(F.col("id") % 3 > 0, F.col("id").cast("string")))
    write_json_arrays(df, f"{tmp_dir}/json", 4)
    files = [f for f in os.listdir(f"{tmp_dir}/json") if f.startswith("part-")]
    sizes = [len(json.load(open(f"{tmp_dir}/json/{f}"))) for f in files]
    assert sum(sizes) == 25 and max(sizes) <= 4
    back = read_json(spark, f"{tmp_dir}/json", schema=df.schema, multi_line=True)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_cluster_sizing_follows_input_and_argument(spark):
    assert shuffle_partitions_for(100 * 10**12) == -(-100 * 10**12 // (256 * 1024**2))
    keys = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.files.maxPartitionBytes",
            "spark.sql.adaptive.coalescePartitions.parallelismFirst", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        session = get_session("local[4]", cluster=True, shuffle_partitions=37)
        plan = session.range(10).groupBy((F.col("id") % 3).alias("k")).count()._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" in plan and ", 37)" in plan
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_final_schema_names(spark):
    assert FINAL_SCHEMA.fieldNames()[:2] == ["SaleId", "Category"]
