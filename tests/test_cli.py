import datetime as dt
import json
import os

from tabsmith.cli import _parser, run

RAW_DDL = "Transaction_ID string, Transaction_Date string, Transaction_Amount string, Fee_Charged string, Branch_Code string, Transaction_Status string"


def _run(spark, *argv):
    run(_parser().parse_args(list(argv)), spark)


def test_bank_jobs_from_the_command_line(spark, tmp_dir):
    rows = [
        ("a", "2024-01-01", "10", "1", "BR 1", "Failed"),
        ("b", "2024-01-02", "x", "", "BR2", "Declined"),
        ("c", "bad", "1", "1", "BR3", "Failed"),
        ("d", "2024-01-04", "5", "1", "BR4", "Success"),
    ]
    df = spark.createDataFrame(rows, RAW_DDL)
    df.limit(2).write.option("header", "true").csv(os.path.join(tmp_dir, "raw", "one"))
    df.subtract(df.limit(2)).write.option("header", "true").csv(os.path.join(tmp_dir, "raw", "deeper", "two"))
    _run(spark, "clean", "--raw", f"{tmp_dir}/raw", "--out", f"{tmp_dir}/cleaned", "--schema", RAW_DDL)
    _run(spark, "failed", "--cleaned", f"{tmp_dir}/cleaned", "--out", f"{tmp_dir}/failed")
    failed = spark.read.option("header", "true").csv(f"{tmp_dir}/failed")
    assert sorted(r.Transaction_ID for r in failed.collect()) == ["a", "b"]


def test_sales_from_the_command_line(spark, tmp_dir):
    csv_path, json_path = f"{tmp_dir}/japan_feed.csv", f"{tmp_dir}/srilanka_feed.json"
    with open(csv_path, "w") as f:
        f.write("SaleId,Category,Product,Qty,Sale\nJ1,Shoes,a,2,10\nJ2,Shoes,b,NA,3\n")
    with open(json_path, "w") as f:
        json.dump([{"SaleId": "S1", "Category": "Jeans", "Product": "c", "Qty": 4, "Sale": 2.5}], f)
    specs = f"{tmp_dir}/specs.json"
    with open(specs, "w") as f:
        json.dump([{"kind": "csv", "location": csv_path, "country": "Japan"}, {"kind": "json", "location": json_path, "country": "SriLanka"}], f)
    _run(spark, "sales", "--sources", specs, "--path", f"{tmp_dir}/final", "--seed", "5")
    got = {r.SaleId: r for r in spark.read.parquet(f"{tmp_dir}/final").collect()}
    assert set(got) == {"J1", "S1"} and got["J1"].INR_Amount == 20 * 0.57 and got["S1"].Qty == 4


def test_stocks_from_the_command_line(spark, tmp_dir):
    rows = [("AAPL", dt.date(2020, 1, 1) + dt.timedelta(days=i), 1.0, 2.0, 0.5, 1.0 + (i % 7), 10) for i in range(260)]
    rows += [("MSFT", dt.date(2020, 1, 1) + dt.timedelta(days=i), 1.0, 2.0, 0.5, 2.0 + (i % 5), 10) for i in range(260)]
    spark.createDataFrame(rows, "symbol string, dt date, open double, high double, low double, close double, volume long").write.parquet(
        f"{tmp_dir}/bars"
    )
    _run(spark, "stocks", "--bars", f"{tmp_dir}/bars", "--out", f"{tmp_dir}/views", "--symbol", "msft", "--page", "2")
    details = spark.read.parquet(f"{tmp_dir}/views/details")
    assert [r.row_no for r in details.orderBy("row_no").collect()] == [6, 7, 8, 9, 10]
    corr = spark.read.parquet(f"{tmp_dir}/views/correlation")
    assert corr.count() == 4
    assert spark.read.parquet(f"{tmp_dir}/views/averages").filter("ma200 IS NOT NULL").count() == 61
