import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import dedupe, drop_any, drop_missing, fill, require_rows, status_in
from tabsmith.plans.bank import clean_transactions, failed_transactions, run_cleaning, run_failed_extract

RAW_SCHEMA = (
    "Transaction_ID string, Transaction_Date string, Transaction_Amount string, "
    "Fee_Charged string, Branch_Code string, Transaction_Status string, Note string"
)

RAW_ROWS = [
    ("t1", "2024-01-31", "100.5", "1.5", "BR 01", "Failed", "a"),
    ("t1", "2024-01-31", "100.5", "1.5", "BR 01", "Failed", "a"),  # exact duplicate
    ("t2", "31/01/2024", "10", "1", "BR01", "Failed", "b"),  # other date format -> dropped
    ("t3", "2024-02-30", "10", "1", "BR01", "Failed", "c"),  # impossible date -> dropped
    ("t4", "", "10", "1", "BR01", "Failed", "d"),  # empty date -> dropped
    ("t5", "2024-03-01", "abc", "", "\tBR\t02 ", "Declined", "e"),  # bad amount, empty fee
    ("t6", "2024-03-02", None, "2", "007", "failed", "f"),  # lower-case status not failed
    ("t7", "2024-03-03", "5", "0.5", "BR 03", "Success", "g"),
    ("t7", "2024-03-03", "5", "0.5", "BR03", "Success", "g"),  # differs only in spacing
    ("t8", "2024-03-04", "7", "0.1", "BR04", None, "h"),
    ("t9", "2024-03-05", "7", "0.1", "BR05", "", "i"),  # empty status is not failed
]


@pytest.fixture()
def raw(spark):
    return spark.createDataFrame(RAW_ROWS, RAW_SCHEMA)


def test_clean_transactions(raw):
    rows = clean_transactions(raw).collect()
    assert sorted(r.Transaction_ID for r in rows) == ["t1", "t5", "t6", "t7", "t7", "t8", "t9"]
    out = {(r.Transaction_ID, r.Branch_Code): r for r in rows}
    t1 = out[("t1", "BR01")]
    assert t1.Transaction_Date == dt.date(2024, 1, 31)
    assert (t1.Transaction_Amount, t1.Fee_Charged) == (100.5, 1.5)
    t5 = out[("t5", "BR02")]
    assert (t5.Transaction_Amount, t5.Fee_Charged) == (0.0, 0.0)
    assert out[("t6", "007")].Transaction_Amount == 0.0
    assert out[("t1", "BR01")].Note == "a"


def test_dedupe_runs_before_trimming(raw):
    cleaned = clean_transactions(raw).filter(F.col("Transaction_ID") == "t7")
    # Both raw rows survive de-duplication, then become identical after trimming.
    assert [r.Branch_Code for r in cleaned.collect()] == ["BR03", "BR03"]


def test_failed_extract(raw):
    failed = failed_transactions(clean_transactions(raw))
    assert sorted(r.Transaction_ID for r in failed.collect()) == ["t1", "t5"]


def test_schema_kept_when_nothing_survives(spark):
    empty = spark.createDataFrame([("x", "bad", "1", "1", "B", "Failed", "n")], RAW_SCHEMA)
    out = clean_transactions(empty)
    assert out.count() == 0
    assert dict(out.dtypes)["Transaction_Date"] == "date"
    assert dict(out.dtypes)["Transaction_Amount"] == "double"


def test_drop_and_fill_treat_nan_as_missing(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0)], "k int, v double")
    assert [r.k for r in drop_missing(df, ["v"]).collect()] == [3]
    assert [r.k for r in drop_any(df).collect()] == [3]
    assert sorted(r.v for r in fill(df, {"v": 0.0}).collect()) == [0.0, 0.0, 1.0]
    with pytest.raises(ValueError):
        fill(df, {"nope": 0})
    with pytest.raises(ValueError):
        drop_missing(df, ["nope"])


def test_status_in_pushes_into_scan(spark, tmp_dir):
    spark.createDataFrame([("Failed",), ("Success",)], "s string").write.parquet(tmp_dir + "/p")
    df = status_in(spark.read.parquet(tmp_dir + "/p"), "s", ["Failed", "Declined"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(s, [Declined,Failed])]" in plan or "In(s," in plan
    assert [r.s for r in df.collect()] == ["Failed"]


def test_require_rows(spark):
    with pytest.raises(ValueError, match="empty"):
        require_rows(spark.createDataFrame([], "a int"))
    assert dedupe(spark.createDataFrame([(1,), (1,)], "a int")).count() == 1


def test_jobs_over_nested_folders(spark, tmp_dir, raw):
    # Raw CSV files at three folder depths are all read.
    for depth, part in enumerate([RAW_ROWS[:3], RAW_ROWS[3:6], RAW_ROWS[6:]]):
        folder = os.path.join(tmp_dir, "raw", *["sub"] * depth)
        spark.createDataFrame(part, RAW_SCHEMA).coalesce(1).write.mode("overwrite").option("header", "true").csv(folder + "/batch")
    cleaned = run_cleaning(spark, tmp_dir + "/raw", tmp_dir + "/cleaned", schema=raw.schema)
    assert cleaned.count() == 7
    assert dict(cleaned.dtypes)["Branch_Code"] == "string"
    assert "007" in [r.Branch_Code for r in cleaned.collect()]
    failed = run_failed_extract(spark, tmp_dir + "/cleaned", tmp_dir + "/failed", schema=cleaned.schema)
    assert sorted(r.Transaction_ID for r in failed.collect()) == ["t1", "t5"]


def test_parse_dates_accepts_typed_columns(spark):
    from tabsmith.operators import parse_dates

    df = spark.createDataFrame(
        [(dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 13, 5), "2024-01-02")], "d date, ts timestamp, s string"
    )
    row = parse_dates(df, ["d", "ts", "s"]).first()
    assert row.d == row.ts == row.s == dt.date(2024, 1, 2)


def test_cleaning_with_inferred_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "typed.csv")
    with open(path, "w") as f:
        f.write("Transaction_Date,Transaction_Amount,Fee_Charged,Branch_Code,Transaction_Status\n")
        f.write("2024-01-02,10.5,1,007,Failed\n2024-01-03,abc,,BR 01,Declined\n")
    from tabsmith.sources import read_csv

    raw = read_csv(spark, path, infer_schema=True)
    rows = sorted(clean_transactions(raw).collect(), key=lambda r: r.Transaction_Date)
    assert [r.Transaction_Date for r in rows] == [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]
    assert [r.Transaction_Amount for r in rows] == [10.5, 0.0]
    assert [r.Branch_Code for r in rows] == ["007", "BR01"]  # mixed column stays text under inference
