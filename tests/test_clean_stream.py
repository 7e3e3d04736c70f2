"""The cleaning job as a stream."""

import os

from pyspark.sql import functions as F

from tabsmith.plans.bank import clean_transactions
from tabsmith.sources import read_csv
from tabsmith.streaming import cleaned_stream, run_clean_stream
from tabsmith.streaming.bank import row_digest

SCHEMA = "Transaction_ID string, Transaction_Date string, Transaction_Amount string, Fee_Charged string, Branch_Code string, Transaction_Status string"
HEAD = "Transaction_ID,Transaction_Date,Transaction_Amount,Fee_Charged,Branch_Code,Transaction_Status\n"


def put(path, *rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(HEAD + "".join(f"{r}\n" for r in rows))


def result(spark, path):
    return sorted(map(tuple, spark.read.parquet(path).collect()), key=str)


def test_equals_the_batch_clean_over_batches_and_restarts(spark, tmp_dir):
    schema = spark.createDataFrame([], SCHEMA).schema
    args = (spark, f"{tmp_dir}/raw", f"{tmp_dir}/out", f"{tmp_dir}/progress", schema)
    put(f"{tmp_dir}/raw/a.csv", "1,2024-01-01,5,1,B 1,Failed", "1,2024-01-01,5,1,B 1,Failed", "2,bad,5,1,B,Failed", "3,2019-05-01,,x,B\t2,Success")
    put(f"{tmp_dir}/raw/deep/b.csv", "1,2024-01-01,5,1,B 1,Failed", "1,2024-01-01,5,1,B  1,Failed")
    run_clean_stream(*args, max_files_per_trigger=1).awaitTermination()
    # later batches: copies of old rows, an older date, a new row
    put(f"{tmp_dir}/raw/deep/er/c.csv", "1,2024-01-01,5,1,B 1,Failed", "3,2019-05-01,,x,B\t2,Success", "4,1999-01-01,7,0,C,Declined", "5,2025-01-01,,,,")
    run_clean_stream(*args).awaitTermination()
    run_clean_stream(*args).awaitTermination()  # nothing new
    batch = clean_transactions(read_csv(spark, f"{tmp_dir}/raw", schema=schema, recursive=True))
    want = sorted(map(tuple, batch.collect()), key=str)
    assert result(spark, f"{tmp_dir}/out") == want and len(want) == 5


def test_the_state_holds_one_window(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/raw")
    plan = cleaned_stream(spark, f"{tmp_dir}/raw", spark.createDataFrame([], SCHEMA).schema, window="3 days")._jdf.queryExecution().analyzed().toString()
    assert "DeduplicateWithinWatermark [__digest" in plan and "EventTimeWatermark" in plan and "3 days" in plan


def test_digests_tell_rows_apart(spark):
    rows = [("a", None), (None, "a"), ("a", ""), ("", "a"), ("a-", None), ("1:a", None), ("a", "-"), (None, None), ("", ""), ("ab", "c"), ("a", "bc")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(row_digest(["x", "y"]).alias("d")).agg(F.countDistinct("d")).first()[0] == len(rows)
