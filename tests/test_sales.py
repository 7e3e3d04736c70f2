import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tabsmith.operators import convert, random_int, share, tag, union_all
from tabsmith.plans.sales import CURRENCY_RATES, FINAL_SCHEMA, final_sales, run_sales_load, transform_sales
from tabsmith.sinks import conform, load_table
from tabsmith.sources import SourceSpec, load_sources, read_csv

FEED = "SaleId string, Category string, Product string, Qty double, Sale double"


def _feed(spark, rows, country):
    return tag(spark.createDataFrame(rows, FEED), "Country", country)


def test_transform_sales_totals(spark):
    japan = _feed(spark, [("J1", "Shoes", "Run", 2.0, 10.0), ("J2", "Jeans", "Blue", None, 5.0)], "Japan")
    india = _feed(spark, [("I1", "Perfumes", "Rose's", 3.0, 100.0)], "India")
    nowhere = _feed(spark, [("X1", "Shoes", "Odd", 1.0, 7.0)], "Atlantis")
    unknown = _feed(spark, [("N1", "Shoes", "Odd", 1.0, 7.0)], None)
    out = transform_sales(union_all([japan, india, nowhere, unknown]), seed=7)
    rows = {r.SaleId: r for r in out.collect()}
    assert set(rows) == {"J1", "I1", "X1"}  # J2 (missing Qty) and N1 (null country) are dropped
    assert rows["J1"].Amount == 20.0 and rows["J1"].INR_Amount == pytest.approx(20.0 * 0.57)
    assert rows["I1"].INR_Amount == 300.0
    assert rows["X1"].INR_Amount == 7.0  # no rate -> factor 1
    assert all(1900 <= r.Year <= 2000 for r in rows.values())


def test_convert_null_key_and_strict(spark):
    df = spark.createDataFrame([("Japan", 10.0), (None, 10.0), ("Mars", 10.0)], "Country string, Amount double")
    got = [r.INR_Amount for r in convert(df, CURRENCY_RATES).collect()]
    assert got == [pytest.approx(5.7), 10.0, 10.0]
    with pytest.raises(PySparkException, match="no rate for"):
        convert(df, CURRENCY_RATES, strict=True).collect()


def test_convert_with_rate_table(spark):
    df = spark.createDataFrame([("Japan", 10.0), ("Oman", 1.0), ("Mars", 2.0)], "Country string, Amount double")
    rates = spark.createDataFrame([("Japan", 0.57), ("Oman", 215.54), ("Oman", 215.54)], "Country string, rate double")
    got = {r.Country: r.INR_Amount for r in convert(df, rates).collect()}
    assert got == {"Japan": pytest.approx(5.7), "Oman": 215.54, "Mars": 2.0}
    bad = spark.createDataFrame([("Oman", 1.0), ("Oman", 2.0)], "Country string, rate double")
    with pytest.raises(PySparkException, match="conflicting rates"):
        convert(df, bad).collect()


def test_random_year_bounds_and_key_form(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    years = random_int(df, "Year", 1900, 2000, seed=1).agg(F.min("Year"), F.max("Year"), F.countDistinct("Year")).first()
    assert tuple(years) == (1900, 2000, 101)
    keyed = random_int(df, "Year", 1900, 2000, key=F.xxhash64("k"))
    assert keyed.collect() == random_int(df.repartition(7), "Year", 1900, 2000, key=F.xxhash64("k")).orderBy("k").collect()


def test_conform_rejects_fractional_qty(spark):
    ok = _feed(spark, [("A", "Shoes", "x", 2.0, 1.0)], "Japan")
    assert conform(transform_sales(ok, seed=1), FINAL_SCHEMA).first().Qty == 2
    bad = _feed(spark, [("A", "Shoes", "x", 2.5, 1.0)], "Japan")
    with pytest.raises(PySparkException, match="not whole"):
        final_sales(bad, seed=1).collect()
    with pytest.raises(ValueError, match="missing"):
        conform(ok.drop("Qty"), FINAL_SCHEMA)


def test_load_table_refuses_empty(spark, tmp_dir):
    empty = transform_sales(_feed(spark, [("A", "Shoes", "x", None, 1.0)], "Japan"), seed=1)
    with pytest.raises(ValueError, match="No data to load"):
        load_table(empty, path=tmp_dir + "/t", schema=FINAL_SCHEMA)


def test_sources_end_to_end(spark, tmp_dir):
    # CSV with pandas-style missing tokens and an extra column; JSON array of records.
    csv_path = tmp_dir + "/japan_feed.csv"
    with open(csv_path, "w") as f:
        f.write("SaleId,Category,Product,Qty,Sale\n")
        f.write("J1,Shoes,Run,2,10.5\nJ2,Jeans,Blue,NA,5\nJ3,Jeans,Blue,null,5\nJ4,Tshirts,Red,1,3\n")
    json_path = tmp_dir + "/srilanka_feed.json"
    with open(json_path, "w") as f:
        json.dump([{"SaleId": "S1", "Category": "Shoes", "Product": "P", "Qty": 4, "Sale": 2.5}], f, indent=2)
    specs = [
        SourceSpec("csv", csv_path, "Japan", options={"infer_schema": True, "missing_tokens": ["NA", "null"]}),
        SourceSpec("json", json_path, "SriLanka"),
    ]
    combined = load_sources(spark, specs)
    assert combined.count() == 5
    out_path = tmp_dir + "/final"
    run_sales_load(spark, specs, path=out_path, seed=3)
    final = spark.read.parquet(out_path)
    assert final.columns == FINAL_SCHEMA.fieldNames()
    got = {r.SaleId: r for r in final.collect()}
    assert set(got) == {"J1", "J4", "S1"}
    assert got["J1"].INR_Amount == pytest.approx(21.0 * 0.57)
    assert got["S1"].INR_Amount == pytest.approx(10.0 * 0.25)


def test_extra_column_drops_rows_of_other_feeds(spark):
    # Union by name fills the extra column with null for the other feed, and the
    # whole-row missing-value drop then removes those rows, as the original job does.
    a = tag(spark.createDataFrame([("A1", "Shoes", "x", 1.0, 2.0, "e")], FEED + ", Extra string"), "Country", "Japan")
    b = _feed(spark, [("B1", "Shoes", "y", 1.0, 2.0)], "India")
    assert [r.SaleId for r in transform_sales(union_all([a, b]), seed=1).collect()] == ["A1"]


def test_registry_errors(spark, tmp_dir):
    with pytest.raises(ValueError, match="Unsupported source kind"):
        load_sources(spark, [SourceSpec("parquetish", tmp_dir)])
    with pytest.raises(ValueError):
        load_sources(spark, [])
    empty_csv = tmp_dir + "/empty.csv"
    with open(empty_csv, "w") as f:
        f.write("SaleId,Category,Product,Qty,Sale\n")
    with pytest.raises(ValueError, match="empty"):
        run_sales_load(spark, [SourceSpec("csv", empty_csv, "Japan")], path=tmp_dir + "/out")


def test_share_rounding(spark):
    df = spark.createDataFrame([("a",)] * 1 + [("b",)] * 2 + [("c",)] * 5, "k string")
    got = {r.k: (r.n, r.pct) for r in share(df, "k").collect()}
    # 12.5 rounds half up to 12.5; 25.0; 62.5
    assert got == {"a": (1, 12.5), "b": (2, 25.0), "c": (5, 62.5)}
    got2 = {r.k: r.pct for r in share(df, "k", digits=0).collect()}
    assert got2 == {"a": 13.0, "b": 25.0, "c": 63.0}


def test_csv_missing_tokens_read(spark, tmp_dir):
    path = tmp_dir + "/t.csv"
    with open(path, "w") as f:
        f.write("a,b\nNA,1\nnull,2\nx,3\n")
    df = read_csv(spark, path, missing_tokens=["NA", "null"])
    assert [r.a for r in df.orderBy("b").collect()] == [None, None, "x"]


def test_load_table_by_name(spark):
    feed = _feed(spark, [("A", "Shoes", "x", 2.0, 1.5), ("B", "Jeans", "y", 1.0, 4.0)], "Japan")
    load_table(transform_sales(feed, seed=1), table="final_sales_test", schema=FINAL_SCHEMA)
    stored = spark.table("final_sales_test")
    assert stored.columns == FINAL_SCHEMA.fieldNames() and stored.count() == 2
    # replacing the table with a frame that reads it is refused before anything is deleted
    with pytest.raises(Exception):
        load_table(stored.filter("Qty > 1"), table="final_sales_test", schema=FINAL_SCHEMA)
    assert spark.table("final_sales_test").count() == 2


def test_csv_feed_pandas_missing_tokens_by_default(spark, tmp_dir):
    path = tmp_dir + "/Feed.csv"
    with open(path, "w") as f:
        f.write("SaleId,Category,Product,Qty,Sale\nA,Shoes,x,NaN,1\nB,Shoes,y,N/A,1\nC,Shoes,z,3,2\nD,Shoes,w,#N/A,1\n")
    combined = load_sources(spark, [SourceSpec("csv", path, "Japan")])
    assert combined.filter("Qty IS NULL").count() == 3
    assert [r.SaleId for r in transform_sales(combined, seed=1).collect()] == ["C"]
