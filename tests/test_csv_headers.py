"""CSV columns are matched by name, file by file."""

import os

import pytest

from tabsmith.plans.bank import run_cleaning
from tabsmith.sources import SourceSpec, load_sources, read_csv


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


@pytest.fixture()
def mixed(tmp_dir):
    root = f"{tmp_dir}/feeds"
    put(f"{root}/a.csv", "id,amount\n1,10\n")
    put(f"{root}/deep/er/b b%20.csv", "amount,id\n20,2\n")
    put(f"{root}/deep/c.csv", '\n"amount","extra, one","ID"\n30,x,3\n')
    put(f"{root}/d.csv", "id\n4\n")
    return root


def rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


@pytest.mark.parametrize("schema", [None, "id string, amount string"])
def test_columns_follow_the_header_of_their_file(spark, mixed, schema):
    df = read_csv(spark, mixed, schema=schema, recursive=True)
    assert sorted(((r["id"], r["amount"]) for r in df.collect()), key=str) == [("1", "10"), ("2", "20"), ("3", "30"), ("4", None)]
    assert df.columns[:2] == ["id", "amount"] or schema is None
    assert schema is None or len(df.columns) == 2


def test_types_come_from_the_schema_or_from_inference(spark, mixed):
    typed = read_csv(spark, mixed, schema="amount double, id int, other date", recursive=True)
    assert dict(typed.dtypes) == {"amount": "double", "id": "int", "other": "date"}
    assert sorted((r["id"], r["amount"], r["other"]) for r in typed.collect())[:3] == [(1, 10.0, None), (2, 20.0, None), (3, 30.0, None)]
    inferred = read_csv(spark, mixed, infer_schema=True, recursive=True)
    assert dict(inferred.dtypes)["id"] == "int" and inferred.filter("id = 2 and amount = 20").count() == 1


def test_one_scan_where_all_headers_agree(spark, tmp_dir):
    for k in range(5):
        put(f"{tmp_dir}/same/{k}.csv", f"id,amount\n{k},1\n")
    df = read_csv(spark, f"{tmp_dir}/same", schema="id int, amount int")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan and df.count() == 5
    turned = read_csv(spark, f"{tmp_dir}/same", schema="amount int, id int")
    assert rows(turned, "id", "amount") == [(k, 1) for k in range(5)]
    assert turned._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    renamed = read_csv(spark, f"{tmp_dir}/same", schema="x int, y int")
    assert rows(renamed, "x", "y") == [(k, 1) for k in range(5)]


def test_only_the_files_of_a_header_are_listed_for_its_scan(spark, mixed):
    df = read_csv(spark, mixed, recursive=True)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan csv") == 4
    assert df.select("id").count() == 4


def test_folder_columns_stay(spark, tmp_dir):
    put(f"{tmp_dir}/by/Country=Sri Lanka/a.csv", "id,v\n1,2\n")
    put(f"{tmp_dir}/by/Country=Oman/b.csv", "v,id\n4,3\n")
    df = read_csv(spark, f"{tmp_dir}/by", schema="id int, v int")
    assert rows(df, "Country", "id", "v") == [("Oman", 3, 4), ("Sri Lanka", 1, 2)]


def test_bad_headers_and_empty_files(spark, tmp_dir):
    put(f"{tmp_dir}/twice/a.csv", "id,id\n1,2\n")
    put(f"{tmp_dir}/twice/b.csv", "id\n1\n")
    with pytest.raises(ValueError, match="repeated"):
        read_csv(spark, f"{tmp_dir}/twice")
    put(f"{tmp_dir}/none/a.csv", "")
    assert read_csv(spark, f"{tmp_dir}/none", schema="id int").collect() == []


def test_the_jobs_read_feeds_of_other_order(spark, tmp_dir):
    head = ["Transaction_ID", "Transaction_Date", "Transaction_Amount", "Fee_Charged", "Branch_Code", "Transaction_Status"]
    values = dict(zip(head, ["T1", "2024-01-02", "5", "1", "B 1", "Failed"], strict=True))
    put(f"{tmp_dir}/raw/one/a.csv", ",".join(head) + "\n" + ",".join(values[h] for h in head) + "\n")
    turned = head[::-1]
    put(f"{tmp_dir}/raw/b.csv", ",".join(turned) + "\n" + ",".join({**values, "Transaction_ID": "T2"}[h] for h in turned) + "\n")
    cleaned = run_cleaning(spark, f"{tmp_dir}/raw", f"{tmp_dir}/cleaned")
    assert rows(cleaned, "Transaction_ID", "Transaction_Amount", "Branch_Code", "Transaction_Status") == [("T1", 5.0, "B1", "Failed"), ("T2", 5.0, "B1", "Failed")]
    put(f"{tmp_dir}/feed/x.csv", "SaleId,Qty\nA,1\n")
    put(f"{tmp_dir}/feed/y.csv", "Qty,SaleId\nNA,B\n")
    feed = load_sources(spark, [SourceSpec("csv", f"{tmp_dir}/feed", "Oman")])
    assert sorted(((r["SaleId"], r["Qty"]) for r in feed.collect())) == [("A", "1"), ("B", None)]
