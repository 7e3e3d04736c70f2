"""Damaged records are kept apart, counted and put on record."""

import json
import os

import pytest

from tabsmith.plans.sales import FEED_SCHEMA, run_sales_load
from tabsmith.sources import REJECTED, SourceSpec, load_sources, read_csv, read_json, split_rejected, stage_sources


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_json_lines(spark, tmp_dir):
    path = put(f"{tmp_dir}/j/a.json", '{"id": 1, "v": 2}\n{"id": 2, "v"\n{"id": 3, "v": "x"}\n{"id": 4}\n')
    df = read_json(spark, path, schema="id int, v int", multi_line=False, rejects=True)
    assert [(r["id"], r["v"], r[REJECTED]) for r in df.collect()] == [(1, 2, None), (None, None, '{"id": 2, "v"'), (3, None, '{"id": 3, "v": "x"}'), (4, None, None)]
    inferred = read_json(spark, put(f"{tmp_dir}/j2/a.json", '{"id": 1}\n'), multi_line=False, rejects=True)
    assert [(r["id"], r[REJECTED]) for r in inferred.collect()] == [(1, None)]


@pytest.mark.parametrize("schema", [None, "id int, v int"])
def test_csv_lines(spark, tmp_dir, schema):
    path = put(f"{tmp_dir}/c/a.csv", "id,v\n1,2\n3\n4,5,6\n7,\n")
    put(f"{tmp_dir}/c/b.csv", "v,id\n2,x\n")
    df = read_csv(spark, os.path.dirname(path), schema=schema, rejects=True)
    rows = {r[REJECTED]: r for r in df.collect() if r[REJECTED] is not None}
    assert set(rows) == {"3", "4,5,6"} | ({"2,x"} if schema else set())
    assert sorted(str(r["id"]) for r in df.collect() if r[REJECTED] is None) == ["1", "7"] + ([] if schema else ["x"])
    assert read_csv(spark, path, schema="id int, v int").columns == ["id", "v"]


def test_feeds_with_cells_of_another_type(spark, tmp_dir):
    put(f"{tmp_dir}/f/a.csv", "SaleId,Category,Product,Qty,Sale\nA,s,p,2,1.5\nB,s,p,two,1.5\nC,s,p,NA,1\nD,s,p\n")
    path = put(f"{tmp_dir}/g.json", json.dumps([{"SaleId": "E", "Category": "s", "Product": "p", "Qty": 1, "Sale": 2}, {"SaleId": "F", "Category": "s", "Product": "p", "Qty": "?", "Sale": 2}]))
    specs = [SourceSpec("csv", f"{tmp_dir}/f", "Japan"), SourceSpec("json", path, "Oman")]
    rows, rejected = stage_sources(spark, specs, schema=FEED_SCHEMA, rejects_path=f"{tmp_dir}/rejects")
    assert sorted(r["SaleId"] for r in rows.collect()) == ["A", "C", "E"] and "_feed" not in rows.columns
    assert sorted((r["_feed"].rsplit("/", 1)[1], r[REJECTED]) for r in spark.read.parquet(f"{tmp_dir}/rejects").collect()) == [("f", "D,s,p"), ("f", "Qty=two"), ("g.json", "Qty=?")]
    assert rejected.count() == 3


def test_too_many_rejects_stop_a_load_and_leave_the_table(spark, tmp_dir):
    put(f"{tmp_dir}/f/a.csv", "SaleId,Category,Product,Qty,Sale\nA,s,p,2,1.5\nB,s,p,two,1.5\n")
    specs = [SourceSpec("csv", f"{tmp_dir}/f", "Japan")]
    run_sales_load(spark, specs, path=f"{tmp_dir}/t", seed=1, max_rejects=1)
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 1
    put(f"{tmp_dir}/f/b.csv", "SaleId,Category,Product,Qty,Sale\nC,s,p,x,1.5\n")
    with pytest.raises(ValueError, match="2 of 3 records were rejected"):
        run_sales_load(spark, specs, path=f"{tmp_dir}/t", seed=1, max_rejects=1, rejects_path=f"{tmp_dir}/r")
    assert spark.read.parquet(f"{tmp_dir}/t").count() == 1 and spark.read.parquet(f"{tmp_dir}/r").count() == 2


def test_nothing_is_lost(spark, tmp_dir):
    lines = [json.dumps({"id": k, "v": k * k})[: 8 if k % 7 == 3 else None] for k in range(100)]
    put(f"{tmp_dir}/n/a.json", "\n".join(lines) + "\n")
    spec = SourceSpec("json", f"{tmp_dir}/n", options={"schema": "id int, v int", "multi_line": False})
    df = load_sources(spark, [spec], rejects=True)
    good, bad = split_rejected(df.cache())
    assert good.count() + bad.count() == 100 and bad.count() == sum(k % 7 == 3 for k in range(100))
    df.unpersist()
