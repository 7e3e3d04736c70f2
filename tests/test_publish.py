"""A table at a path is written once and put in place whole."""

import os

import pytest
from pyspark.sql import functions as F

from tabsmith import sinks
from tabsmith.sinks import load_table


def files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_written_once(spark, tmp_dir, monkeypatch):
    path = f"{tmp_dir}/table"
    written = []
    plain = sinks._publish
    monkeypatch.setattr(sinks, "_publish", lambda s, staging, target: (written.extend((f, os.stat(f).st_ino) for f in files(staging)), plain(s, staging, target)))
    load_table(spark.range(100), path=path)
    assert sorted(i for _, i in written) == sorted(os.stat(f).st_ino for f in files(path))  # the very files, moved
    assert os.listdir(tmp_dir) == ["table"]
    assert spark.read.parquet(tmp_dir + "/table").count() == 100


def test_replaced_in_format_and_folders(spark, tmp_dir):
    path = f"{tmp_dir}/table"
    load_table(spark.range(5), path=path)
    df = spark.range(10).withColumn("k", F.col("id") % 3)
    load_table(df, path=path, fmt="json", partition_by=["k"])
    assert sorted(d for d in os.listdir(path) if d.startswith("k=")) == ["k=0", "k=1", "k=2"]
    assert spark.read.json(path).count() == 10


def test_a_failed_load_leaves_the_table(spark, tmp_dir):
    path = f"{tmp_dir}/table"
    load_table(spark.range(5), path=path)
    bad = spark.range(10).select(F.when(F.col("id") == 7, F.raise_error(F.lit("broken"))).otherwise(F.col("id")).cast("long").alias("id"))
    for frame in (bad, spark.range(0)):
        with pytest.raises(Exception):  # noqa: B017
            load_table(frame, path=path)
        assert spark.read.parquet(path).count() == 5 and os.listdir(tmp_dir) == ["table"]


@pytest.mark.parametrize("new_in_place", [True, False])
def test_a_lost_driver_is_made_good(spark, tmp_dir, new_in_place):
    path = f"{tmp_dir}/table"
    load_table(spark.range(5), path=path)
    os.rename(path, f"{tmp_dir}/_table.previous")  # between the two renames
    if new_in_place:
        spark.range(6).write.parquet(path)
    sinks._recover(spark, path)
    assert spark.read.parquet(path).count() == (6 if new_in_place else 5)
    assert os.listdir(tmp_dir) == ["table"]


def test_the_old_table_comes_back_if_the_new_cannot_be_moved(spark, tmp_dir):
    path = f"{tmp_dir}/table"
    load_table(spark.range(5), path=path)
    with pytest.raises(Exception):  # noqa: B017
        sinks._publish(spark, f"{tmp_dir}/nothing-here", path)
    sinks._recover(spark, path)
    assert spark.read.parquet(path).count() == 5


def test_other_modes_and_catalog_tables(spark, tmp_dir):
    path = f"{tmp_dir}/table"
    load_table(spark.range(5), path=path)
    load_table(spark.range(3), path=path, mode="append")
    assert spark.read.parquet(path).count() == 8
    load_table(spark.range(4), table="published_once")
    load_table(spark.range(2), table="published_once")
    assert spark.table("published_once").count() == 2
    spark.sql("DROP TABLE published_once")
