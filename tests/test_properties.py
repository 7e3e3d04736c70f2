"""Property tests: idempotence, counts, histogram rule vs numpy."""

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsmith.operators import bin_index, dedupe, tag, union_all
from tabsmith.session import checkpoint_root, scratch_path
from tabsmith.sinks import preview, write_csv


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from(["a", "b", None])), min_size=0, max_size=30))
def test_dedupe_idempotent(spark, rows):
    df = spark.createDataFrame(rows, "k int, v string")
    once = dedupe(df)
    key = lambda r: (r.k, r.v or "")
    assert sorted(once.collect(), key=key) == sorted(dedupe(once).collect(), key=key)
    assert once.count() == len(set(rows))


def test_union_count_is_sum(spark):
    a = tag(spark.range(7).withColumnRenamed("id", "k"), "src", "a")
    b = spark.range(5).withColumnRenamed("id", "k").withColumn("extra", F.lit(1))
    u = union_all([a, b])
    assert u.count() == 12
    assert set(u.columns) == {"k", "src", "extra"}
    assert u.filter("extra IS NULL").count() == 7


finite = st.floats(min_value=-1e3, max_value=1e3, allow_nan=False, allow_infinity=False)


@settings(max_examples=10, deadline=None)
@given(st.lists(finite, min_size=1, max_size=60), st.integers(1, 12))
def test_bin_index_matches_numpy(spark, values, bins):
    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    lo, hi = min(values), max(values)
    got = [
        r.b
        for r in df.select(bin_index(F.col("x"), F.lit(float(lo)), F.lit(float(hi)), bins).alias("b")).collect()
    ]
    if lo == hi:
        assert set(got) == {0}
        return
    counts, _ = np.histogram(np.array(values, dtype=float), bins=bins)
    assert np.bincount(got, minlength=bins).tolist() == counts.tolist()


def test_overwriting_the_source_folder_is_refused(spark, tmp_dir):
    path = os.path.join(tmp_dir, "data")
    spark.range(3).write.option("header", "true").csv(path)
    df = spark.read.option("header", "true").csv(path)
    with pytest.raises(ValueError, match="refusing to overwrite"):
        write_csv(df, path)
    with pytest.raises(ValueError, match="refusing to overwrite"):
        write_csv(df, "file://" + path + "/")
    assert spark.read.option("header", "true").csv(path).count() == 3


def test_preview_and_scratch(spark):
    assert preview(spark.range(100), 5).count() == 5
    root = checkpoint_root(spark)
    assert root and scratch_path(spark, "x").startswith(root)
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


@settings(max_examples=6, deadline=None)
@given(
    st.lists(st.one_of(st.none(), st.floats(0.5, 500.0, allow_nan=False)), min_size=1, max_size=60),
    st.integers(1, 9),
    st.integers(1, 6),
    st.sampled_from(["day", "week", "month"]),
)
def test_sequence_views_match_pandas(spark, closes, block, n, unit):
    import datetime as dt

    import pandas as pd

    from tabsmith.operators import sequence_views

    rows = [("P", dt.date(2021, 1, 1) + dt.timedelta(days=3 * i), c) for i, c in enumerate(closes)]
    df = spark.createDataFrame(rows, "symbol string, dt date, close double")
    got = sequence_views(df, ret="ret", windows=[n], lead="nxt", unit=unit, block=block).orderBy("dt").toPandas()
    s = pd.Series(closes, dtype=float)
    np.testing.assert_allclose(got["ret"].astype(float), s / s.shift(1) - 1, rtol=1e-12, equal_nan=True)
    np.testing.assert_allclose(got[f"ma{n}"].astype(float), s.rolling(n).mean(), rtol=1e-9, equal_nan=True)
    np.testing.assert_allclose(got["nxt"].astype(float), s.shift(-1), rtol=0, equal_nan=True)
