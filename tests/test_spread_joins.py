"""Only keys with many rows are salted, and the small table stays small."""

import pytest
from pyspark.sql import functions as F

from tabsmith.operators import _joins
from tabsmith.operators._joins import join_back_spread
from tabsmith.operators.stats import histogram, kde, predict_next_close


@pytest.fixture()
def many(spark):
    """10,000 symbols with a row or two, one with 30,000, and one without a name."""
    small = spark.range(10_000).select(F.concat(F.lit("S"), "id").alias("symbol"), F.col("id").cast("double").alias("v"))
    hot = spark.range(30_000).select(F.lit("HOT").alias("symbol"), F.col("id").cast("double").alias("v"))
    none = spark.range(5_000).select(F.lit(None).cast("string").alias("symbol"), F.col("id").cast("double").alias("v"))
    return small.unionByName(hot).unionByName(none)


def _repeated(df):
    """Rows of the small table after it is repeated: what its Generate makes."""
    plan = df._jdf.queryExecution().optimizedPlan()
    nodes, found = [plan], []
    while nodes:
        node = nodes.pop()
        if node.nodeName() == "Generate":
            found.append(node)
        nodes += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_the_small_table_grows_by_rows_over_target(spark, many):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8192")
    try:
        counts = many.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo")).coalesce(4)
        joined = join_back_spread(many, counts, "symbol", ["v"], "n", target=1000)
        assert len(_repeated(joined)) == 1
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        parts = F.greatest(F.ceil(F.col("n") / 1000), F.lit(1)).cast("int")
        assert counts.agg(F.sum(parts)).first()[0] == 10_000 + 30 + 5  # below 100,000, whatever the partitions
        assert joined.count() == 45_000
        assert joined.filter("symbol IS NULL AND lo = 0 AND n = 5000").count() == 5_000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_hot_keys_are_spread_and_others_are_not(spark, many, monkeypatch):
    counts = many.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    seen = []
    plain = _joins.join_back

    def spy(rows, small, keys, how="inner"):
        seen.append((rows, small))
        return plain(rows, small, keys, how)

    monkeypatch.setattr(_joins, "join_back", spy)
    join_back_spread(many, counts, "symbol", ["v"], "n", target=1000).count()
    rows, small = seen[-1]
    per = {r["symbol"]: r["parts"] for r in rows.groupBy("symbol").agg(F.countDistinct("__part").alias("parts")).collect()}
    assert per["HOT"] == 30 and per[None] == 5 and {v for k, v in per.items() if k not in ("HOT", None)} == {1}
    assert rows.groupBy("symbol", "__part").count().agg(F.max("count")).first()[0] < 2000
    assert small.count() == 10_000 + 35


def test_hot_keys_are_bounded(spark, many, monkeypatch):
    monkeypatch.setattr(_joins, "MAX_SPREAD_KEYS", 3)
    counts = many.groupBy("symbol").agg(F.count(F.lit(1)).alias("n"))
    assert join_back_spread(many, counts, "symbol", ["v"], "n", target=1).count() == 45_000


def test_users_give_the_same_with_and_without_spreading(spark, monkeypatch):
    import datetime as dt

    rows = [(s, dt.date(2020, 1, 1) + dt.timedelta(days=k), float(100 + k * 7 % 13)) for s in ("A", None, "C") for k in range(200)]
    bars = spark.createDataFrame(rows, "symbol string, dt date, close double")
    rets = bars.withColumnRenamed("close", "ret")

    def results():
        return [sorted(map(tuple, f(rets).collect()), key=str) for f in (lambda d: histogram(d, "ret", 5), lambda d: kde(d, "ret", 4).select("symbol", "i", F.round("density", 9)))] + [
            sorted(map(tuple, predict_next_close(bars).select("symbol", "dt", F.round("predicted", 6)).collect()), key=str)
        ]

    whole = results()
    monkeypatch.setattr(join_back_spread, "__defaults__", (7,))
    assert results() == whole
