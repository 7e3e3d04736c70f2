"""Derived columns: constant tags, amounts, currency conversion, a random or
key-derived integer, union by name and share of total.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """Constant column; replaces a column of the same name."""
    return df.withColumn(name, F.lit(value))


def amount(df: DataFrame, qty: str = "Qty", price: str = "Sale", out: str = "Amount") -> DataFrame:
    """``qty * price`` as double."""
    return df.withColumn(out, F.col(qty).cast("double") * F.col(price).cast("double"))


def _rate_literal(rates: Mapping[str, float]) -> Column:
    pairs = []
    for key, rate in rates.items():
        pairs += [F.lit(key), F.lit(float(rate))]
    return F.create_map(*pairs)


def convert(
    df: DataFrame,
    rates: Mapping[str, float] | DataFrame,
    amount_col: str = "Amount",
    key: str = "Country",
    out: str = "INR_Amount",
    default: float = 1.0,
    strict: bool = False,
    rate_key: str | None = None,
    rate_col: str = "rate",
) -> DataFrame:
    """``amount * rate[key]``; a key with no rate (or a null key) uses ``default``.

    ``rates`` is either a dict, which becomes a map literal folded into the
    projection (no join, no shuffle), or a DataFrame ``(rate_key, rate_col)``,
    which is left-joined. A rate table may repeat a key with the same rate;
    two different rates for one key raise at run time. With ``strict=True`` a
    row without a rate raises instead of using ``default``.
    """
    if isinstance(rates, DataFrame):
        rate_key = rate_key or key
        one_rate = rates.groupBy(F.col(rate_key).alias("__rate_key")).agg(
            F.when(
                F.min(rate_col) != F.max(rate_col),
                F.raise_error(F.concat(F.lit("conflicting rates for "), F.col("__rate_key").cast("string"))),
            )
            .otherwise(F.first(rate_col))
            .cast("double")
            .alias("__rate")
        )
        # Left join: rows never multiply (one rate per key). AQE broadcasts the
        # rate side at run time when its measured size is under the threshold.
        joined = df.join(one_rate, F.col(key) == F.col("__rate_key"), "left")
        rate = F.col("__rate")
    else:
        joined = df
        rate = F.try_element_at(_rate_literal(rates), F.col(key))
    if strict:
        rate = F.when(
            rate.isNull(), F.raise_error(F.concat(F.lit("no rate for "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
        ).otherwise(rate)
    result = joined.withColumn(out, F.col(amount_col) * F.coalesce(rate, F.lit(float(default))))
    if isinstance(rates, DataFrame):
        result = result.drop("__rate_key", "__rate")
    return result


def random_int(
    df: DataFrame,
    name: str,
    lo: int,
    hi: int,
    seed: int | None = None,
    key: Column | str | None = None,
) -> DataFrame:
    """Integer column in ``lo..hi`` inclusive.

    With ``key`` (an integer column, ideally well spread such as
    ``xxhash64(id)``) the value is ``lo + pmod(key, span)``: it does not depend
    on partitioning or retries, so it is repeatable and checkable. Without a
    key it is ``rand(seed)``-based, which is only repeatable for the same input
    partitioning.
    """
    if hi < lo:
        raise ValueError("hi must be >= lo")
    span = hi - lo + 1
    if key is not None:
        k = F.col(key) if isinstance(key, str) else key
        value = F.pmod(k.cast("long"), F.lit(span)) + F.lit(lo)
    else:
        value = F.floor(F.rand(seed) * span) + F.lit(lo)
    return df.withColumn(name, value.cast("long"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union matched by column name; a column absent from a frame is null."""
    if not frames:
        raise ValueError("no frames to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def share(df: DataFrame, by: str | Sequence[str], out: str = "pct", count_col: str = "n", digits: int = 1) -> DataFrame:
    """Row count per group and its share of all rows in percent.

    The total is a scalar subquery over the per-group counts (no join and no
    single-partition window). Rounding is half-up on the exact ratio, done in
    integer/decimal arithmetic so it does not depend on binary floating point.
    """
    keys = [by] if isinstance(by, str) else list(by)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    total = counts.select(F.sum(count_col)).scalar()
    scale = 10**digits
    n = F.col(count_col)
    numerator = (n * (200 * scale) + total).cast("decimal(38,0)")
    denominator = (total * 2).cast("decimal(38,0)")
    pct = F.floor(numerator / denominator).cast("double") / F.lit(float(scale))
    return counts.withColumn(out, pct)
