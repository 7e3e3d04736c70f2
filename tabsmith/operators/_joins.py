"""Joins of rows to small derived tables that keep every row."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.session import materialize


def join_back(rows: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on null-safe equality of ``keys``: rows with a null key meet the
    small table's row of that null key instead of vanishing."""
    renamed = small.select([F.col(c).alias(f"__key_{c}") if c in keys else F.col(c) for c in small.columns])
    match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__key_{k}")) for k in keys])
    return rows.join(renamed, match, how).drop(*[f"__key_{k}" for k in keys])


#: Rows of one key that a task may get; a key with more is spread over several.
SPREAD_ROWS = 1_000_000
#: Keys with more rows than that, at most: with more rows in all, a part holds more.
MAX_SPREAD_KEYS = 100_000


def to_all(small: DataFrame) -> DataFrame:
    """``small``, of a size that its caller has checked or bounded, to be sent to
    every task; a session that switches broadcasts off joins it by a shuffle."""
    off = small.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
    return small if off else F.broadcast(small)


def join_back_spread(rows: DataFrame, small: DataFrame, by: str, spread_on: Sequence[str], count: str, target: int = SPREAD_ROWS) -> DataFrame:
    """The same for one key that may hold a large share of the rows.

    ``small`` has one row per key, and in ``count`` the number of its rows. A key
    with more than ``target`` is spread by a hash of ``spread_on`` over as many
    parts as keep within it, and its row is repeated for each; all others have
    one part. So ``small`` grows by no more than rows / ``target``. The hot keys'
    numbers of parts go to every task; there cannot be more than
    ``MAX_SPREAD_KEYS`` of them, since ``target`` is raised with the number of
    rows. A join that is not broadcast then never sends a whole hot key to one task.
    """
    small = materialize(small)
    total = small.agg(F.sum(count)).first()[0] or 0
    target = max(target, -(-total // MAX_SPREAD_KEYS))
    parts = F.greatest(F.ceil(F.col(count) / target), F.lit(1)).cast("int")
    hot = small.filter(F.col(count) > target).select(F.col(by).alias("__part_key"), parts.alias("__parts"))
    known = rows.join(to_all(hot), F.col(by).eqNullSafe(F.col("__part_key")), "left")
    salted = known.withColumn("__part", F.coalesce(F.pmod(F.xxhash64(*spread_on), F.col("__parts")), F.lit(0)).cast("int")).drop("__part_key", "__parts")
    repeated = small.withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1)))
    return join_back(salted, repeated, [by, "__part"]).drop("__part")
