"""Inputs shaped like the reference's data, derived from the supplied tables.

The supplied tables carry no bank transactions, sales feeds or price bars,
so each is derived here, in one place, from the TPC-H-style tables. Every
derivation is a projection or an aggregate over the whole table, so the work
grows with the data.

Dirt for the cleaning jobs is made deterministically from the row key
(every 7th date written in another format, every 5th amount missing, ...),
because the supplied columns have no nulls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Conversion factors per region used by the driver queries
# (two regions deliberately have none and fall back to factor 1).
REGION_RATES = {"AMERICA": 0.57, "ASIA": 8.21, "EUROPE": 89.34}


def transactions_from_orders(orders: DataFrame) -> DataFrame:
    """Raw, text-typed bank transactions, one per order."""
    key = F.col("o_orderkey")
    good_date = F.date_format("o_orderdate", "yyyy-MM-dd")
    return orders.select(
        key.alias("Transaction_ID"),
        F.col("o_custkey").alias("Account_ID"),
        F.when(key % 7 == 0, F.date_format("o_orderdate", "dd/MM/yyyy")).otherwise(good_date).alias("Transaction_Date"),
        F.when(key % 5 == 0, F.lit(None).cast("string")).otherwise(F.col("o_totalprice").cast("string")).alias("Transaction_Amount"),
        F.when(key % 11 == 0, F.lit("abc")).otherwise((F.col("o_totalprice") / 1000).cast("string")).alias("Fee_Charged"),
        F.when(key % 3 == 0, F.concat(F.lit(" \t"), F.col("o_orderpriority"), F.lit(" "))).otherwise(F.col("o_orderpriority")).alias("Branch_Code"),
        F.when(F.col("o_orderstatus") == "F", F.when(key % 13 == 0, F.lit("failed")).otherwise(F.lit("Failed")))
        .when(F.col("o_orderstatus") == "P", F.lit("Declined"))
        .otherwise(F.lit("Success"))
        .alias("Transaction_Status"),
    )


def orders_with_gaps(orders: DataFrame) -> DataFrame:
    """Orders with the total price missing for every 5th key."""
    key = F.col("o_orderkey")
    return orders.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(key % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )


def bars_from_orders(orders: DataFrame) -> DataFrame:
    """Daily bars: symbol = order priority, one bar per symbol and day.

    open/close = total price of the day's first/last order (lowest/highest
    key), high/low = max/min, volume = number of orders. A hash aggregate
    with a map-side partial step, so its shuffle carries at most one row
    per (symbol, day) and task.
    """
    return orders.groupBy(
        F.col("o_orderpriority").alias("symbol"),
        F.to_date("o_orderdate").alias("dt"),
    ).agg(
        F.min_by("o_totalprice", "o_orderkey").alias("open"),
        F.max("o_totalprice").alias("high"),
        F.min("o_totalprice").alias("low"),
        F.max_by("o_totalprice", "o_orderkey").alias("close"),
        F.count(F.lit(1)).alias("volume"),
    )


def sales_from_lineitem(lineitem: DataFrame, part: DataFrame, supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """One sales feed row per line item: the part gives category, product and
    unit price, the supplier's region is the country. Quantity is missing on
    every 4th line number, as in the feeds with gaps.

    The joins form a left-deep chain over base tables, so each join decision
    rests on the scanned table's own size statistics: a small dimension is
    broadcast, a large one (part, supplier at scale) is a shuffle join. A
    pre-joined dimension would carry an inflated size estimate and force a
    shuffle of the line items even when it is tiny.
    """
    return (
        lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
        .join(part.select("p_partkey", "p_type", "p_name", "p_retailprice"), F.col("l_partkey") == F.col("p_partkey"))
        .join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region.select("r_regionkey", F.col("r_name").alias("Country")), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("SaleId"),
            F.col("p_type").alias("Category"),
            F.col("p_name").alias("Product"),
            F.when(F.col("l_linenumber") % 4 == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("Qty"),
            F.col("p_retailprice").alias("Sale"),
            "Country",
            (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("sale_key"),
        )
    )
