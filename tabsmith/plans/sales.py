"""Global sales: many country feeds -> one table -> clean -> convert -> load."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tabsmith.operators.enrich import amount, convert, random_int
from tabsmith.operators.quality import drop_any
from tabsmith.sinks import conform, load_table
from tabsmith.sources.registry import SourceSpec, load_sources, stage_sources

# Conversion factor to INR per country, as the sales load uses
# them. A country not listed converts with factor 1.
CURRENCY_RATES = {
    "India": 1,
    "Japan": 0.57,
    "Norway": 8.21,
    "SriLanka": 0.25,
    "HongKong": 10.93,
    "Oman": 215.54,
    "Germany": 89.34,
    "Qatar": 22.87,
}

# The schema of the final sales table, in its column order.
FINAL_SCHEMA = StructType(
    [
        StructField("SaleId", StringType()),
        StructField("Category", StringType()),
        StructField("Product", StringType()),
        StructField("Qty", LongType()),
        StructField("Sale", DoubleType()),
        StructField("Amount", DoubleType()),
        StructField("INR_Amount", DoubleType()),
        StructField("Country", StringType()),
        StructField("Year", LongType()),
    ]
)

# The columns of a country feed and their common types.
FEED_SCHEMA = StructType(
    [
        StructField("SaleId", StringType()),
        StructField("Category", StringType()),
        StructField("Product", StringType()),
        StructField("Qty", DoubleType()),
        StructField("Sale", DoubleType()),
    ]
)

YEAR_LO, YEAR_HI = 1900, 2000


def transform_sales(
    combined: DataFrame,
    rates: Mapping[str, float] | DataFrame = CURRENCY_RATES,
    seed: int | None = None,
    year_key: Column | str | None = None,
) -> DataFrame:
    """Drop rows with any missing value, ``Amount = Qty * Sale``,
    ``INR_Amount = Amount * rate`` and a ``Year`` in 1900..2000.

    ``Year`` is random in the original job; pass ``seed`` for a seeded draw or
    ``year_key`` (an integer column) for a value derived from the row's key,
    which is repeatable under retries and re-partitioning.
    """
    df = drop_any(combined)
    df = amount(df, "Qty", "Sale", "Amount")
    df = convert(df, rates, amount_col="Amount", key="Country", out="INR_Amount")
    return random_int(df, "Year", YEAR_LO, YEAR_HI, seed=seed, key=year_key)


def final_sales(combined: DataFrame, **kwargs) -> DataFrame:
    """``transform_sales`` conformed to the final table schema."""
    return conform(transform_sales(combined, **kwargs), FINAL_SCHEMA)


def run_sales_load(
    spark: SparkSession,
    specs: Sequence[SourceSpec],
    table: str | None = None,
    path: str | None = None,
    rates: Mapping[str, float] | DataFrame = CURRENCY_RATES,
    seed: int | None = None,
    fmt: str = "parquet",
    rejects_path: str | None = None,
    max_rejects: int | None = None,
) -> DataFrame:
    """Read every feed, transform and replace the table, in one pass over the
    feeds; no rows at all raise and leave the old table in place.

    With ``rejects_path`` or ``max_rejects`` damaged records are kept apart, put
    on record and counted (``sources.stage_sources``); without, they are rows
    with missing values, which go."""
    if rejects_path is None and max_rejects is None:
        combined = load_sources(spark, specs, schema=FEED_SCHEMA)
    else:
        combined, _ = stage_sources(spark, specs, schema=FEED_SCHEMA, rejects_path=rejects_path, max_rejects=max_rejects)
    cleaned = transform_sales(combined, rates=rates, seed=seed)
    return load_table(cleaned, table=table, path=path, schema=FINAL_SCHEMA, fmt=fmt, empty_message="Dataframe is empty, no data to process")
