"""Driver queries that go through a sink and back: CSV, JSON and Parquet
round trips, the sales table load and the streaming failed extract.

Each writes whole tables under the shared checkpoint folder
(``spark.checkpoint.dir``), in a fresh sub-folder per run, and returns the
data read back, which must equal the source (the oracle is the source).
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tabsmith.plans.bank import clean_transactions, run_cleaning, run_failed_extract
from tabsmith.plans.bindings import REGION_RATES, transactions_from_orders
from tabsmith.plans.catalog import (
    _BARS,
    ORACLE_SQL,
    RANGE_END,
    RANGE_START,
    RANGE_SYMBOL,
    RETS_OF_BARS,
    SYMBOLS,
    TRAIN_OF_BARS,
    _bars,
    _sales_feed,
    histogram_sql,
    kde_sql,
    table,
)
from tabsmith.plans.stocks import stock_view
from tabsmith.plans.sales import FEED_SCHEMA, FINAL_SCHEMA, transform_sales
from tabsmith.session import scratch_path
from tabsmith.sinks import load_table, preview, write_csv, write_json_arrays
from tabsmith.sources.files import REJECTED, read_csv, read_json
from tabsmith.sources.registry import SourceSpec, load_sources, stage_sources
from tabsmith.streaming.bank import run_clean_stream, run_failed_stream


CSV_REGIONS = ["AFRICA", "AMERICA", "ASIA"]
ARRAY_RECORDS = 10_000


def written(df, name):
    """``df`` written once as Parquet and read back, for feeds that several
    files are made from."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _batches(df, column, values):
    """``df`` cut by the values of a column; the last batch holds every other
    value and null."""
    listed = F.coalesce(F.col(column).isin(list(values)), F.lit(False))
    return [*(df.filter(F.col(column) == v) for v in values), df.filter(~listed)]


def q_csv_round_trip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "csv-round-trip")
    write_csv(orders, path)
    return read_csv(spark, path, schema=orders.schema, by_name=False)


def q_csv_nested_read(spark, sf_dir):
    """Orders written as CSV at three folder depths, read back with one
    recursive scan (a ``**`` glob would miss a level)."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "csv-nested")
    for depth, part in enumerate(_batches(orders, "o_orderstatus", ["F", "O"])):
        write_csv(part, "/".join([root] + ["level"] * depth + [f"batch_{depth}"]))
    return read_csv(spark, root, schema=orders.schema, recursive=True)


def q_csv_mixed_headers(spark, sf_dir):
    """Orders written as CSV batches whose columns stand in other orders, read
    back with one schema: cells follow the header of their file."""
    orders = table(spark, sf_dir, "orders")
    root = scratch_path(spark, "csv-mixed")
    for k, part in enumerate(_batches(orders, "o_orderstatus", ["F", "O"])):
        turned = orders.columns[3 * k :] + orders.columns[: 3 * k]
        write_csv(part.select(turned), f"{root}/batch_{k}")
    return read_csv(spark, root, schema=orders.schema, recursive=True)


def q_damaged_feeds(spark, sf_dir):
    """Orders as JSON lines and CSV of which every 50th record is cut off: read
    as two feeds, with the damaged records kept apart and found again by the key
    that their text still shows."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    root = scratch_path(spark, "damaged")
    cut, even = F.col("o_orderkey") % 50 == 7, F.col("o_custkey") % 2 == 0
    record = F.to_json(F.struct(*orders.columns))
    line = F.concat_ws(",", *orders.columns)
    orders.filter(even).select(F.when(cut, F.substring_index(record, ",", 2)).otherwise(record).alias("value")).write.text(f"{root}/json")
    orders.filter(~even).select(F.when(cut, F.substring_index(line, ",", 2)).otherwise(line).alias("value")).write.text(f"{root}/csv")
    kinds = orders.schema
    specs = [SourceSpec("json", f"{root}/json", options={"schema": kinds, "multi_line": False}), SourceSpec("csv", f"{root}/csv", options={"schema": kinds, "header": False})]
    rows, _ = stage_sources(spark, specs, schema=kinds, rejects_path=f"{root}/rejects")
    found = spark.read.schema(f"_feed string, {REJECTED} string").parquet(f"{root}/rejects")
    key = F.regexp_extract(REJECTED, "([0-9]+)", 1).cast("long")
    lost = found.select(key.alias("o_orderkey"), F.lit(None).cast("double").alias("o_totalprice"), F.lit(True).alias("rejected"))
    return rows.select("o_orderkey", "o_totalprice", F.lit(False).alias("rejected")).unionByName(lost)


def q_preview_clean(spark, sf_dir):
    """Any five cleaned transactions (a look at the data, not a report)."""
    return preview(clean_transactions(transactions_from_orders(table(spark, sf_dir, "orders"))), 5)


def q_json_round_trip(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "json-round-trip")
    orders.write.mode("overwrite").json(path)
    return read_json(spark, path, schema=orders.schema, multi_line=False)


def q_conform_sink(spark, sf_dir):
    path = scratch_path(spark, "sales-table")
    cleaned = transform_sales(_sales_feed(spark, sf_dir), rates=REGION_RATES, year_key="sale_key")
    load_table(cleaned, path=path, schema=FINAL_SCHEMA)
    back = spark.read.parquet(path)
    return back.withColumn("INR_Amount", F.round("INR_Amount", 4)).withColumn("Amount", F.round("Amount", 4))


def q_sales_feeds_load(spark, sf_dir):
    """The sales load end to end through the source registry: the feeds are
    written as CSV (three regions) and line-delimited JSON (all others),
    each folder partitioned by ``Country``, then read back as two sources,
    unioned by name, cleaned, converted, conformed and loaded as a table."""
    feed = written(_sales_feed(spark, sf_dir), "sales-feed")
    root = scratch_path(spark, "sales-feeds")
    in_csv = F.coalesce(F.col("Country").isin(CSV_REGIONS), F.lit(False))
    feed.filter(in_csv).write.partitionBy("Country").option("header", "true").csv(f"{root}/csv")
    feed.filter(~in_csv).write.partitionBy("Country").json(f"{root}/json")
    file_schema = feed.drop("Country").schema
    specs = [
        SourceSpec("csv", f"{root}/csv", options={"schema": file_schema}),
        SourceSpec("json", f"{root}/json", options={"schema": file_schema, "multi_line": False}),
    ]
    return _loaded_sales(spark, load_sources(spark, specs), root)


def q_sales_feeds_untyped(spark, sf_dir):
    """The same load with no schema given for the files: CSV cells are text
    (quantities like ``14.0``), JSON quantities are whole numbers and keep the
    type that inference finds; the registry's feed schema reconciles them."""
    feed = written(_sales_feed(spark, sf_dir), "sales-feed")
    root = scratch_path(spark, "sales-untyped")
    in_csv = F.coalesce(F.col("Country").isin(CSV_REGIONS), F.lit(False))
    as_text = [F.col(c).cast("string").alias(c) for c in feed.columns]
    feed.filter(in_csv).select(as_text).write.option("header", "true").csv(f"{root}/csv")
    whole = F.col("Qty").cast("long")
    feed.filter(~in_csv).withColumn("Qty", F.when(whole == F.col("Qty"), whole)).write.json(f"{root}/json")
    specs = [SourceSpec("csv", f"{root}/csv"), SourceSpec("json", f"{root}/json", options={"multi_line": False})]
    kinds = StructType([*FEED_SCHEMA.fields, StructField("sale_key", LongType())])
    return _loaded_sales(spark, load_sources(spark, specs, schema=kinds), root)


def _loaded_sales(spark, combined, root):
    cleaned = transform_sales(combined, rates=REGION_RATES, year_key="sale_key")
    table_path = f"{root}/final_sales"
    load_table(cleaned, path=table_path, schema=FINAL_SCHEMA)
    back = spark.read.parquet(table_path)
    return back.withColumn("INR_Amount", F.round("INR_Amount", 4)).withColumn("Amount", F.round("Amount", 4))


def q_bank_jobs(spark, sf_dir):
    """Both bank jobs through files: raw transaction CSVs at three folder
    depths -> cleaning job (recursive read, cleaned CSV folder) -> failed
    extract job (failed CSV folder), read back."""
    raw = transactions_from_orders(table(spark, sf_dir, "orders"))
    root = scratch_path(spark, "bank")
    for depth, part in enumerate(_batches(raw, "Transaction_Status", ["Failed", "Success"])):
        write_csv(part, "/".join([f"{root}/raw"] + ["day"] * depth + [f"batch_{depth}"]))
    cleaned = run_cleaning(spark, f"{root}/raw", f"{root}/cleaned", schema=raw.schema)
    return run_failed_extract(spark, f"{root}/cleaned", f"{root}/failed", schema=cleaned.schema)


def _stock_view(name, **digits):
    """A query for one output of the stock views, rounded where it is a sum of doubles."""

    def query(spark, sf_dir):
        view = stock_view(name, _bars(spark, sf_dir), RANGE_SYMBOL, RANGE_START, RANGE_END, benchmark="2-high")
        return view.withColumns({c: F.round(c, n) for c, n in digits.items()}) if digits else view

    return query


def _all_symbols_view(name, **digits):
    """The same over all symbols and the whole range of dates at once."""

    def query(spark, sf_dir):
        view = stock_view(name, _bars(spark, sf_dir), SYMBOLS, None, None, benchmark=SYMBOLS[0], page_no=3)
        return view.withColumns({c: F.round(c, n) for c, n in digits.items()}) if digits else view

    return query


def q_json_array_round_trip(spark, sf_dir):
    """Orders as files that each hold one JSON array of at most
    ``ARRAY_RECORDS`` records, read back with multi-line parsing."""
    orders = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "json-array")
    write_json_arrays(orders, path, ARRAY_RECORDS)
    return read_json(spark, path, schema=orders.schema, multi_line=True)


def q_stream_failed(spark, sf_dir):
    cleaned = clean_transactions(transactions_from_orders(table(spark, sf_dir, "orders")))
    cleaned_dir = scratch_path(spark, "stream-in")
    write_csv(cleaned, cleaned_dir)
    out_dir = scratch_path(spark, "stream-out")
    run_failed_stream(spark, cleaned_dir, out_dir, scratch_path(spark, "stream-ckpt"), cleaned.schema).awaitTermination()
    return spark.read.parquet(out_dir)


def q_stream_cleaned(spark, sf_dir):
    """Raw transactions as a stream of CSV files in several batches, one of which
    comes twice: the streamed clean is the batch one."""
    raw = transactions_from_orders(table(spark, sf_dir, "orders"))
    root = scratch_path(spark, "stream-raw")
    batches = _batches(raw, "Transaction_Status", ["Failed", "Success"])
    for at, part in enumerate([*batches, batches[0]]):
        write_csv(part, "/".join([f"{root}/raw"] + ["day"] * at + [f"batch_{at}"]))
    out = f"{root}/cleaned"
    run_clean_stream(spark, f"{root}/raw", out, f"{root}/progress", raw.schema, max_files_per_trigger=4).awaitTermination()
    return spark.read.parquet(out)


_VIEW_QUERIES = {
    "stock_view_details": _stock_view("details"),
    "stock_view_details_pages": _stock_view("details_pages"),
    "stock_view_return_histogram": _stock_view("return_histogram", bin_lo=9, bin_hi=9),
    "stock_view_return_density": _stock_view("return_density", x=9, density=6),
    "stock_view_averages": _stock_view("averages", ma50=4, ma200=4),
    "stock_view_correlation": _stock_view("correlation", corr=6),
    "stock_view_prediction_fit": _stock_view("prediction_fit", slope=6, intercept=4, r2=6),
    "stock_view_prediction": _stock_view("prediction", predicted=4),
    "stock_view_price": _stock_view("price"),
}

_ALL_SYMBOLS_QUERIES = {
    "stock_views_all_details": _all_symbols_view("details"),
    "stock_views_all_return_histogram": _all_symbols_view("return_histogram", bin_lo=8, bin_hi=8),
    "stock_views_all_correlation": _all_symbols_view("correlation", corr=6),
    "stock_views_all_prediction_fit": _all_symbols_view("prediction_fit", slope=8, intercept=4, r2=8),
}

EXTRA_QUERIES = {
    "csv_round_trip": q_csv_round_trip,
    "csv_nested_read": q_csv_nested_read,
    "csv_mixed_headers": q_csv_mixed_headers,
    "damaged_feeds": q_damaged_feeds,
    "preview_clean": q_preview_clean,
    "json_round_trip": q_json_round_trip,
    "conform_sink": q_conform_sink,
    "sales_feeds_load": q_sales_feeds_load,
    "bank_jobs": q_bank_jobs,
    "json_array_round_trip": q_json_array_round_trip,
    "sales_feeds_untyped": q_sales_feeds_untyped,
    **_VIEW_QUERIES,
    **_ALL_SYMBOLS_QUERIES,
    "stream_failed": q_stream_failed,
    "stream_cleaned": q_stream_cleaned,
}

# the bars of one symbol and year, under the name that the SQL of the views reads
_CHOSEN = f"""{_BARS.replace("bars AS (", "all_bars AS (", 1)},
bars AS (SELECT * FROM all_bars WHERE symbol = upper('{RANGE_SYMBOL}') AND dt >= DATE '{RANGE_START}' AND dt < DATE '{RANGE_END}')
"""

EXTRA_ORACLE_SQL = {
    "stream_cleaned": ORACLE_SQL["orders_clean"],
    "stock_views_all_details": ORACLE_SQL["page_3"],
    "stock_views_all_return_histogram": ORACLE_SQL["return_histogram"],
    "stock_views_all_correlation": ORACLE_SQL["corr_matrix"],
    "stock_views_all_prediction_fit": ORACLE_SQL["next_close_fit"],
    "csv_round_trip": "SELECT * FROM orders",
    "csv_nested_read": "SELECT * FROM orders",
    "csv_mixed_headers": "SELECT * FROM orders",
    "damaged_feeds": "SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 7 THEN o_totalprice END AS o_totalprice, o_orderkey % 50 = 7 AS rejected FROM orders",
    "json_round_trip": "SELECT * FROM orders",
    "conform_sink": ORACLE_SQL["sales_load"],
    "sales_feeds_load": ORACLE_SQL["sales_load"],
    "sales_feeds_untyped": ORACLE_SQL["sales_load"],
    "json_array_round_trip": "SELECT * FROM orders",
    "stock_view_details_pages": f"""WITH {_CHOSEN}
        SELECT symbol, least(count(*), 180) AS total_rows, CAST(floor((least(count(*), 180) - 1) / 5) + 1 AS BIGINT) AS total_pages
        FROM bars GROUP BY symbol""",
    "stock_view_return_histogram": histogram_sql(_CHOSEN + RETS_OF_BARS, 9),
    "stock_view_return_density": kde_sql(_CHOSEN + RETS_OF_BARS, 9),
    "stock_view_averages": f"""WITH {_CHOSEN}
        SELECT *, round(CASE WHEN count(close) OVER w50 = 50 THEN avg(close) OVER w50 END, 4) AS ma50,
          round(CASE WHEN count(close) OVER w200 = 200 THEN avg(close) OVER w200 END, 4) AS ma200
        FROM bars
        WINDOW w50 AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
               w200 AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)""",
    "stock_view_prediction_fit": f"""WITH {_CHOSEN + TRAIN_OF_BARS}
        SELECT symbol, round(slope, 6) AS slope, round(intercept, 4) AS intercept, round(r2, 6) AS r2, n FROM fit""",
    "stock_view_prediction": f"""WITH {_CHOSEN + TRAIN_OF_BARS}
        SELECT t.*, round(f.slope * t.close + f.intercept, 4) AS predicted FROM train t JOIN fit f ON t.symbol = f.symbol""",
    "stock_view_price": f"""WITH {_CHOSEN}
        SELECT symbol, max(high) AS highest, min(low) AS lowest,
          printf('$%.2f', max(high)) AS highest_txt, printf('$%.2f', min(low)) AS lowest_txt
        FROM bars GROUP BY symbol""",
    "bank_jobs": ORACLE_SQL["failed_extract"],
    "stock_view_details": f"""WITH {_BARS},
        chosen AS (SELECT * FROM bars WHERE symbol = upper('{RANGE_SYMBOL}')
                     AND dt >= DATE '{RANGE_START}' AND dt < DATE '{RANGE_END}'),
        tail AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY dt DESC) AS rn FROM chosen) WHERE rn <= 180)
        SELECT symbol, dt, open, high, low, close, volume,
          CAST(row_number() OVER (ORDER BY dt) AS INTEGER) AS row_no
        FROM tail QUALIFY row_no <= 5""",
    "stock_view_correlation": f"""WITH {_BARS},
        chosen AS (SELECT * FROM bars WHERE symbol IN ('2-HIGH', upper('{RANGE_SYMBOL}'))
                     AND dt >= DATE '{RANGE_START}' AND dt < DATE '{RANGE_END}'),
        rets AS (SELECT * FROM (
          SELECT symbol, dt, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY dt), 0) - 1 AS ret
          FROM chosen) WHERE ret IS NOT NULL)
        SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, round(corr(a.ret, b.ret), 6) AS corr
        FROM rets a JOIN rets b ON a.dt = b.dt GROUP BY 1, 2""",
    "stream_failed": ORACLE_SQL["failed_extract"],
}
