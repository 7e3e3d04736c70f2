"""Driver queries: every operator bound to the supplied tables.

Each query takes ``(spark, sf_dir)``, reads whole tables and returns a lazy
DataFrame. ``ORACLE_SQL`` holds the same computation in DuckDB SQL over the
same tables; column names and types match the Spark result. Computed
doubles are rounded on both sides where the engines may differ in the last
bits (sums in another order, ``exp``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.functions import capitalize, char_length, lower_case, strip_spaces, swap_case, title_case, upper_case
from tabsmith.operators import (
    amount,
    close_matrix,
    convert,
    corr_matrix,
    corr_with,
    daily_return,
    dedupe,
    drop_any,
    extremes,
    fit_next_close,
    histogram,
    kde,
    page,
    page_info,
    predict_next_close,
    random_int,
    select_bars,
    sequence_views,
    share,
    status_in,
    tag,
    tail_rows,
    union_all,
    with_indicators,
)
from tabsmith.plans.bank import clean_transactions, failed_transactions
from tabsmith.plans.bindings import (
    REGION_RATES,
    bars_from_orders,
    orders_with_gaps,
    sales_from_lineitem,
    transactions_from_orders,
)
from tabsmith.plans.sales import final_sales
from tabsmith.plans.stocks import returns
from tabsmith.session import materialize

# The five order priorities, which play the part of ticker symbols.
SYMBOLS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
BENCH_SYMBOL = "1-URGENT"
RANGE_SYMBOL, RANGE_START, RANGE_END = "1-urgent", "1996-01-01", "1997-01-01"

Query = Callable[[SparkSession, str], DataFrame]


_RESOLVED: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The supplied table ``name``, resolved once per session.

    Like a catalog table: the file listing and Parquet schema are resolved on
    first use and the relation is reused by later queries (every query still
    scans the files in full). The supplied tables are read-only.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (id(spark), path)
    df = _RESOLVED.get(key)
    if df is None or df.sparkSession is not spark:
        df = spark.read.parquet(path)
        _RESOLVED[key] = df
    return df


def _bars(spark, sf_dir):
    return bars_from_orders(table(spark, sf_dir, "orders"))


def _bars_once(spark, sf_dir):
    """Bars aggregated once and checkpointed: the order-dependent views read
    them in more than one branch (segment counts and rows, per-symbol stats
    and rows), which must not re-aggregate the orders table each time."""
    return materialize(_bars(spark, sf_dir))


def _returns(spark, sf_dir):
    return returns(_bars_once(spark, sf_dir))


def _r(c: str, digits: int):
    return F.round(F.col(c), digits).alias(c)


# --- bank: cleaning and failed extract -----------------------------------------


def q_orders_clean(spark, sf_dir):
    return clean_transactions(transactions_from_orders(table(spark, sf_dir, "orders")))


def q_failed_extract(spark, sf_dir):
    return failed_transactions(q_orders_clean(spark, sf_dir))


def q_status_in(spark, sf_dir):
    return status_in(table(spark, sf_dir, "orders"), "o_orderstatus", ["F", "P"])


def q_strip_spaces(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", strip_spaces("o_orderpriority").alias("priority_code"))


def q_drop_any(spark, sf_dir):
    return drop_any(orders_with_gaps(table(spark, sf_dir, "orders")))


def q_dedupe_rows(spark, sf_dir):
    return dedupe(table(spark, sf_dir, "events").select("user_id", "event_type"))


def q_dedupe_whole_rows(spark, sf_dir):
    return dedupe(table(spark, sf_dir, "events"))


# --- sales: amounts, conversion, year, union, load ------------------------------


def q_line_amount(spark, sf_dir):
    li = amount(table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", "Amount")
    return li.select("l_orderkey", "l_linenumber", _r("Amount", 2))


def q_convert_currency(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    df = (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", F.col("r_name").alias("Country"), F.col("c_acctbal").alias("Amount"))
    )
    return convert(df, REGION_RATES).select("c_custkey", "Country", "Amount", _r("INR_Amount", 4))


def q_convert_rate_table(spark, sf_dir):
    """Conversion with the rates as a table (left join) instead of a dict;
    the rate table is derived from ``region``; two regions get no rate."""
    rates = table(spark, sf_dir, "region").filter(F.col("r_regionkey") < 3).select(
        F.col("r_name").alias("Country"), (F.col("r_regionkey") * 2.5 + 0.5).alias("rate")
    )
    base = q_convert_currency(spark, sf_dir).drop("INR_Amount")
    return convert(base, rates).select("c_custkey", "Country", "Amount", _r("INR_Amount", 4))


def q_key_year(spark, sf_dir):
    customer = table(spark, sf_dir, "customer").select("c_custkey")
    return random_int(customer, "Year", 1900, 2000, key=F.col("c_custkey") * 7919 + 13)


def q_random_year(spark, sf_dir):
    return random_int(table(spark, sf_dir, "customer").select("c_custkey"), "Year", 1900, 2000, seed=42)


def _parties(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("party_key"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nationkey"),
        F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("party_key"),
        F.col("s_name").alias("name"),
        F.col("s_nationkey").alias("nationkey"),
        F.col("s_acctbal").alias("acctbal"),
    )
    return [tag(customers, "source", "customer"), tag(suppliers, "source", "supplier")]


def q_union_by_name(spark, sf_dir):
    return union_all(_parties(spark, sf_dir))


def _sales_feed(spark, sf_dir):
    return sales_from_lineitem(*(table(spark, sf_dir, t) for t in ("lineitem", "part", "supplier", "nation", "region")))


def q_sales_load(spark, sf_dir):
    out = final_sales(_sales_feed(spark, sf_dir), rates=REGION_RATES, year_key="sale_key")
    return out.withColumn("INR_Amount", F.round("INR_Amount", 4)).withColumn("Amount", F.round("Amount", 4))


# --- stocks: bars, windows, statistics ------------------------------------------


def q_bars(spark, sf_dir):
    return _bars(spark, sf_dir)


def q_bars_range(spark, sf_dir):
    return select_bars(_bars(spark, sf_dir), RANGE_SYMBOL, RANGE_START, RANGE_END)


def q_daily_return(spark, sf_dir):
    return daily_return(_bars_once(spark, sf_dir)).select("symbol", "dt", "close", _r("ret", 6))


def q_moving_average(spark, sf_dir):
    df = sequence_views(_bars_once(spark, sf_dir), windows=(50, 200))
    return df.select("symbol", "dt", "close", _r("ma50", 6), _r("ma200", 6))


def q_indicators(spark, sf_dir):
    df = with_indicators(_bars_once(spark, sf_dir))
    return df.select("symbol", "dt", "close", _r("ret", 6), _r("ma50", 6), _r("ma200", 6), "next_close")


def q_corr_benchmark(spark, sf_dir):
    return corr_with(_returns(spark, sf_dir), BENCH_SYMBOL).select("symbol", "benchmark", _r("corr", 6), "n_pairs")


def q_corr_matrix(spark, sf_dir):
    return corr_matrix(_returns(spark, sf_dir), SYMBOLS).select("symbol_a", "symbol_b", _r("corr", 6))


def q_corr_intraday(spark, sf_dir):
    """Correlation of turnovers at four times a day, as a made-up clock of the
    order key gives them: moments count as they stand, not by day."""
    orders = table(spark, sf_dir, "orders")
    at = F.col("o_orderdate") + F.make_dt_interval(hours=(F.col("o_orderkey") % 4).cast("int"))
    turnover = orders.groupBy(F.col("o_orderpriority").alias("symbol"), at.alias("dt")).agg(F.sum("o_totalprice").alias("ret"))
    return corr_matrix(turnover, SYMBOLS).select("symbol_a", "symbol_b", _r("corr", 6))


def _keyed_bars(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("symbol"), F.to_date("o_orderdate").alias("dt")).agg(
        F.max("o_orderkey").alias("k"), F.max_by("o_totalprice", "o_orderkey").alias("close")
    )


def q_bars_null_keys(spark, sf_dir):
    """The order-dependent views over bars of which some have no symbol and
    some no date (those come first in their series), summed per symbol so that
    the order among undated rows does not show; no row may be lost."""
    gone = lambda c, n: F.when(F.col("k") % n != 0, F.col(c)).alias(c)
    bars = materialize(_keyed_bars(spark, sf_dir).select("k", gone("symbol", 41), gone("dt", 37), "close"))
    numbered = page(with_indicators(bars, windows=(50,)), 1, per_page=2**31 - 1)
    return numbered.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("dt").alias("n_dated"),
        F.count("ret").alias("n_returns"),
        F.count("ma50").alias("n_averages"),
        F.count("next_close").alias("n_next"),
        F.round(F.sum(F.when(F.col("dt").isNotNull(), F.col("next_close"))), 2).alias("sum_next"),
        F.sum("row_no").alias("sum_row_no"),
    )


def q_corr_nan_gaps(spark, sf_dir):
    """The correlation matrix of returns where some closes are NaN: a return
    beside one is missing, and so is not counted."""
    close = F.when(F.col("k") % 29 != 0, F.col("close")).otherwise(F.lit(float("nan"))).alias("close")
    bars = materialize(_keyed_bars(spark, sf_dir).select("symbol", "dt", close))
    return corr_matrix(returns(bars), SYMBOLS).select("symbol_a", "symbol_b", _r("corr", 6))


def q_next_close_fit(spark, sf_dir):
    fit = fit_next_close(_bars_once(spark, sf_dir))
    return fit.select("symbol", _r("slope", 8), _r("intercept", 4), _r("r2", 8), "n")


def q_next_close_predict(spark, sf_dir):
    pred = predict_next_close(_bars_once(spark, sf_dir))
    return pred.select("symbol", "dt", "close", "next_close", _r("predicted", 4))


def q_return_histogram(spark, sf_dir):
    h = histogram(_returns(spark, sf_dir), "ret", 100)
    return h.select("symbol", "bin", _r("bin_lo", 8), _r("bin_hi", 8), "count")


def q_return_kde(spark, sf_dir):
    k = kde(_returns(spark, sf_dir), "ret", 200)
    return k.select("symbol", "i", _r("x", 8), _r("density", 6))


def q_tail_180(spark, sf_dir):
    return tail_rows(_bars_once(spark, sf_dir), 180)


def q_page_3(spark, sf_dir):
    return page(tail_rows(_bars_once(spark, sf_dir), 180), 3, 5)


def q_page_shift(spark, sf_dir):
    return page(tail_rows(_bars_once(spark, sf_dir), 180), 36, 5, shift=1)


def q_page_info(spark, sf_dir):
    return page_info(tail_rows(_bars_once(spark, sf_dir), 180), 5)


def q_price_extremes(spark, sf_dir):
    return extremes(_bars(spark, sf_dir))


def q_close_matrix(spark, sf_dir):
    return close_matrix(_bars(spark, sf_dir), SYMBOLS)


# --- shares and strings -----------------------------------------------------------


def q_event_share(spark, sf_dir):
    return share(table(spark, sf_dir, "events"), "event_type")


def q_string_cases(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(
        "p_partkey",
        upper_case("p_name").alias("name_upper"),
        lower_case("p_brand").alias("brand_lower"),
        title_case("p_name").alias("name_title"),
        capitalize("p_name").alias("name_capitalized"),
        char_length("p_name").alias("name_length"),
        char_length("p_brand").alias("brand_length"),
    )


def q_swap_case(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", "p_brand", swap_case("p_brand").alias("brand_swapped"))


def q_title_python(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", title_case("p_brand", python_rules=True).alias("brand_title"))


QUERIES: dict[str, Query] = {
    "orders_clean": q_orders_clean,
    "failed_extract": q_failed_extract,
    "status_in": q_status_in,
    "strip_spaces": q_strip_spaces,
    "dedupe_rows": q_dedupe_rows,
    "dedupe_whole_rows": q_dedupe_whole_rows,
    "drop_any": q_drop_any,
    "line_amount": q_line_amount,
    "convert_currency": q_convert_currency,
    "convert_rate_table": q_convert_rate_table,
    "key_year": q_key_year,
    "random_year": q_random_year,
    "union_by_name": q_union_by_name,
    "sales_load": q_sales_load,
    "bars": q_bars,
    "bars_range": q_bars_range,
    "daily_return": q_daily_return,
    "moving_average": q_moving_average,
    "indicators": q_indicators,
    "corr_benchmark": q_corr_benchmark,
    "corr_matrix": q_corr_matrix,
    "corr_intraday": q_corr_intraday,
    "bars_null_keys": q_bars_null_keys,
    "corr_nan_gaps": q_corr_nan_gaps,
    "next_close_fit": q_next_close_fit,
    "next_close_predict": q_next_close_predict,
    "return_histogram": q_return_histogram,
    "return_kde": q_return_kde,
    "tail_180": q_tail_180,
    "page_3": q_page_3,
    "page_shift": q_page_shift,
    "page_info": q_page_info,
    "price_extremes": q_price_extremes,
    "close_matrix": q_close_matrix,
    "event_share": q_event_share,
    "string_cases": q_string_cases,
    "swap_case": q_swap_case,
    "title_python": q_title_python,
}


# ----------------------------------------------------------------------------------
# DuckDB oracle
# ----------------------------------------------------------------------------------

_TXNS = """
raw AS (
  SELECT o_orderkey AS Transaction_ID, o_custkey AS Account_ID,
    CASE WHEN o_orderkey % 7 = 0 THEN strftime(o_orderdate, '%d/%m/%Y')
         ELSE strftime(o_orderdate, '%Y-%m-%d') END AS Transaction_Date,
    CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE CAST(o_totalprice AS VARCHAR) END AS Transaction_Amount,
    CASE WHEN o_orderkey % 11 = 0 THEN 'abc' ELSE CAST(o_totalprice / 1000 AS VARCHAR) END AS Fee_Charged,
    CASE WHEN o_orderkey % 3 = 0 THEN ' ' || chr(9) || o_orderpriority || ' ' ELSE o_orderpriority END AS Branch_Code,
    CASE WHEN o_orderstatus = 'F' THEN (CASE WHEN o_orderkey % 13 = 0 THEN 'failed' ELSE 'Failed' END)
         WHEN o_orderstatus = 'P' THEN 'Declined' ELSE 'Success' END AS Transaction_Status
  FROM orders),
clean AS (
  SELECT Transaction_ID, Account_ID,
    CAST(try_strptime(Transaction_Date, '%Y-%m-%d') AS DATE) AS Transaction_Date,
    coalesce(TRY_CAST(Transaction_Amount AS DOUBLE), 0.0) AS Transaction_Amount,
    coalesce(TRY_CAST(Fee_Charged AS DOUBLE), 0.0) AS Fee_Charged,
    trim(regexp_replace(Branch_Code, '\\s+', '', 'g')) AS Branch_Code,
    Transaction_Status
  FROM (SELECT DISTINCT * FROM raw) d
  WHERE try_strptime(Transaction_Date, '%Y-%m-%d') IS NOT NULL)
"""

_BARS = """
bars AS (
  SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS dt,
    arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high,
    min(o_totalprice) AS low, arg_max(o_totalprice, o_orderkey) AS close,
    count(*) AS volume
  FROM orders GROUP BY 1, 2)
"""

RETS_OF_BARS = """,
rets AS (
  SELECT symbol, dt, ret FROM (
    SELECT symbol, dt, close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY dt), 0) - 1 AS ret
    FROM bars) WHERE ret IS NOT NULL)
"""

_RETURNS = _BARS + RETS_OF_BARS

TRAIN_OF_BARS = """,
train AS (
  SELECT * FROM (
    SELECT symbol, dt, open, high, low, close, volume,
      lead(close) OVER (PARTITION BY symbol ORDER BY dt) AS next_close
    FROM bars) t
  WHERE open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
    AND volume IS NOT NULL AND next_close IS NOT NULL),
fit AS (
  SELECT symbol, coalesce(regr_slope(next_close, close), 0.0) AS slope,
    coalesce(regr_intercept(next_close, close), avg(next_close)) AS intercept,
    regr_r2(next_close, close) AS r2, count(*) AS n
  FROM train GROUP BY symbol)
"""

_TRAIN = _BARS + TRAIN_OF_BARS

_TAIL = _BARS + """,
tail AS (
  SELECT symbol, dt, open, high, low, close, volume FROM (
    SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY dt DESC) AS rn FROM bars) WHERE rn <= 180),
numbered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY dt) AS INTEGER) AS row_no FROM tail)
"""

_HIST_BINS = 100
_KDE_GRID = 200


def histogram_sql(ctes: str, digits: int) -> str:
    """All bins of every symbol's returns (``rets`` of ``ctes``), numpy's rule."""
    return f"""WITH {ctes},
        rng AS (SELECT symbol, min(ret) AS lo, max(ret) AS hi FROM rets GROUP BY symbol),
        raw AS (
          SELECT r.symbol, r.ret AS x, g.lo, g.hi, (g.hi - g.lo) / {_HIST_BINS}.0 AS step,
            least(CAST(floor((r.ret - g.lo) * ({_HIST_BINS}.0 / (g.hi - g.lo))) AS INTEGER), {_HIST_BINS - 1}) AS b0
          FROM rets r JOIN rng g ON r.symbol = g.symbol),
        down AS (SELECT *, CASE WHEN x < lo + CAST(b0 AS DOUBLE) * step THEN b0 - 1 ELSE b0 END AS b1 FROM raw),
        binned AS (
          SELECT symbol,
            CASE WHEN hi = lo THEN 0
                 WHEN x >= lo + CAST(b1 + 1 AS DOUBLE) * step AND b1 <> {_HIST_BINS - 1} THEN b1 + 1
                 ELSE b1 END AS bin
          FROM down),
        counted AS (SELECT symbol, bin, count(*) AS n FROM binned GROUP BY symbol, bin),
        grid AS (SELECT symbol, lo, hi, (hi - lo) / {_HIST_BINS}.0 AS step, CAST(i AS INTEGER) AS bin FROM rng, range(0, {_HIST_BINS}) t(i))
        SELECT g.symbol, g.bin,
          round(lo + CAST(g.bin AS DOUBLE) * step, {digits}) AS bin_lo,
          round(CASE WHEN g.bin = {_HIST_BINS - 1} THEN hi ELSE lo + CAST(g.bin + 1 AS DOUBLE) * step END, {digits}) AS bin_hi,
          coalesce(c.n, 0) AS count
        FROM grid g LEFT JOIN counted c ON g.symbol = c.symbol AND g.bin = c.bin"""


def kde_sql(ctes: str, digits: int) -> str:
    """The density of every symbol's returns (``rets`` of ``ctes``)."""
    return f"""WITH {ctes},
        st AS (SELECT symbol, min(ret) AS lo, max(ret) AS hi, count(ret) AS n,
                 stddev_samp(ret) * pow(CAST(count(ret) AS DOUBLE), -0.2) AS h
               FROM rets GROUP BY symbol),
        grid AS (
          SELECT symbol, n, h, CAST(i AS INTEGER) AS i,
            CASE WHEN i = {_KDE_GRID - 1} THEN hi ELSE lo + CAST(i AS DOUBLE) * ((hi - lo) / {_KDE_GRID - 1}.0) END AS x
          FROM st, range(0, {_KDE_GRID}) t(i))
        SELECT g.symbol, g.i, round(g.x, {digits}) AS x,
          round(sum(exp(-0.5 * ((g.x - r.ret) / g.h) * ((g.x - r.ret) / g.h)))
                / (CAST(g.n AS DOUBLE) * g.h * sqrt(2 * pi())), 6) AS density
        FROM grid g JOIN rets r ON g.symbol = r.symbol
        GROUP BY g.symbol, g.i, g.x, g.n, g.h"""


# Bars without some keys: every 41st position by the order key loses its symbol,
# every 37th its date; and closes that are NaN.
_KEYLESS = """
keyed AS (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS dt, max(o_orderkey) AS k,
    arg_max(o_totalprice, o_orderkey) AS close FROM orders GROUP BY 1, 2),
bars AS (SELECT k, CASE WHEN k % 41 <> 0 THEN symbol END AS symbol, CASE WHEN k % 37 <> 0 THEN dt END AS dt, close FROM keyed)
"""
_GAPPY = """
keyed AS (SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS dt, max(o_orderkey) AS k,
    arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1, 2),
rets AS (SELECT symbol, dt, ret FROM (
    SELECT symbol, dt, close / lag(close) OVER (PARTITION BY symbol ORDER BY dt) - 1 AS ret
    FROM (SELECT symbol, dt, CASE WHEN k % 29 <> 0 THEN price END AS close FROM keyed)) WHERE ret IS NOT NULL)
"""

ORACLE_SQL: dict[str, str] = {
    "dedupe_whole_rows": "SELECT DISTINCT * FROM events",
    "orders_clean": f"WITH {_TXNS} SELECT * FROM clean",
    "failed_extract": f"WITH {_TXNS} SELECT * FROM clean WHERE Transaction_Status IN ('Failed', 'Declined')",
    "status_in": "SELECT * FROM orders WHERE o_orderstatus IN ('F', 'P')",
    "strip_spaces": "SELECT o_orderkey, trim(regexp_replace(o_orderpriority, '\\s+', '', 'g')) AS priority_code FROM orders",
    "dedupe_rows": "SELECT DISTINCT user_id, event_type FROM events",
    "drop_any": """
        SELECT * FROM (
          SELECT o_orderkey, o_custkey, o_orderstatus,
            CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice,
            o_orderdate, o_orderpriority FROM orders) t
        WHERE o_orderkey IS NOT NULL AND o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL
          AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)
          AND o_orderdate IS NOT NULL AND o_orderpriority IS NOT NULL""",
    "line_amount": "SELECT l_orderkey, l_linenumber, round(l_quantity * l_extendedprice, 2) AS Amount FROM lineitem",
    "convert_currency": """
        SELECT c_custkey, r_name AS Country, c_acctbal AS Amount,
          round(c_acctbal * coalesce(CASE r_name WHEN 'AMERICA' THEN 0.57::DOUBLE WHEN 'ASIA' THEN 8.21::DOUBLE
                                                  WHEN 'EUROPE' THEN 89.34::DOUBLE END, 1.0::DOUBLE), 4) AS INR_Amount
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "convert_rate_table": """
        SELECT c_custkey, r_name AS Country, c_acctbal AS Amount,
          round(c_acctbal * coalesce(CASE WHEN r_regionkey < 3 THEN r_regionkey * 2.5 + 0.5 END, 1.0::DOUBLE), 4) AS INR_Amount
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "key_year": "SELECT c_custkey, CAST(1900 + (((c_custkey * 7919 + 13) % 101) + 101) % 101 AS BIGINT) AS Year FROM customer",
    "union_by_name": """
        SELECT c_custkey AS party_key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal,
               c_mktsegment AS segment, 'customer' AS source FROM customer
        UNION ALL BY NAME
        SELECT s_suppkey AS party_key, s_name AS name, s_nationkey AS nationkey, s_acctbal AS acctbal,
               'supplier' AS source FROM supplier""",
    "sales_load": """
        WITH feed AS (
          SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS SaleId,
            p_type AS Category, p_name AS Product,
            CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE l_quantity END AS Qty,
            p_retailprice AS Sale, r_name AS Country, l_orderkey * 7 + l_linenumber AS sale_key
          FROM lineitem JOIN part ON l_partkey = p_partkey
            JOIN supplier ON l_suppkey = s_suppkey
            JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
        SELECT SaleId, Category, Product, CAST(Qty AS BIGINT) AS Qty, Sale,
          round(Qty * Sale, 4) AS Amount,
          round(Qty * Sale * coalesce(CASE Country WHEN 'AMERICA' THEN 0.57::DOUBLE WHEN 'ASIA' THEN 8.21::DOUBLE
                                                   WHEN 'EUROPE' THEN 89.34::DOUBLE END, 1.0::DOUBLE), 4) AS INR_Amount,
          Country, CAST(1900 + ((sale_key % 101) + 101) % 101 AS BIGINT) AS Year
        FROM feed
        WHERE SaleId IS NOT NULL AND Category IS NOT NULL AND Product IS NOT NULL
          AND Qty IS NOT NULL AND NOT isnan(Qty) AND Sale IS NOT NULL AND NOT isnan(Sale)
          AND Country IS NOT NULL AND sale_key IS NOT NULL""",
    "bars": f"WITH {_BARS} SELECT * FROM bars",
    "bars_range": f"""WITH {_BARS} SELECT * FROM bars
        WHERE symbol = upper('{RANGE_SYMBOL}') AND dt >= DATE '{RANGE_START}' AND dt < DATE '{RANGE_END}'""",
    "daily_return": f"""WITH {_BARS}
        SELECT symbol, dt, close,
          round(close / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY dt), 0) - 1, 6) AS ret
        FROM bars""",
    "moving_average": f"""WITH {_BARS}
        SELECT symbol, dt, close,
          round(CASE WHEN count(close) OVER w50 = 50 THEN avg(close) OVER w50 END, 6) AS ma50,
          round(CASE WHEN count(close) OVER w200 = 200 THEN avg(close) OVER w200 END, 6) AS ma200
        FROM bars
        WINDOW w50 AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
               w200 AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)""",
    "indicators": f"""WITH {_BARS}
        SELECT symbol, dt, close,
          round(close / nullif(lag(close) OVER w, 0) - 1, 6) AS ret,
          round(CASE WHEN count(close) OVER w50 = 50 THEN avg(close) OVER w50 END, 6) AS ma50,
          round(CASE WHEN count(close) OVER w200 = 200 THEN avg(close) OVER w200 END, 6) AS ma200,
          lead(close) OVER w AS next_close
        FROM bars
        WINDOW w AS (PARTITION BY symbol ORDER BY dt),
               w50 AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
               w200 AS (PARTITION BY symbol ORDER BY dt ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)""",
    "corr_benchmark": f"""WITH {_RETURNS}
        SELECT r.symbol, '{BENCH_SYMBOL}' AS benchmark, round(corr(r.ret, b.ret), 6) AS corr,
          count(r.ret * b.ret) AS n_pairs
        FROM rets r JOIN (SELECT dt, ret FROM rets WHERE symbol = '{BENCH_SYMBOL}') b ON r.dt = b.dt
        GROUP BY r.symbol""",
    "corr_matrix": f"""WITH {_RETURNS}
        SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, round(corr(a.ret, b.ret), 6) AS corr
        FROM rets a JOIN rets b ON a.dt = b.dt
        GROUP BY 1, 2""",
    "corr_intraday": """WITH t AS (
            SELECT o_orderpriority AS symbol, o_orderdate + to_hours(o_orderkey % 4) AS dt, sum(o_totalprice) AS ret
            FROM orders GROUP BY 1, 2)
        SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, round(corr(a.ret, b.ret), 6) AS corr
        FROM t a JOIN t b ON a.dt = b.dt
        GROUP BY 1, 2""",
    "next_close_fit": f"""WITH {_TRAIN}
        SELECT symbol, round(slope, 8) AS slope, round(intercept, 4) AS intercept, round(r2, 8) AS r2, n FROM fit""",
    "next_close_predict": f"""WITH {_TRAIN}
        SELECT t.symbol, t.dt, t.close, t.next_close, round(f.slope * t.close + f.intercept, 4) AS predicted
        FROM train t JOIN fit f ON t.symbol = f.symbol""",
    "return_histogram": histogram_sql(_RETURNS, 8),
    "return_kde": kde_sql(_RETURNS, 8),
    "tail_180": f"WITH {_TAIL} SELECT * FROM tail",
    "page_3": f"WITH {_TAIL} SELECT * FROM numbered WHERE row_no > 10 AND row_no <= 15",
    "page_shift": f"WITH {_TAIL} SELECT * FROM numbered WHERE row_no > 176 AND row_no <= 181",
    "page_info": f"""WITH {_TAIL}
        SELECT symbol, count(*) AS total_rows, CAST(floor((count(*) - 1) / 5) + 1 AS BIGINT) AS total_pages
        FROM tail GROUP BY symbol""",
    "bars_null_keys": f"""WITH {_KEYLESS}
        SELECT symbol, count(*) AS n, count(dt) AS n_dated, count(ret) AS n_returns, count(ma50) AS n_averages,
          count(next_close) AS n_next, round(sum(CASE WHEN dt IS NOT NULL THEN next_close END), 2) AS sum_next, CAST(sum(row_no) AS BIGINT) AS sum_row_no
        FROM (SELECT symbol, dt, close / nullif(lag(close) OVER w, 0) - 1 AS ret,
            CASE WHEN count(close) OVER w50 = 50 THEN avg(close) OVER w50 END AS ma50,
            lead(close) OVER w AS next_close, row_number() OVER w AS row_no FROM bars
          WINDOW w AS (PARTITION BY symbol ORDER BY dt NULLS FIRST, k),
            w50 AS (PARTITION BY symbol ORDER BY dt NULLS FIRST, k ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))
        GROUP BY symbol""",
    "corr_nan_gaps": f"""WITH {_GAPPY}
        SELECT a.symbol AS symbol_a, b.symbol AS symbol_b, round(corr(a.ret, b.ret), 6) AS corr
        FROM rets a JOIN rets b ON a.dt = b.dt GROUP BY 1, 2""",
    "price_extremes": f"""WITH {_BARS}
        SELECT symbol, max(high) AS highest, min(low) AS lowest,
          printf('$%.2f', max(high)) AS highest_txt, printf('$%.2f', min(low)) AS lowest_txt
        FROM bars GROUP BY symbol""",
    "close_matrix": f"""WITH {_BARS}
        SELECT dt, {", ".join(f"max(close) FILTER (WHERE symbol = '{s}') AS \"{s}\"" for s in SYMBOLS)}
        FROM bars GROUP BY dt""",
    "event_share": """
        WITH c AS (SELECT event_type, count(*) AS n FROM events GROUP BY event_type)
        SELECT event_type, n,
          CAST((n * 2000 + (SELECT sum(n) FROM c)) // (2 * (SELECT sum(n) FROM c)) AS DOUBLE) / 10.0 AS pct
        FROM c""",
    "string_cases": """
        SELECT p_partkey, upper(p_name) AS name_upper, lower(p_brand) AS brand_lower,
          array_to_string(list_transform(string_split(p_name, ' '),
              lambda w: upper(substring(w, 1, 1)) || lower(substring(w, 2))), ' ') AS name_title,
          upper(substring(p_name, 1, 1)) || lower(substring(p_name, 2)) AS name_capitalized,
          CAST(length(p_name) AS INTEGER) AS name_length, CAST(length(p_brand) AS INTEGER) AS brand_length
        FROM part""",
    "swap_case": """
        SELECT p_partkey, p_brand,
          array_to_string(list_transform(string_split(p_brand, ''),
              lambda c: CASE WHEN upper(c) = c THEN lower(c) ELSE upper(c) END), '') AS brand_swapped
        FROM part""",
    "title_python": """
        SELECT p_partkey,
          array_to_string(list_transform(regexp_extract_all(p_brand, '([\\p{Lu}\\p{Ll}\\p{Lt}]+|[^\\p{Lu}\\p{Ll}\\p{Lt}]+)', 1),
              lambda r: upper(substring(r, 1, 1)) || lower(substring(r, 2))), '') AS brand_title
        FROM part""",
}
