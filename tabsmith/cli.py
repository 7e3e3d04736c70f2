"""Command-line entry for the three jobs (``python -m tabsmith ...`` or
``spark-submit tabsmith/cli.py ...``).

    clean   --raw DIR --out DIR [--schema DDL] [--preview N]
    failed  --cleaned DIR --out DIR [--schema DDL]
    sales   --sources SPECS.json (--table NAME | --path DIR) [--seed N]
    stocks  --bars PATH --out DIR [--symbol S ...] [--benchmark B] [--start D] [--end D] [--page N]

``SPECS.json`` is a list of objects with the ``SourceSpec`` fields (``kind``,
``location``, ``country``, ``table``, ``options``). The stock views are
written as one Parquet folder per view under ``--out``.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from tabsmith.plans.bank import run_cleaning, run_failed_extract
from tabsmith.plans.sales import run_sales_load
from tabsmith.plans.stocks import BENCHMARK, DEFAULT_END, DEFAULT_START, DEFAULT_SYMBOL, stock_views
from tabsmith.session import get_session
from tabsmith.sinks import preview, refuse_overwriting_inputs
from tabsmith.sources.registry import SourceSpec


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tabsmith")
    p.add_argument("--cluster", action="store_true", help="large-cluster partition sizing")
    p.add_argument("--input-bytes", type=float, default=2 * 1024**4, help="size of the input that --cluster sizes shuffles for")
    p.add_argument("--shuffle-partitions", type=int, help="partitions of a shuffle, instead of those sized from the input")
    sub = p.add_subparsers(dest="job", required=True)

    clean = sub.add_parser("clean", help="clean raw transaction CSV files")
    clean.add_argument("--raw", required=True)
    clean.add_argument("--out", required=True)
    clean.add_argument("--schema", help="DDL schema of the raw files (default: all text)")
    clean.add_argument("--preview", type=int, default=5, help="show this many cleaned rows (0: none)")

    failed = sub.add_parser("failed", help="extract failed and declined transactions")
    failed.add_argument("--cleaned", required=True)
    failed.add_argument("--out", required=True)
    failed.add_argument("--schema", help="DDL schema of the cleaned files (default: inferred)")

    sales = sub.add_parser("sales", help="load the country sales feeds into one table")
    sales.add_argument("--sources", required=True, help="JSON file with a list of source specs")
    target = sales.add_mutually_exclusive_group(required=True)
    target.add_argument("--table")
    target.add_argument("--path")
    sales.add_argument("--seed", type=int)
    sales.add_argument("--format", default="parquet")

    stocks = sub.add_parser("stocks", help="compute the stock views")
    stocks.add_argument("--bars", required=True, help="Parquet bars (symbol, dt, open, high, low, close, volume)")
    stocks.add_argument("--out", required=True)
    stocks.add_argument("--symbol", nargs="+", default=[DEFAULT_SYMBOL])
    stocks.add_argument("--benchmark", default=BENCHMARK)
    stocks.add_argument("--start", default=DEFAULT_START)
    stocks.add_argument("--end", default=DEFAULT_END)
    stocks.add_argument("--page", type=int, default=1)
    return p


def run(args: argparse.Namespace, spark: SparkSession) -> None:
    if args.job == "clean":
        cleaned = run_cleaning(spark, args.raw, args.out, schema=args.schema)
        if args.preview:
            preview(cleaned, args.preview).show(truncate=False)
    elif args.job == "failed":
        run_failed_extract(spark, args.cleaned, args.out, schema=args.schema)
    elif args.job == "sales":
        with open(args.sources) as f:
            specs = [SourceSpec(**item) for item in json.load(f)]
        run_sales_load(spark, specs, table=args.table, path=args.path, seed=args.seed, fmt=args.format)
    elif args.job == "stocks":
        bars = spark.read.parquet(args.bars)
        views = stock_views(bars, args.symbol, args.start, args.end, args.benchmark, page_no=args.page)
        for name, view in views.items():
            target = f"{args.out.rstrip('/')}/{name}"
            refuse_overwriting_inputs(view, target)
            view.write.mode("overwrite").parquet(target)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = get_session(app=f"tabsmith-{args.job}", cluster=args.cluster, input_bytes=int(args.input_bytes), shuffle_partitions=args.shuffle_partitions)
    run(args, spark)
    return 0


if __name__ == "__main__":
    sys.exit(main())
