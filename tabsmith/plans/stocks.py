"""Stock analysis views over a bar table, for every symbol at once.

Each view is a lazy DataFrame; drawing is left to the caller. Views that
share the ``(symbol, dt)`` order are computed from one indicator pass.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.operators.quality import drop_missing, require_rows
from tabsmith.operators.stats import corr_matrix, fit_next_close, histogram, kde, predict_next_close
from tabsmith.operators.timeseries import (
    SYMBOL,
    daily_return,
    extremes,
    sequence_views,
    normalize_symbol,
    page,
    page_info,
    select_bars,
    tail_rows,
)
from tabsmith.session import materialize

# The symbol, benchmark and dates the views start from.
DEFAULT_SYMBOL = "AAPL"
BENCHMARK = "AAPL"
DEFAULT_START, DEFAULT_END = "2020-01-01", "2025-12-31"


def returns(bars: DataFrame) -> DataFrame:
    """Daily returns that are there: not the leading null of each symbol, nor
    one (null or NaN) beside a missing price."""
    return drop_missing(daily_return(bars), ["ret"])


def _view_makers(
    bars: DataFrame,
    symbols: Sequence[str] | str,
    start: str | None,
    end: str | None,
    benchmark: str,
    page_no: int,
    per_page: int,
    tail: int,
    check_empty: bool,
    checkpoint_bars: bool,
) -> dict[str, Callable[[], DataFrame]]:
    wanted = [normalize_symbol(s) for s in ([symbols] if isinstance(symbols, str) else symbols)]
    corr_symbols = list(dict.fromkeys([normalize_symbol(benchmark)] + wanted))
    with_bench = select_bars(bars, corr_symbols, start, end)
    if checkpoint_bars:
        with_bench = materialize(with_bench)
    chosen = with_bench.filter(F.col(SYMBOL).isin(wanted))
    if check_empty:
        require_rows(chosen, "No data found.")
    return {
        "details": lambda: page(tail_rows(chosen, tail), page_no, per_page),
        "details_pages": lambda: page_info(tail_rows(chosen, tail), per_page),
        "return_histogram": lambda: histogram(returns(chosen), "ret", 100),
        "return_density": lambda: kde(returns(chosen), "ret", 200),
        "averages": lambda: sequence_views(chosen, windows=(50, 200)),
        "correlation": lambda: corr_matrix(returns(with_bench), corr_symbols),
        "prediction_fit": lambda: fit_next_close(chosen),
        "prediction": lambda: predict_next_close(chosen),
        "price": lambda: extremes(chosen),
    }


def stock_views(
    bars: DataFrame,
    symbols: Sequence[str] | str = DEFAULT_SYMBOL,
    start: str | None = DEFAULT_START,
    end: str | None = DEFAULT_END,
    benchmark: str = BENCHMARK,
    page_no: int = 1,
    per_page: int = 5,
    tail: int = 180,
    check_empty: bool = True,
    checkpoint_bars: bool = True,
) -> dict[str, DataFrame]:
    """All outputs of the six data views: details (tail + page), return
    distribution, moving averages, correlation with the benchmark, next-close
    prediction and price extremes.

    With ``checkpoint_bars`` the selected bars (chosen symbols plus the
    benchmark, a small table) are checkpointed once into the shared
    checkpoint folder: the views then read that copy instead of each
    recomputing the selection, and a lost executor does not re-run it.
    """
    makers = _view_makers(bars, symbols, start, end, benchmark, page_no, per_page, tail, check_empty, checkpoint_bars)
    return {name: make() for name, make in makers.items()}


def stock_view(
    name: str,
    bars: DataFrame,
    symbols: Sequence[str] | str = DEFAULT_SYMBOL,
    start: str | None = DEFAULT_START,
    end: str | None = DEFAULT_END,
    benchmark: str = BENCHMARK,
    page_no: int = 1,
    per_page: int = 5,
    tail: int = 180,
    check_empty: bool = True,
    checkpoint_bars: bool = True,
) -> DataFrame:
    """One output of :func:`stock_views`; the others are not planned."""
    return _view_makers(bars, symbols, start, end, benchmark, page_no, per_page, tail, check_empty, checkpoint_bars)[name]()


__all__ = ["returns", "stock_view", "stock_views", "SYMBOL"]
