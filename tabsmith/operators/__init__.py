"""DataFrame operators: ``DataFrame -> DataFrame``, no session state."""

from tabsmith.operators.enrich import amount, convert, random_int, share, tag, union_all
from tabsmith.operators.quality import (
    cast_double,
    dedupe,
    drop_any,
    drop_missing,
    fill,
    parse_dates,
    require_rows,
    status_in,
    strip_columns,
)
from tabsmith.operators.stats import (
    bin_index,
    corr_matrix,
    corr_with,
    fit_next_close,
    histogram,
    kde,
    pair_corr,
    predict_next_close,
)
from tabsmith.operators.timeseries import (
    close_matrix,
    daily_return,
    extremes,
    moving_average,
    next_close,
    normalize_symbol,
    page,
    page_info,
    positions,
    select_bars,
    sequence_views,
    tail_rows,
    with_indicators,
)

__all__ = [
    "amount",
    "bin_index",
    "cast_double",
    "close_matrix",
    "convert",
    "corr_matrix",
    "corr_with",
    "daily_return",
    "dedupe",
    "drop_any",
    "drop_missing",
    "extremes",
    "fill",
    "fit_next_close",
    "histogram",
    "kde",
    "moving_average",
    "next_close",
    "normalize_symbol",
    "page",
    "page_info",
    "pair_corr",
    "parse_dates",
    "positions",
    "predict_next_close",
    "random_int",
    "require_rows",
    "select_bars",
    "sequence_views",
    "share",
    "status_in",
    "strip_columns",
    "tag",
    "tail_rows",
    "union_all",
    "with_indicators",
]
