"""Operators over price bars ``(symbol, dt, open, high, low, close, volume)``.

Every operator works on all symbols at once.

Order-dependent views (returns, moving averages, next close, pages) never
window over a whole symbol, so a symbol holding a large share of all bars is
still spread over many tasks:

1. ``positions`` numbers the rows of each symbol by ``dt``. The rows are
   range-sorted once by symbol, date and a hash of the row, and laid down; a
   range that a symbol fills, or rows without a date, go to as many tasks as
   any other rows. The place of a row in its range, plus the rows of its symbol
   in earlier ranges, is its number. Those counts are a table with one row per
   range and symbol in it, which goes to the rows; the rows do not move again.
2. The windows then run per (symbol, block of ``block`` positions). Each
   block also receives copies of the rows just before it (``n - 1`` for an
   ``n``-row moving average, one for a return) and just after it (one, for
   the next close) as halo rows, which are dropped afterwards.

All views computed together (``with_indicators``) share one such pass.

No row is lost: rows without a symbol form a series of their own, and rows
without a date come first in their series, in the order of a hash of the row. A
price that is NaN is missing, like null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from tabsmith.functions import fmt_price
from tabsmith.operators._joins import join_back, to_all
from tabsmith.session import materialize

SYMBOL, DT = "symbol", "dt"
# Rows per window block; halo copies cost (n - 1) / BLOCK_ROWS extra rows.
BLOCK_ROWS = 8192
SEGMENT_UNITS = ("year", "quarter", "month", "week", "day", "hour", "minute")
POS, TOTAL, BLK, HALO = "__pos", "__total", "__blk", "__halo"


def normalize_symbol(symbol: str) -> str:
    """Upper-case a ticker typed by a user; a blank one is an error."""
    if symbol is None or not str(symbol).strip():
        raise ValueError("symbol must not be blank")
    return str(symbol).upper()


def select_bars(
    bars: DataFrame,
    symbols: Sequence[str] | str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Bars of some symbols in ``[start, end)``; ``None`` leaves a side open.

    Symbols are upper-cased as the user typed them. The predicates are plain
    column comparisons, so they prune partitions and push into the scan.
    """
    out = bars
    if symbols is not None:
        wanted = [normalize_symbol(s) for s in ([symbols] if isinstance(symbols, str) else symbols)]
        out = out.filter(F.col(SYMBOL).isin(wanted))
    if start is not None:
        out = out.filter(F.col(DT) >= F.lit(start).cast("date"))
    if end is not None:
        out = out.filter(F.col(DT) < F.lit(end).cast("date"))
    return out


def _segment(unit: str) -> Column:
    """Calendar segment of ``dt``; ``hour`` / ``minute`` are for intraday bars
    whose ``dt`` is a timestamp."""
    if unit not in SEGMENT_UNITS:
        raise ValueError(f"segment unit must be one of {SEGMENT_UNITS}")
    if unit in ("hour", "minute"):
        return F.date_trunc(unit, F.col(DT))
    return F.col(DT).cast("date") if unit == "day" else F.trunc(F.col(DT), unit)


#: Pieces (a symbol's rows in one range) that are sent to every task at most;
#: there are as many as ranges and symbols. More are joined by a shuffle.
MAX_PIECES = 1_000_000


def _in_order(rows: DataFrame, by: str) -> DataFrame:
    """``rows`` range-sorted by ``by``, ``dt`` and a hash of the row, laid down
    once, with ``__part`` (number of the range) and ``__at`` (place in it)."""
    plain = [f.name for f in rows.schema.fields if isinstance(f.dataType, AtomicType)]
    order = [F.col(by).asc_nulls_first(), F.col(DT).asc_nulls_first(), F.col("__tie").asc()]
    tied = rows.withColumn("__tie", F.xxhash64(*plain))
    laid = materialize(tied.repartitionByRange(*order).sortWithinPartitions(*order).drop("__tie"))
    number = F.monotonically_increasing_id()
    return laid.withColumns({"__part": F.shiftright(number, 33), "__at": number.bitwiseAND(F.lit((1 << 33) - 1))})


def positions(rows: DataFrame, unit: str = "month", by: str = SYMBOL) -> DataFrame:
    """Add ``__pos`` (1-based row number of the row within its symbol, in
    ``dt`` order) and ``__total`` (rows of the symbol).

    The rows are shuffled once, by range, and written to the shared checkpoint
    folder, since their places must not change between the count and the
    numbering. No window ever holds rows of a symbol, only counts. ``unit`` is a
    calendar unit; it was the size of the groups that rows were numbered in, is
    still checked and has no effect.
    """
    if unit not in SEGMENT_UNITS:
        raise ValueError(f"segment unit must be one of {SEGMENT_UNITS}")
    laid = _in_order(rows, by)
    pieces = laid.groupBy("__part", by).agg(F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__cnt"))
    per_symbol = Window.partitionBy(by)
    earlier = F.sum("__cnt").over(per_symbol.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    pieces = materialize(
        pieces.select("__part", by, (F.coalesce(earlier, F.lit(0)) - F.col("__first") + 1).alias("__shift"), F.sum("__cnt").over(per_symbol).alias(TOTAL))
    )
    small = to_all(pieces) if pieces.count() <= MAX_PIECES else pieces
    return join_back(laid, small, ["__part", by]).withColumn(POS, F.col("__at") + F.col("__shift")).drop("__part", "__at", "__shift")


def _with_halo(ranked: DataFrame, back: int, front: int, block: int) -> DataFrame:
    """Assign each row to block ``(pos - 1) // block``; the last ``back`` rows
    of every block are also emitted into the next block and the first
    ``front`` rows into the previous one, flagged as halo, when that block
    exists. One pass: each row explodes into itself plus at most two copies."""
    p0 = F.col(POS) - 1
    at = F.pmod(p0, F.lit(block))
    own = F.floor(p0 / block).cast("long")
    shifts = [F.lit(0)]
    if back:
        has_next = (own + 1) * block < F.col(TOTAL)
        shifts.append(F.when((at >= block - back) & has_next, F.lit(1)))
    if front:
        shifts.append(F.when((at < front) & (own > 0), F.lit(-1)))
    # explode then drop the null shifts: plain expressions, all code-generated
    return (
        ranked.withColumn("__shift", F.explode(F.array(*shifts)))
        .filter(F.col("__shift").isNotNull())
        .withColumn(BLK, own + F.col("__shift"))
        .withColumn(HALO, F.col("__shift") != 0)
        .drop("__shift")
    )


# The symbol as two columns without nulls: windows, counts and joins on them agree
# on how rows are dealt out, where a null-safe join would deal them out again.
_KEYS = ("__key", "__keyless")


def _keyed(rows: DataFrame, by: str = SYMBOL) -> DataFrame:
    return rows.withColumns({"__key": F.coalesce(F.col(by).cast("string"), F.lit("")), "__keyless": F.col(by).isNull()})


def _block_window():
    return Window.partitionBy(*_KEYS, BLK).orderBy(POS)


def _known(price: str) -> Column:
    """The price, or null where it is NaN."""
    return F.when(~F.isnan(price), F.col(price))


def _moving_average(price: str, n: int) -> Column:
    frame = _block_window().rowsBetween(-(n - 1), 0)
    return F.when(F.count(_known(price)).over(frame) == n, F.avg(_known(price)).over(frame))


def _filled_return(real: DataFrame, price: str, out: str) -> DataFrame:
    """Return on prices with gaps filled by the last known price: inside a
    block a running ``last(ignorenulls)``; across blocks the last known price
    of the earlier blocks, carried through the per-block table."""
    known = _known(price)
    per_block = real.groupBy(*_KEYS, BLK).agg(F.max_by(known, F.when(known.isNotNull(), F.col(POS))).alias("__last"))
    carry = per_block.select(
        *_KEYS,
        BLK,
        F.last("__last", ignorenulls=True)
        .over(Window.partitionBy(*_KEYS).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1))
        .alias("__carry"),
    ).repartition(*_KEYS, BLK)
    w = _block_window()
    filled = real.join(carry, [*_KEYS, BLK]).withColumn(
        "__filled",
        F.coalesce(F.last(known, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.col("__carry")),
    )
    prev = F.when(F.row_number().over(w) == 1, F.col("__carry")).otherwise(F.lag("__filled", 1).over(w))
    return filled.withColumn(out, F.try_divide(F.col("__filled"), prev) - F.lit(1.0)).drop("__carry", "__filled")


def sequence_views(
    bars: DataFrame,
    price: str = "close",
    ret: str | None = None,
    windows: Sequence[int] = (),
    lead: str | None = None,
    fill_gaps: bool = False,
    unit: str = "month",
    block: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the requested order-dependent columns in one pass:

    * ``ret``: ``price / previous price - 1`` within the symbol; the first row
      is null, and so is a return on a zero previous price (not infinity, not
      an ANSI error). With ``fill_gaps`` a missing price is first replaced by
      the last known one (``[1, null, 2]`` gives ``[null, 0, 1]``); by default
      gaps stay null.
    * ``ma{n}`` for each ``n`` in ``windows``: mean of the last ``n`` rows (rows,
      not calendar days), null until the window holds ``n`` non-missing values.
    * ``lead``: the next row's price; null on the last row.
    """
    if any(n < 1 for n in windows):
        raise ValueError("window must be >= 1")
    back = max([n - 1 for n in windows] + [1 if ret and not fill_gaps else 0])
    front = 1 if lead else 0
    block = max(block, back, front, 1)
    framed = _keyed(_with_halo(positions(bars, unit), back, front, block))
    w = _block_window()
    cols: dict[str, Column] = {}
    if ret and not fill_gaps:
        cols[ret] = F.try_divide(F.col(price), F.lag(price, 1).over(w)) - F.lit(1.0)
    for n in windows:
        cols[f"ma{n}"] = _moving_average(price, n)
    if lead:
        cols[lead] = F.lead(price, 1).over(w)
    out = framed.withColumns(cols) if cols else framed
    out = out.filter(~F.col(HALO))
    if ret and fill_gaps:
        out = _filled_return(out, price, ret)
    return out.select(*bars.columns, *cols, *([ret] if ret and fill_gaps else []))


# ``sizes`` of the following are ``unit`` and ``block`` of sequence_views.


def daily_return(bars: DataFrame, price: str = "close", out: str = "ret", fill_gaps: bool = False, **sizes) -> DataFrame:
    return sequence_views(bars, price, ret=out, fill_gaps=fill_gaps, **sizes)


def moving_average(bars: DataFrame, n: int, price: str = "close", out: str | None = None, **sizes) -> DataFrame:
    df = sequence_views(bars, price, windows=[n], **sizes)
    return df.withColumnRenamed(f"ma{n}", out) if out and out != f"ma{n}" else df


def next_close(bars: DataFrame, price: str = "close", out: str = "next_close", **sizes) -> DataFrame:
    """The following row's price within the symbol; null on the last row."""
    return sequence_views(bars, price, lead=out, **sizes)


def with_indicators(bars: DataFrame, windows: Sequence[int] = (50, 200), price: str = "close", **sizes) -> DataFrame:
    """Return, moving averages and next close in one pass."""
    return sequence_views(bars, price, ret="ret", windows=windows, lead="next_close", **sizes)


def tail_rows(bars: DataFrame, n: int = 180, by: str = SYMBOL, unit: str = "month") -> DataFrame:
    """Last ``n`` rows per symbol by ``dt`` (rows without a date come first).

    The row counts per (symbol, ``unit`` segment) tell which segments hold the
    last ``n`` rows; only their rows are ranked. A symbol's window so sees at
    most ``n`` rows and one segment, however many rows and map tasks there are.
    ``bars`` is read for the counts and for the rows: materialise what is costly.
    """
    seg = "__seg"
    segmented = bars.withColumn(seg, _segment(unit))
    later = Window.partitionBy(by).orderBy(F.col(seg).desc()).rowsBetween(Window.unboundedPreceding, -1)
    needed = (
        segmented.groupBy(by, seg)
        .agg(F.count(F.lit(1)).alias("__cnt"))
        .withColumn("__later", F.coalesce(F.sum("__cnt").over(later), F.lit(0)))
        .filter(F.col("__later") < n)
        .select(by, seg)
        .repartition(by, seg)
    )
    w = Window.partitionBy(by).orderBy(F.col(DT).desc())
    return join_back(segmented, needed, [by, seg]).withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n).drop("__rn", seg)


def page(
    rows: DataFrame,
    page_no: int,
    per_page: int = 5,
    shift: int = 0,
    position: str = "row_no",
    unit: str = "month",
) -> DataFrame:
    """Rows ``(page_no-1)*per_page+1 .. page_no*per_page`` of each symbol in
    ``dt`` order, numbered from 1 in ``position``.

    ``shift=1`` moves the slice one row later, reproducing a display that
    labels rows 1-5 but shows rows 2-6 (so the first row is never shown and
    the last page is one short). Row numbers come from :func:`positions`, so
    no task holds a whole symbol.
    """
    if page_no < 1 or per_page < 1:
        raise ValueError("page_no and per_page must be >= 1")
    start = (page_no - 1) * per_page + shift
    numbered = positions(rows, unit).withColumn(position, F.col(POS).cast("int")).drop(POS, TOTAL)
    return numbered.filter((F.col(position) > start) & (F.col(position) <= start + per_page))


def page_info(rows: DataFrame, per_page: int = 5, by: str = SYMBOL) -> DataFrame:
    """Row count and number of pages per symbol."""
    n = F.count(F.lit(1))
    return rows.groupBy(by).agg(
        n.alias("total_rows"),
        (F.floor((n - 1) / per_page) + 1).cast("long").alias("total_pages"),
    )


def extremes(bars: DataFrame, by: str = SYMBOL) -> DataFrame:
    """Highest high and lowest low per symbol, also as ``$x.xx`` text."""
    return (
        bars.groupBy(by)
        .agg(F.max("high").alias("highest"), F.min("low").alias("lowest"))
        .withColumn("highest_txt", fmt_price("highest"))
        .withColumn("lowest_txt", fmt_price("lowest"))
    )


def close_matrix(bars: DataFrame, symbols: Sequence[str], price: str = "close") -> DataFrame:
    """Wide table: one row per date, one column per symbol.

    Pivot values are passed explicitly, so Spark does not run a job to find
    them; it is a single hash aggregate on ``dt``.
    """
    wanted = [normalize_symbol(s) for s in symbols]
    return bars.groupBy(DT).pivot(SYMBOL, wanted).agg(F.first(price, ignorenulls=True))
