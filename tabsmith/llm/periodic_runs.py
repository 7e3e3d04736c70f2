"""Periodic runs of words, found in tiles of one scale each.

A run is a stretch of words with smallest period q that no neighbour extends;
runs of length ``max(least, times * q)`` and more are wanted. In terms of
matches ``w[i] == w[i + q]`` it is an unbroken stretch of ``length - q`` of them.

Documents are exploded into overlapping tiles, once per octave of periods
[P, 2P): tiles are as long as their octave asks for, so a document of n words has
about n / (16 P) of them. In a tile every P-th word is a boundary. A wanted run
keeps matching for 2P words from at least one of its boundaries, so fingerprints
of 2P words tell which boundaries can begin one with which period, and there the
Z-function of the words from the boundary gives the period itself: the shift at
which they meet themselves again, unless they are powers of a shorter word (then
a lower octave finds the run). Two shifts in one octave always mean such a power
(Fine and Wilf), so a boundary yields one fragment at most. Its matches are
followed to both sides up to the ends of the tile.

Tiles know nothing of each other. Fragments that a tile's end has cut are
shuffled by document and period and stitched where they touch; fragments of
which the tile has seen both ends and that are too short go at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabsmith.llm.common import arrow_table, map_batches, word_slices, written

#: Boundaries in a tile, and the words of the shortest tile.
TILE_BOUNDARIES, TILE_WORDS = 16, 1024

_SOLVED = "id long, words string, pure boolean, fragments array<struct<period:long,begin:long,end:long>>"
_FRAGMENT = pa.list_(pa.struct([("period", pa.int64()), ("begin", pa.int64()), ("end", pa.int64())]))
_RUNS = "array<struct<start:long,length:long,period:long>>"


def z_function(words: list) -> list[int]:
    """For every shift, how many words from there equal those from the beginning."""
    n = len(words)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for at in range(1, n):
        same = min(z[at - left], right - at) if at < right else 0
        while at + same < n and words[same] == words[at + same]:
            same += 1
        z[at] = same
        if at + same > right:
            left, right = at, at + same
    return z


def _period(window: list, least: int) -> int:
    """The one shift of ``least`` to ``2 * least - 1`` at which the words of a
    boundary's window meet themselves for ``2 * least`` words and are no power of
    a shorter word; 0 if there is none."""
    z = z_function(window)
    shifts = [q for q in range(least, min(2 * least, len(z))) if z[q] >= 2 * least]
    if len(shifts) != 1:
        return 0
    q = shifts[0]
    return 0 if any(q % j == 0 and z[j] >= q - j for j in range(1, q // 2 + 1)) else q


def _follow(words: np.ndarray, at: int, period: int, step: int) -> int:
    """Matches at ``period`` in a row from ``at`` on, to the right (step 1) or to
    the left (step -1), looked at in pieces that double."""
    last = len(words) - period
    found, size = 0, 64
    while True:
        begin, end = (at + found, min(last, at + found + size)) if step > 0 else (max(0, at - found - size), at - found)
        if begin >= end:
            return found
        equal = words[begin:end] == words[begin + period : end + period]
        if not equal.all():
            return found + int(np.argmin(equal if step > 0 else equal[::-1]))
        found += end - begin
        size *= 2


def tile_fragments(words: np.ndarray, boundaries: list[int], octave: int, first: bool, last: bool, times: int) -> list[tuple[int, int, int]]:
    """(period, begin, end) of the stretches of matches through a tile's
    ``boundaries``, by its own word numbers. ``first`` and ``last``: the tile
    begins or ends with its document, where a stretch is not cut."""
    found: list[tuple[int, int, int]] = []
    reach = {}
    for at in boundaries:
        if any(begin <= at and at + 2 * octave <= end for begin, end in reach.values()):
            continue  # on a stretch that is known, and no other can match as long here
        period = _period(words[at : at + 4 * octave].tolist(), octave)
        if not period:
            continue
        end = at + _follow(words, at, period, 1)
        begin = at - _follow(words, at, period, -1)
        reach[period] = (begin, end)
        cut = (begin == 0 and not first) or (end == len(words) - period and not last)
        if cut or end - begin >= (times - 1) * period:
            found.append((period, begin, end))
    return found


def fragments_of(numbers: np.ndarray, sizes: np.ndarray, times: int) -> list[list[tuple[int, int, int]]]:
    """Fragments of each of several documents, whose word numbers follow each
    other in ``numbers``, the longest document first."""
    found: list[list[tuple[int, int, int]]] = [[] for _ in sizes]
    # a word that equals no other behind every document, so that no match leaves one
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    words = np.empty(starts[-1], dtype=np.int64)
    ends = starts[1:] - 1
    inside = np.ones(len(words), dtype=bool)
    inside[ends] = False
    words[inside] = numbers
    words[ends] = -1 - np.arange(len(sizes))
    prints = words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    octave = 1
    while True:
        docs = int(np.searchsorted(-sizes, -times * octave, side="right"))  # long enough for a run
        total = int(starts[docs])
        if not docs or total < 4 * octave:
            return found
        # fingerprints of 2 * octave words from those of octave words
        prints = prints[:total]
        prints = prints[:-octave] * np.uint64(0xFF51AFD7ED558CCD) + prints[octave:]
        prints ^= prints >> np.uint64(29)
        # row j + 1 of the grid holds the shifts of the boundary that begins row j
        grid = np.concatenate([prints, np.zeros(-len(prints) % octave, dtype=np.uint64)]).reshape(-1, octave)
        equal = grid[1:] == grid[:-1, :1]
        equal.reshape(-1)[len(prints) - octave :] = False
        hits = np.flatnonzero(equal.sum(axis=1) == 1) * octave
        if len(hits):
            _solve_tiles(words, hits, starts, octave, times, found)
        octave *= 2


def _solve_tiles(words: np.ndarray, hits: np.ndarray, starts: np.ndarray, octave: int, times: int, found: list) -> None:
    core = max(TILE_BOUNDARIES * octave, TILE_WORDS)
    owner = np.searchsorted(starts, hits, side="right") - 1
    tile = (hits - starts[owner]) // core
    cuts = np.flatnonzero((np.diff(owner) != 0) | (np.diff(tile) != 0)) + 1
    for group in np.split(np.arange(len(hits)), cuts):
        doc, number = int(owner[group[0]]), int(tile[group[0]])
        base, size = int(starts[doc]), int(starts[doc + 1] - starts[doc] - 1)
        # The core and what its boundaries see: one octave before and five behind, so that a stretch
        # which leaves the tile has a boundary in the next.
        begin, end = max(0, number * core - octave), min(size, (number + 1) * core + 5 * octave)
        inner = (hits[group] - base - begin).tolist()
        for period, a, b in tile_fragments(words[base + begin : base + end], inner, octave, begin == 0, end == size, times):
            found[doc].append((period, begin + a, begin + b))


class _Numbers(dict):
    """Words numbered as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _solve(times: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, split in word_slices(batch, "text"):
                sizes = np.array([len(w) for w in split], dtype=np.int64)
                order = np.argsort(-sizes, kind="stable")
                numbers = _Numbers()
                flat = np.fromiter(map(numbers.__getitem__, chain.from_iterable(split[d] for d in order.tolist())), np.int64, int(sizes.sum()))
                lists: list = [None] * len(split)
                for doc, found in zip(order.tolist(), fragments_of(flat, sizes[order], times), strict=True):
                    lists[doc] = [{"period": p, "begin": a, "end": b} for p, a, b in found]
                columns = {
                    "id": part.column("id"), "words": pa.array([b" ".join(w) for w in split], type=pa.binary()).cast(pa.string()),
                    "pure": pa.array([not found for found in lists], type=pa.bool_()), "fragments": pa.array(lists, type=_FRAGMENT),
                }
                yield arrow_table(columns, {})

    return solve


def stitch(fragments: DataFrame, least: int, times: int) -> DataFrame:
    """(row, period, begin, end) of cut stretches -> (row, start, length, period)
    of runs: stretches of a row and period that touch or overlap become one, and
    those long enough are runs. Repeated fragments do no harm."""
    order = Window.partitionBy("row", "period").orderBy("begin", "end")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = fragments.withColumn("new", F.when(F.col("begin") <= before, 0).otherwise(1))
    joined = marked.withColumn("island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = joined.groupBy("row", "period", "island").agg(F.min("begin").alias("start"), F.max("end").alias("end"))
    runs = whole.select("row", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length"), "period")
    return runs.filter(F.col("length") >= F.greatest(F.lit(least), times * F.col("period")))


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, split in word_slices(batch, "words"):
            kept = []
            for words, runs in zip(split, part.column("runs").to_pylist(), strict=True):
                keep = np.ones(len(words), dtype=bool)
                for run in runs:
                    keep[run["start"] + run["period"] : run["start"] + run["length"]] = False
                kept.append(b" ".join(compress(words, keep.tolist())))
            collapsed = pa.array(kept, type=pa.binary()).cast(pa.string())
            yield arrow_table({"id": part.column("id"), "runs": part.column("runs"), "collapsed": collapsed}, {})


def periodic_runs(
    docs: DataFrame, least: int = 6, times: int = 4, id_col: str = "doc_id", text_col: str = "text",
    keep: Callable[[Column], Column] = lambda text: text,
) -> DataFrame:
    """(doc_id, runs, collapsed) of every row: all its periodic runs of
    ``max(least, times * period)`` words and more as an array of (start, length,
    period) by start and period, counted in words (stretches without ASCII white
    space), and its words joined by one space without those that a run repeats,
    that is any run's words but the first period.

    ``times`` is 4 or more (the boundaries' spacing relies on it). ``keep`` is
    applied to the collapsed text before it is stored: with a digest here the
    scratch copy holds whole texts only of documents with runs.

    A null or empty text has no words, no runs and an empty collapsed text.
    Repeated rows and ids are told apart by their place in the scratch copy and
    each get a row; a null id stays null. An empty table gives no rows; other
    columns are ignored, whatever their names. A document of any length is
    solved tile by tile; its words and one array of numbers are held.
    """
    if times < 4:
        raise ValueError("times must be 4 or more")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    solved = map_batches(rows, _solve(times), _SOLVED)
    solved = written(
        solved.select(
            F.monotonically_increasing_id().alias("row"), "id", "fragments",
            F.when(~F.col("pure"), F.col("words")).alias("words"), F.when(F.col("pure"), keep(F.col("words"))).alias("collapsed"),
        ),
        "periodic-runs",
    )
    runs = stitch(solved.select("row", F.inline("fragments")), least, times)
    listed = runs.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "period", "length"))).alias("found"))
    ordered = F.transform("found", lambda r: F.struct(r["start"].alias("start"), r["length"].alias("length"), r["period"].alias("period")))
    cut = solved.filter(F.col("words").isNotNull()).select("row", "id", "words").join(listed, "row", "left")
    none = F.array().cast(_RUNS)
    cut = cut.select("id", "words", F.coalesce(ordered, none).alias("runs"))
    with_runs = map_batches(cut, _collapse, f"id long, runs {_RUNS}, collapsed string")
    with_runs = with_runs.select(F.col("id").alias("doc_id"), "runs", keep(F.col("collapsed")).alias("collapsed"))
    return solved.filter(F.col("words").isNull()).select(F.col("id").alias("doc_id"), none.alias("runs"), "collapsed").unionByName(with_runs)


def longest(runs: Column) -> Column:
    """The run with the greatest length / period in an array ordered by start
    and period, the first of equals; null for an empty array. Products of whole
    numbers are compared, no quotients."""
    return F.aggregate(
        runs,
        F.get(runs, F.lit(0)),
        lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a),
    )
