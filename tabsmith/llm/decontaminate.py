"""Benchmark decontamination by pigeonhole edit matching.

Texts and items are lower-cased, and every run of other characters than
letters and digits becomes one space. An item of m characters may occur with up
to k = m * ``ERROR_RATE`` edits (rounded down). It is split into k + 1 pieces of
nearly equal length: k edits leave at least one piece whole. An automaton finds
every exact piece in a text; around each find, Myers' bit-parallel algorithm
computes the least edit distance between the item and any part of the text.

Chance finds of a piece are turned away early by the same principle: halve the
run of pieces again and again; of two halves with a and b pieces, one has less
than a or less than b edits, or the item had more than its budget. So some whole
piece has, on the way up to the item, only parts of n pieces with less than n
edits, and a find is dropped at the first part that has more.

Items are brought to the tasks in blocks of ``BLOCK_CHARS`` characters, one pass
over the texts for each, so what is broadcast is bounded for any benchmark.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import arrow_table, map_batches, slices

ERROR_RATE = 1 / 10
BLOCK_CHARS = 4_000_000
_OTHER = re.compile(r"[\W_]+")

SCHEMA = "doc_id long, item_id long, distance int, start long, stop long"


def normal(text: str) -> str:
    """Words with one space before, between and after them; empty without any."""
    words = _OTHER.sub(" ", text.lower()).strip()
    return f" {words} " if words else ""


def budget(item: str, error_rate: float = ERROR_RATE) -> int:
    return int(len(item) * error_rate)


def pieces(item: str, errors: int) -> list[tuple[int, str]]:
    """(offset, piece) of ``errors`` + 1 parts of the item, or as many as it has characters."""
    n = min(errors + 1, len(item))
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def above(n: int) -> list[list[tuple[int, int]]]:
    """For each of ``n`` pieces, the runs (first, last + 1) of pieces that hold
    it, from two pieces up to half of them all."""
    out: list[list[tuple[int, int]]] = [[] for _ in range(n)]
    runs = [(0, n)]
    while runs:
        a, b = runs.pop()
        if b - a > 1:
            if b - a < n:
                for k in range(a, b):
                    out[k].append((a, b))
            middle = (a + b) // 2
            runs += [(a, middle), (middle, b)]
    return [sorted(r, key=lambda x: x[1] - x[0]) for r in out]


def character_bits(item: str) -> dict[str, int]:
    """Bit i is set for the item's character i."""
    bits: dict[str, int] = {}
    for i, c in enumerate(item):
        bits[c] = bits.get(c, 0) | 1 << i
    return bits


def distance(item: str, text: str, bits: dict[str, int] | None = None) -> tuple[int, int]:
    """(least edit distance of the item to a part of the text, end of the first
    such part), by Myers' bit-vector algorithm: bit i of a column is about the
    item's first i + 1 characters."""
    m = len(item)
    ones, top = (1 << m) - 1, 1 << (m - 1)
    places = bits or character_bits(item)
    up, down, now = ones, 0, m
    best, end = m, 0
    for at, c in enumerate(text, 1):
        equal = places.get(c, 0)
        vertical = equal | down
        horizontal = (((equal & up) + up) ^ up) | equal
        plus = down | (ones & ~(horizontal | up))
        minus = up & horizontal
        if plus & top:
            now += 1
        elif minus & top:
            now -= 1
        plus, minus = plus << 1 & ones, minus << 1 & ones
        up = minus | (ones & ~(vertical | plus))
        down = plus & vertical
        if now < best:
            best, end = now, at
    return best, end


class Matcher:
    """The items of one block and the automaton of their pieces."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float):
        self.items = [(number, text, budget(text, error_rate)) for number, text in items]
        where: dict[str, list[tuple[int, int, int]]] = defaultdict(list)
        self.cuts: list[list[int]] = []  # offsets of each item's pieces, and its length
        self.above: dict[int, list[list[tuple[int, int]]]] = {}
        self.bits: dict[tuple[int, int, int], tuple[str, dict[str, int]]] = {}
        for at, (_, text, errors) in enumerate(self.items):
            parts = pieces(text, errors)
            self.cuts.append([o for o, _ in parts] + [len(text)])
            self.above.setdefault(len(parts), above(len(parts)))
            for k, (offset, piece) in enumerate(parts):
                where[piece].append((at, offset, k))
        self.automaton = ahocorasick.Automaton()
        for piece, found in where.items():
            self.automaton.add_word(piece, (len(piece), found))
        if where:
            self.automaton.make_automaton()
        self.empty = not where

    def _likely(self, text: str, at: int, begin: int, piece: int) -> bool:
        """Whether the runs of pieces around a whole one keep within their edits."""
        cuts = self.cuts[at]
        for a, b in self.above[len(cuts) - 1][piece]:
            if (at, a, b) not in self.bits:
                part = self.items[at][1][cuts[a] : cuts[b]]
                self.bits[at, a, b] = part, character_bits(part)
            part, bits = self.bits[at, a, b]
            errors = b - a - 1
            if distance(part, text[max(0, begin + cuts[a] - errors) : begin + cuts[b] + errors], bits)[0] > errors:
                return False
        return True

    def find(self, text: str) -> list[tuple[int, int, int, int]]:
        """(item, distance, start, stop) for each item that occurs within its
        budget; places are those of its best occurrence in the normalised
        text, the first of equals (its start is where the item would begin if
        it had no insertions or deletions)."""
        text = normal(text)
        if self.empty or not text:
            return []
        starts: dict[int, set[int]] = defaultdict(set)  # where an item would begin
        for end, (size, found) in self.automaton.iter(text):
            for at, offset, piece in found:
                begin = end + 1 - size - offset
                if begin not in starts[at] and self._likely(text, at, begin, piece):
                    starts[at].add(begin)
        out = []
        for at, begins in starts.items():
            if not begins:
                continue
            number, item, errors = self.items[at]
            best: tuple[int, int] | None = None
            for low, high in _clusters(sorted(begins), 2 * errors):
                if low == high and text.startswith(item, low if low >= 0 else len(text)):
                    score, stop = 0, low + len(item)
                else:
                    begin = max(0, low - errors)
                    score, stop = distance(item, text[begin : high + len(item) + errors])
                    stop += begin
                if score <= errors and (best is None or (score, stop) < best):
                    best = score, stop
            if best:
                out.append((number, best[0], max(0, best[1] - len(item)), best[1]))
        return out


def _clusters(begins: list[int], gap: int) -> Iterator[tuple[int, int]]:
    low = high = begins[0]
    for at in begins[1:]:
        if at - high > gap:
            yield low, high
            low = at
        high = at
    yield low, high


_last: list[tuple[list, float, Matcher]] = []


def _matcher(items: list[tuple[int, str]], error_rate: float) -> Matcher:
    """The automaton of a block; a worker process keeps the one it used last."""
    if not _last or _last[0][:2] != (items, error_rate):
        _last[:] = [(items, error_rate, Matcher(items, error_rate))]
    return _last[0][2]


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[list[tuple[int, str]]]:
    """Normalised items, ``BLOCK_CHARS`` at a time, read partition by partition."""
    block: list[tuple[int, str]] = []
    held = 0
    rows = benchmark.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).filter(F.col(text_col).isNotNull())
    for number, text in rows.toLocalIterator():
        item = normal(text)
        if item:
            block.append((number, item))
            held += len(item)
        if held >= BLOCK_CHARS:
            yield block
            block, held = [], 0
    if block:
        yield block


def contaminated(
    docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text",
    item_id_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row (``SCHEMA``) per document row and benchmark item that occurs in its
    whole text within the item's edit budget, with the least distance found.

    Items and texts without a letter or digit, null or empty, match nothing.
    Items match whole words only: their first and last space belong to them.
    Equal items each give their rows, and so do repeated documents. An empty
    table on either side gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def search(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared.value, error_rate)
            for batch in batches:
                for part, texts in slices(batch, "text"):
                    found = [(doc, *hit) for doc, t in zip(part.column("doc_id").to_pylist(), texts, strict=True) for hit in matcher.find(t)]
                    columns = dict(zip(("doc_id", "item_id", "distance", "start", "stop"), zip(*found, strict=True) if found else [[]] * 5, strict=True))
                    yield arrow_table(columns, dict.fromkeys(columns, pa.int64()) | {"distance": pa.int32()})

        return map_batches(rows, run, SCHEMA)

    found = [search(spark.sparkContext.broadcast(b)) for b in _blocks(benchmark, item_id_col, item_text_col)]
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], SCHEMA)


def without_contaminated(docs: DataFrame, benchmark: DataFrame, error_rate: float = ERROR_RATE, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which no benchmark item occurs; the
    rows stay where they are. A null or empty text holds no item, and neither does
    any text where the benchmark is empty or its items are null or blank; rows that
    repeat are judged alike; an empty table stays empty; columns of any name stay."""
    spark = docs.sparkSession

    def clean(frame: DataFrame, shared) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            matcher = _matcher(shared.value, error_rate)
            for batch in batches:
                for part, texts in slices(batch, text_col):
                    yield part.filter(pa.array([not matcher.find(t) for t in texts], type=pa.bool_()))

        return map_batches(frame, run, frame.schema)

    return reduce(clean, [spark.sparkContext.broadcast(b) for b in _blocks(benchmark, item_id_col, item_text_col)], docs)
