"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import weakref
import zipfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsmith.session import scratch_path

_shipped: weakref.WeakSet = weakref.WeakSet()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors once per context, so that the Python
    side of the operators can be imported there wherever they were started."""
    context = spark.sparkContext
    if context in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    package = os.path.join(root, "tabsmith")
    if os.path.isdir(package):
        target = os.path.join(tempfile.mkdtemp(prefix="tabsmith-ship-"), "tabsmith.zip")
        with zipfile.ZipFile(target, "w") as archive:
            for folder, _, names in os.walk(package):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        archive.write(path, os.path.relpath(path, root))
        context.addPyFile(target)
    _shipped.add(context)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """``mapInArrow`` after making sure that executors can import ``fn``."""
    ship(df.sparkSession)
    return df.mapInArrow(fn, schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared scratch folder and read it back.

    For wide intermediates that several later plans read: unlike a checkpoint
    the copy is columnar, so a reader of two columns does not read the others.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(id_col: str | Column) -> Column:
    """True for the rows no model may learn from: crc32 of the id as text,
    modulo 3, is 1. A null id is not held out."""
    key = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def slices(batch: pa.RecordBatch, text: str, max_chars: int = 4_000_000) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut a batch so that the texts handled at once stay near ``max_chars``
    (one text longer than that is still handled whole); null reads as empty."""
    texts = [t or "" for t in batch.column(text).to_pylist()]
    begin = size = 0
    for at, value in enumerate(texts):
        size += len(value)
        if size >= max_chars:
            yield batch.slice(begin, at + 1 - begin), texts[begin : at + 1]
            begin, size = at + 1, 0
    if begin < len(texts):
        yield batch.slice(begin), texts[begin:]


def word_slices(batch: pa.RecordBatch, text: str, max_bytes: int = 2_000_000) -> Iterator[tuple[pa.RecordBatch, list[list[bytes]]]]:
    """The same for texts that are wanted as lists of their words, the stretches
    without ASCII white space (``[^\\x20\\x09-\\x0D]+``), as UTF-8 bytes."""
    raw = batch.column(text).cast(pa.binary())
    lengths = pc.fill_null(pc.binary_length(raw), 0).to_pylist()
    begin = size = 0
    for at, length in enumerate(lengths):
        size += length
        if size >= max_bytes or at == len(lengths) - 1:
            part = batch.slice(begin, at + 1 - begin)
            yield part, [(value or b"").split() for value in raw.slice(begin, at + 1 - begin).to_pylist()]
            begin, size = at + 1, 0


def arrow_table(columns: dict[str, object], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    arrays = [v if isinstance(v, pa.Array) else pa.array(v, type=types[k]) for k, v in columns.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


#: The word caches of this worker process; the last is the one in use.
caches: list[dict] = []


def only(cache: dict) -> None:
    """Empty the other caches: a worker serves one operator after another, and
    must not hold the words of all of them."""
    if caches[-1] is not cache:
        for other in caches:
            if other is not cache:
                other.clear()
        caches[:] = [*(c for c in caches if c is not cache), cache]


class PayloadCache(dict):
    """Bytes per piece of text, made on first use.

    Operators describe every word as a few packed numbers; natural text repeats
    its words, so a worker looks most of them up. ``limit`` bounds the memory:
    a full cache starts anew.
    """

    def __init__(self, make: Callable[[str], bytes], limit: int = 300_000):
        super().__init__()
        self.make, self.limit = make, limit
        caches.append(self)

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.limit:
            self.clear()
        value = self.make(piece)
        if len(piece) < 64:
            self[piece] = value
        return value

    def join(self, pieces: Iterable[str]) -> bytes:
        only(self)
        return b"".join([self[p] for p in pieces])


def hash32(words: np.ndarray) -> np.ndarray:
    """A fixed 32-bit mix (multiply and xor-shift) of unsigned integers."""
    h = words.astype(np.uint64)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return (h ^ (h >> np.uint64(33))) & np.uint64(0xFFFFFFFF)
