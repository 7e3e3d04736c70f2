"""Rows sorted by a bucket key, handed to a task in whole buckets.

A bucket larger than ``limit`` rows is never held: its rows pass through as
numbered chunks of at most ``limit`` rows, and ``chunk_pairs`` later brings
every two chunks of the bucket together in a task of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def whole_buckets(batches: Iterator[pa.RecordBatch], limit: int, rows: int = 50_000) -> Iterator[tuple[int, pa.Table]]:
    """From batches sorted by ``key``: (-1, table of complete buckets of at most
    ``limit`` rows each), and (n, chunk n of a larger bucket)."""
    rest: pa.Table | None = None
    chunk = 0  # chunks already passed of the bucket that ``rest`` belongs to
    done: list[pa.Table] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        if rest is not None:
            now = pa.concat_tables([rest, now])
        keys = now.column("key").to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        sizes = np.diff(np.append(starts, len(keys)))
        last = starts[-1]
        begin = 0
        # the first bucket may have passed some chunks, the last may go on
        for at in np.flatnonzero((sizes > limit) | ((np.arange(len(sizes)) == 0) & (chunk > 0))):
            start, size, final = int(starts[at]), int(sizes[at]), at == len(sizes) - 1
            if start > begin:
                done.append(now.slice(begin, start - begin))
                held += start - begin
            if at or not chunk:
                chunk = 0
            while size > limit or (size and not final):
                yield chunk, now.slice(start, min(limit, size))
                chunk, start, size = chunk + 1, start + min(limit, size), size - min(limit, size)
            begin = start
            if not final:
                chunk = 0
        if last > begin:
            done.append(now.slice(begin, last - begin))
            held += last - begin
            begin = last
            chunk = 0
        rest = now.slice(begin)
        if held >= rows:
            yield -1, pa.concat_tables(done).combine_chunks()
            done, held = [], 0
    if rest is not None and rest.num_rows:
        if chunk:
            yield chunk, rest
        else:
            done.append(rest)
    if done:
        yield -1, pa.concat_tables(done).combine_chunks()


def bounds(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal keys."""
    if not len(keys):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return starts, np.append(starts[1:], len(keys))


def by_key(df: DataFrame) -> DataFrame:
    return df.repartition("key").sortWithinPartitions("key")


def chunk_pairs(chunks: DataFrame) -> DataFrame:
    """Chunk rows (key, chunk, ...) -> the same rows once for every two chunks
    of their bucket, as (key, one, two, ...) with one <= two, sorted by them."""
    counts = chunks.groupBy("key").agg((F.max("chunk") + 1).alias("n_chunks"))
    every = chunks.join(counts, "key").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
    paired = every.withColumn("one", F.least("chunk", "other")).withColumn("two", F.greatest("chunk", "other"))
    return paired.drop("other", "n_chunks").repartition("key", "one", "two").sortWithinPartitions("key", "one", "two")


def pair_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of one pair of chunks at a time, from ``chunk_pairs``."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        now = pa.Table.from_batches([batch])
        if rest is not None:
            now = pa.concat_tables([rest, now])
        ids = np.stack([now.column(c).to_numpy() for c in ("key", "one", "two")], axis=1)
        cut = np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1
        begin = 0
        for stop in cut:
            yield now.slice(begin, stop - begin).combine_chunks()
            begin = stop
        rest = now.slice(begin)
    if rest is not None:
        yield rest.combine_chunks()


class Forest(dict):
    """Union-find over the links that one task sees: a link that joins nothing
    new is not worth sending."""

    def find(self, x: int) -> int:
        while (up := self.get(x, x)) != x:
            self[x] = self.get(up, up)
            x = up
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self[max(a, b)] = min(a, b)
        return True
