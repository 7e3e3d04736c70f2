"""Embedding near-duplicates by spherical-cap filters.

Filter directions come from structured random product codes: after a random
rotation the vector is cut into two halves, each half has ``B`` random unit
vectors, and every combination of one from each half is a direction, B * B in
all. A vector belongs to the ``FILTERS`` filters of each code whose directions
have the largest inner products with it, so none is without filters at any
size; the product structure finds them without trying all, since they combine
the best of one half with the best of the other. Vectors that share a filter are
compared in double precision.

The number of directions grows with the number of vectors, so that a filter
holds ``FILL`` unrelated vectors on average at any size. As directions get
denser a pair shares a filter less often: the number of codes is set so that a
pair at cosine ``least`` shares none with probability ``MISS`` at most, from how
often made-up pairs share none in one code of that size. Codes are rotated
independently, so this holds for every pair, wherever it lies.

Exact copies are one node. A pair that shares several filters counts only in
the smallest of them, so link counts need no list of pairs: a task emits one row
per linked vector and filter. A filter beyond ``BUCKET`` vectors is cut into
chunks that meet pairwise in separate tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.buckets import bounds, by_key, chunk_pairs, pair_groups, whole_buckets
from tabsmith.llm.common import arrow_table, map_batches
from tabsmith.llm.components import connected_components
from tabsmith.session import materialize

FILTERS = 16  # a vector's filters in each code
FILL = 12  # unrelated vectors per filter, on average
MISS = 1e-5  # wanted probability that a pair at the least cosine shares no filter
PAIRS = 2000  # made-up pairs that the number of codes is taken from
MOST = 32  # codes; where more were needed, all vectors share one filter
WIDTH = 64  # least dimensions after padding: fewer would make directions too alike
BUCKET = 1024


class Codes:
    """The filter directions for ``n_vectors`` vectors of ``dim`` components,
    and as many codes as pairs at cosine ``least`` need."""

    def __init__(self, dim: int, n_vectors: int, least: float = 0.95):
        rng = np.random.default_rng(11)
        self.dim = max(WIDTH, dim + dim % 2)
        self.size = max(64, math.ceil(math.sqrt(FILTERS * max(n_vectors, 1) / FILL)))
        self.rotations, self.halves = [], []
        self._add(rng, dim)
        missed = (self._misses(least) + 1) / (PAIRS + 1)
        wanted = math.ceil(math.log(MISS) / math.log(missed)) if missed < 1 else MOST + 1
        if wanted > MOST:
            self.size, self.rotations, self.halves = 1, [], []
            self._add(rng, dim)
        while len(self.halves) < wanted <= MOST:
            self._add(rng, dim)

    def _add(self, rng: np.random.Generator, dim: int) -> None:
        self.rotations.append(np.linalg.qr(rng.standard_normal((self.dim, self.dim)))[0][:dim])
        codes = rng.standard_normal((2, self.size, self.dim // 2))
        self.halves.append(codes / np.linalg.norm(codes, axis=2, keepdims=True) / math.sqrt(2))

    def _misses(self, least: float) -> int:
        """How many of ``PAIRS`` random pairs at cosine ``least`` share no filter
        of the first code."""
        rng, cosine = np.random.default_rng(12), min(max(least, -1.0), 1.0)
        misses = 0
        for at in range(0, PAIRS, 250):
            one, two = np.moveaxis(np.linalg.qr(rng.standard_normal((min(250, PAIRS - at), self.dim, 2)))[0], 2, 0)
            near = cosine * one + math.sqrt(1 - cosine**2) * two
            shared = self._best(one, self.halves[0])[:, :, None] == self._best(near, self.halves[0])[:, None, :]
            misses += int((~shared.any(axis=(1, 2))).sum())
        return misses

    def _best(self, turned: np.ndarray, code: np.ndarray) -> np.ndarray:
        """For every row, the numbers of its best directions in one code."""
        half = self.dim // 2
        sides, k = [], min(FILTERS, self.size)
        for products in (turned[:, :half] @ code[0].T, turned[:, half:] @ code[1].T):
            top = np.argpartition(products, self.size - k, axis=1)[:, self.size - k :]
            sides.append((top, np.take_along_axis(products, top, axis=1)))
        (heads, one), (tails, two) = sides
        sums = (one[:, :, None] + two[:, None, :]).reshape(len(turned), k * k)
        best = np.argpartition(sums, k * k - k, axis=1)[:, k * k - k :]
        return np.take_along_axis(heads, best // k, axis=1) * self.size + np.take_along_axis(tails, best % k, axis=1)

    def decode(self, unit: np.ndarray) -> list[np.ndarray]:
        """For every unit vector, the sorted numbers of its filters."""
        found = [code * self.size**2 + self._best(unit @ rotation, halves) for code, (rotation, halves) in enumerate(zip(self.rotations, self.halves, strict=True))]
        return list(np.sort(np.hstack(found), axis=1))


def _units(rows: np.ndarray) -> np.ndarray:
    """Rows in double precision and of length 1."""
    x = rows.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _sharing(lists: list[np.ndarray]) -> np.ndarray:
    """Which rows share a number: products of 0/1 matrices, a bounded number of
    columns at a time."""
    shared = np.zeros((len(lists), len(lists)), dtype=bool)
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    numbers, column, counts = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
    common = np.cumsum(counts > 1) - 1  # a number of one row alone is no matter
    row, column = row[counts[column] > 1], common[column[counts[column] > 1]]
    for first in range(0, int((counts > 1).sum()), 2048):
        some = (column >= first) & (column < first + 2048)
        there = np.zeros((len(lists), 2048), dtype=np.float32)
        there[row[some], column[some] - first] = 1
        shared |= there @ there.T > 0
    return shared


def _compare(rows: pa.Table, dim: int, kind: str, least: float, across: np.ndarray | None = None) -> dict[str, np.ndarray] | None:
    """Links among the rows of one filter that count there: for each linked row
    its node, its number of linked vectors and a smaller node it is joined to.
    ``across``: two chunk numbers' sides; then only pairs between them."""
    unit = _units(np.frombuffer(b"".join(rows.column("vector").to_pylist()), dtype=kind).reshape(-1, dim))
    close = unit @ unit.T >= least
    np.fill_diagonal(close, False)
    if across is not None:
        close &= across[:, None] != across[None, :]
    left, right = np.nonzero(np.triu(close))
    if not len(left):
        return None
    new = ~_sharing([np.frombuffer(f, dtype=np.int64) for f in rows.column("before").to_pylist()])[left, right]
    left, right = left[new], right[new]
    if not len(left):
        return None
    node, copies = rows.column("node").to_numpy(), rows.column("copies").to_numpy()
    links = np.zeros(len(node), dtype=np.int64)
    np.add.at(links, left, copies[right])
    np.add.at(links, right, copies[left])
    root = node.copy()
    while True:  # the smallest node joined to each, passed on along the links
        now = root.copy()
        np.minimum.at(now, left, root[right])
        np.minimum.at(now, right, root[left])
        if (now == root).all():
            break
        root = now
    linked = links > 0
    return {"node": node[linked], "links": links[linked], "root": root[linked]}


def near_duplicate_vectors(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding", bucket: int = BUCKET) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row: the number of other
    vectors at cosine ``least`` or more that it links with, and the smallest id
    reachable by links, itself included.

    Cosines are taken in double precision, so no pair below ``least`` links; a
    pair above it is missed only if no filter holds both (see ``MISS``). Equal vectors always
    link. A vector that is null, empty, zero or with a null, NaN or infinite
    component links with nothing. Vectors of different lengths have no cosine;
    each length is searched by itself.
    Repeated rows are vectors of their own. A null id stays a row; its
    component is named by the smallest id that is not null, if any. An empty
    table gives no rows; other columns are ignored.
    """
    single = vectors.schema[vector_col].dataType.simpleString() == "array<float>"
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = materialize(rows.withColumn("row", F.monotonically_increasing_id()))
    finite = (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(finite, F.lit(False))
    # a node is a set of equal vectors; 0.0 and -0.0 are equal
    same = F.transform("v", lambda x: x + F.lit(0.0))
    nodes = rows.filter(usable).groupBy(same.alias("v")).agg(F.min("row").alias("node"), F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    nodes = materialize(nodes)
    lengths = sorted(map(tuple, nodes.groupBy(F.size("v").alias("dim")).count().collect()))  # a number for each different length
    kind = "<f4" if single else "<f8"
    by_length = [_links(nodes.filter(F.size("v") == dim), Codes(dim, n, least), dim, kind, least, bucket) for dim, n in lengths]
    none = vectors.sparkSession.createDataFrame([], "node long, links long, root long")
    found = reduce(lambda x, y: x.unionByName(y), by_length) if by_length else none

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    rooted = nodes.select("v", "node", "first", "copies").join(links, "node", "left").join(roots, "node", "left")
    # both sides of the join below are written tables, of which adaptive execution splits a hot root
    rooted = materialize(rooted.select("v", "first", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("root")))
    named = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    names = materialize(rooted.join(named, "root").select("v", "n_links", "component_id"))
    linked = rows.filter(usable).select("vec_id", same.alias("v")).join(names, "v").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~usable).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _links(nodes: DataFrame, codes: Codes, dim: int, kind: str, least: float, bucket: int) -> DataFrame:
    """(node, links, root) rows, from every filter that has links to count. A
    vector travels to its filters in the precision it came in (``kind``), with
    the numbers of its filters before that one."""
    longs = dict.fromkeys(("key", "node", "links", "root", "copies"), pa.int64()) | {"chunk": pa.int32(), "vector": pa.binary(), "before": pa.binary()}

    def filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                values = np.array(part.column("v").to_pylist(), dtype=np.float64)
                lists = codes.decode(_units(values))
                which = np.repeat(np.arange(len(values)), [len(x) for x in lists])
                vectors = pa.array([v.tobytes() for v in values.astype(kind)])
                columns = {
                    "key": np.concatenate(lists), "node": part.column("node").to_numpy()[which], "copies": part.column("copies").to_numpy()[which],
                    "vector": vectors.take(pa.array(which)), "before": [x[:k].tobytes() for x in lists for k in range(len(x))],
                }
                yield arrow_table(columns, longs)

    def empty(n: int) -> dict[str, object]:
        zeros = np.zeros(n, dtype=np.int64)
        return {"key": zeros, "chunk": zeros - 1, "node": zeros, "links": zeros, "root": zeros, "copies": zeros, "vector": [None] * n, "before": [None] * n}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, rows in whole_buckets(batches, bucket):
            key = rows.column("key").to_numpy()
            if chunk >= 0:
                same = {name: rows.column(name).combine_chunks() for name in ("key", "node", "copies", "vector", "before")}
                yield arrow_table(empty(len(key)) | {"chunk": np.full(len(key), chunk)} | same, longs)
                continue
            for a, b in zip(*bounds(key), strict=True):
                if b - a > 1 and (out := _compare(rows.slice(a, b - a), dim, kind, least)):
                    yield arrow_table(empty(len(out["node"])) | out, longs)

    def compare_large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in pair_groups(batches):
            one, two = rows.column("one")[0].as_py(), rows.column("two")[0].as_py()
            sides = None if one == two else rows.column("chunk").to_numpy()
            if out := _compare(rows, dim, kind, least, sides):
                yield arrow_table(out, longs)

    keyed = map_batches(nodes.select("node", "copies", "v"), filters, "key long, node long, copies long, vector binary, before binary")
    schema = "key long, chunk int, node long, links long, root long, copies long, vector binary, before binary"
    found = materialize(map_batches(by_key(keyed), compare, schema))
    chunks = found.filter("chunk >= 0").select("key", "chunk", "node", "copies", "vector", "before")
    large = map_batches(chunk_pairs(chunks), compare_large, "node long, links long, root long")
    return materialize(found.filter("chunk < 0").select("node", "links", "root").unionByName(large))
