"""Packing documents into fixed-length sequences along a space-filling curve.

Each document becomes a hashed vector of its token counts, projected at random
to four dimensions; its place on a Hilbert curve through that space is its sort
key, so neighbours on the curve are similar documents. Documents are laid end
to end in curve order and cut every ``length`` ids. Only the end of the whole
run is shorter than ``length``: it is cut into sequences of descending powers
of two, which need no padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import arrow_table, hash32, map_batches, slices, written
from tabsmith.llm.tokens import as_u32, encoder
from tabsmith.session import materialize

HASHED, DIMS, BITS = 512, 4, 15  # DIMS * BITS must stay below 64

PIECE_SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"


def project(counts: np.ndarray) -> np.ndarray:
    """Points of documents, each coordinate in [0, 2**BITS), from their hashed
    signed counts. The random directions are fixed, and so is the scale (a
    normal distribution's own), so a point depends on its document alone."""
    weights = np.sign(counts) * np.sqrt(np.abs(counts))
    norm = np.linalg.norm(weights, axis=1, keepdims=True)
    directions = np.random.default_rng(7).standard_normal((counts.shape[1], DIMS))
    x = np.divide(weights, norm, out=np.zeros_like(weights), where=norm > 0) @ directions
    unit = 0.5 + 0.5 * np.tanh(0.8 * x)  # close to the normal distribution function
    return np.minimum((unit * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position along the Hilbert curve of integer points (one row each):
    Skilling's transform to Gray-coded axes, then the axes' bits interleaved."""
    x = points.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    carry = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        carry ^= np.where((x[n - 1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= carry
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def pack(
    docs: DataFrame, tokenizer: str, length: int = 4096, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", special_as_text: bool = True
) -> DataFrame:
    """Pieces of documents in sequences (``PIECE_SCHEMA``; ``ids`` are
    little-endian unsigned 32-bit integers).

    Every id of every document, the end id included, lies in exactly one piece;
    a sequence's pieces fill it from offset 0 without gaps. A null text is
    empty and gives the end id alone. Equal ids and equal texts are separate
    documents (rows), side by side on the curve. An empty table gives no
    pieces; other columns are ignored.

    Each text is encoded once, into a scratch table. Only keys and lengths are
    range-sorted; the ids then join their places in one shuffle.
    ``special_as_text``: see ``tokens.Encoder``.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer, special_as_text)
        kind = enc.dtype if end_id < 1 << (8 * enc.dtype.itemsize) else np.dtype("<u4")
        mixed = hash32(np.arange(max(enc.n_ids, end_id) + 1))
        cell, sign = (mixed % HASHED).astype(np.int64), np.where(mixed & np.uint64(1 << 20), 1.0, -1.0)
        for batch in batches:
            for part, texts in slices(batch, "text", 2_000_000):
                ids = [np.frombuffer(data, dtype=enc.dtype) for data in enc.encode(texts)]
                counts = np.stack([np.bincount(cell[x], weights=sign[x], minlength=HASHED) for x in ids])
                columns = {
                    "doc_id": part.column("doc_id"), "curve": hilbert_key(project(counts)), "n": [len(x) + 1 for x in ids],
                    "ids": [np.append(x, kind.type(end_id)).astype(kind).tobytes() for x in ids], "width": [kind.itemsize] * len(ids),
                }
                yield arrow_table(columns, {"curve": pa.int64(), "n": pa.int64(), "ids": pa.binary(), "width": pa.int32()})

    def running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, total = TaskContext.get().partitionId(), 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            ends = total + np.cumsum(n)
            columns = {"row": batch.column("row"), "part": np.full(len(n), part), "local": ends - n, "ends": ends}
            yield arrow_table(columns, dict.fromkeys(columns, pa.int64()))
            total = int(ends[-1]) if len(n) else total

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    encoded = map_batches(rows, encode, "doc_id long, curve long, n long, ids binary, width int")
    encoded = written(encoded.withColumn("row", F.monotonically_increasing_id()), "pack")

    narrow = encoded.select("curve", "row", "n").repartitionByRange("curve", "row").sortWithinPartitions("curve", "row").select("row", "n")
    local = materialize(map_batches(narrow, running, "row long, part long, local long, ends long"))
    sizes = local.groupBy(F.col("part").alias("of")).agg(F.max("ends").alias("size"))  # a row per partition
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = sizes.select("of", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"), F.sum("size").over(every).alias("total"))
    places = local.join(bases, local.part == bases.of).select("row", (F.col("base") + F.col("local")).alias("place"), "total")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")}
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], dtype=f"<u{row['width']}")
                for start, stop, sequence, offset in cuts(row["place"], len(ids), row["total"], length):
                    out["doc_id"].append(row["doc_id"])
                    out["start"].append(start)
                    out["length"].append(stop - start)
                    out["doc_tokens"].append(len(ids))
                    out["sequence_id"].append(sequence)
                    out["offset"].append(offset)
                    out["ids"].append(as_u32(ids[start:stop]))
            yield arrow_table(out, dict.fromkeys(out, pa.int64()) | {"ids": pa.binary()})

    joined = encoded.join(places, "row").select("doc_id", "ids", "width", "place", "total")
    return map_batches(joined, cut, PIECE_SCHEMA)


def cuts(place: int, n: int, total: int, length: int) -> Iterator[tuple[int, int, int, int]]:
    """(start, stop, sequence, offset) of the pieces of ``n`` ids that begin at
    ``place`` of a run of ``total`` ids."""
    whole = total // length * length
    borders, at = [], whole  # of the sequences after the full ones
    while at < total:
        borders.append(at)
        at += 1 << ((total - at).bit_length() - 1)
    borders.append(total)
    at, tail = place, 0
    while at < place + n:
        if at < whole:
            sequence = at // length
            begin, stop = sequence * length, (sequence + 1) * length
        else:
            while borders[tail + 1] <= at:
                tail += 1
            sequence, begin, stop = whole // length + tail, borders[tail], borders[tail + 1]
        stop = min(stop, place + n)
        yield at - place, stop - place, sequence, at - begin
        at = stop
