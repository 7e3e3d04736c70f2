"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments, each read as a 23-bit word (short
ones padded with zeros). The Golay code [23, 12, 7] is perfect: every word has
one codeword within distance 3. A segment's keys are the indices of all
codewords within distance 4 of it: one, or six where the nearest is at 3. Two
words that differ in at most 2 bits have a word between them that is within 1
of both, and its nearest codeword is within 4 of both: they share a key.

With S segments and at most e differing bits, at most e // 3 segments differ in
3 bits or more, so at least S - e // 3 share a key; S is chosen so that this is
two or more. A bucket is therefore a pair of segments with a key for each
(24 bits in all), which finds every pair of fingerprints within e bits; each
find is verified by counting the differing bits.

Equal fingerprints are one node. Links found in a bucket leave their task only
as a spanning forest, and a bucket beyond ``BUCKET`` fingerprints is cut into
chunks that meet pairwise in separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.buckets import Forest, bounds, by_key, chunk_pairs, pair_groups, whole_buckets
from tabsmith.llm.common import arrow_table, map_batches, slices, written
from tabsmith.llm.components import connected_components
from tabsmith.session import materialize

BUCKET = 4096
_GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, generator of the Golay code


def _remainders() -> tuple[np.ndarray, np.ndarray]:
    """Remainders modulo the generator of all 12-bit words, and of those shifted by 12."""

    def remainder(word: int) -> int:
        while word.bit_length() > 11:
            word ^= _GENERATOR << (word.bit_length() - 12)
        return word

    return np.array([remainder(w) for w in range(1 << 12)]), np.array([remainder(w << 12) for w in range(1 << 11)])


_LOW, _HIGH = _remainders()


def _syndrome(words: np.ndarray) -> np.ndarray:
    return _LOW[words & 0xFFF] ^ _HIGH[words >> 12]


def _error_patterns() -> np.ndarray:
    """For every syndrome, the errors of weight 4 or less that leave it (at most
    six); -1 fills the rest."""
    errors = np.array([sum(1 << b for b in bits) for weight in range(5) for bits in combinations(range(23), weight)])
    table = np.full((1 << 11, 6), -1, dtype=np.int64)
    used = np.zeros(1 << 11, dtype=int)
    for error, syndrome in zip(errors, _syndrome(errors), strict=True):
        table[syndrome, used[syndrome]] = error
        used[syndrome] += 1
    return table


_ERRORS = _error_patterns()


def golay_keys(words: np.ndarray) -> np.ndarray:
    """Indices (12 bits) of the codewords within distance 4 of 23-bit words, one
    row per word; -1 where a word has fewer than six."""
    errors = _ERRORS[_syndrome(words)]
    return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


def bucket_keys(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(key, position of its fingerprint) for all keys of 64-bit fingerprints."""
    n = max(3, 2 + max_bits // 3)
    edges = np.linspace(0, 64, n + 1).round().astype(int)
    if max(np.diff(edges)) > 23:
        raise ValueError("a segment is longer than the code")
    parts = [golay_keys(((prints >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
    keys, rows = [], []
    for number, (p, q) in enumerate(combinations(range(n), 2)):
        both = (parts[p] >= 0)[:, :, None] & (parts[q] >= 0)[:, None, :]
        key = (number << 24) | (parts[p][:, :, None] << 12) | parts[q][:, None, :]
        keys.append(key[both])
        rows.append(np.nonzero(both)[0])
    return np.concatenate(keys), np.concatenate(rows)


def fingerprint(text: str, shingle: int) -> bytes:
    """SimHash over word shingles, as 8 big-endian bytes."""
    words = text.encode().lower().split()  # ASCII letters and ASCII white space only
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    digest = xxhash.xxh64_digest
    hashes = b"".join([digest(joined[a:b], 42) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)])
    bits = np.unpackbits(np.frombuffer(hashes, dtype=np.uint8).reshape(-1, 8), axis=1)
    return np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(bits)).tobytes()


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """(doc_id, fp long) of every row; a null or wordless text has fingerprint 0.
    With ``row_col`` that column too, as ``row`` long."""
    more = ["row"] if row_col else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                prints = np.frombuffer(b"".join([fingerprint(t, shingle) for t in texts]), dtype=">i8").astype(np.int64)
                yield arrow_table({"doc_id": part.column("doc_id"), "fp": prints} | {c: part.column(c) for c in more}, {"fp": pa.int64()})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), *[F.col(row_col).cast("long").alias(c) for c in more])
    return map_batches(rows, run, ", ".join(["doc_id long", "fp long", *[f"{c} long" for c in more]]))


def _close_pairs(keys: np.ndarray, prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs within ``max_bits`` in runs of equal keys; long runs as a spanning
    set of links instead of all pairs."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    starts, ends = bounds(keys)
    short = ends - starts <= 32
    size = np.where(short, ends - starts, 1)
    reach = np.repeat(np.where(short, ends, starts + 1), ends - starts)  # where a row's run ends
    at, step = np.flatnonzero(np.arange(len(keys)) + 1 < reach), 1
    while len(at) and step < size.max():
        near = np.bitwise_count(prints[at] ^ prints[at + step]) <= max_bits
        found.append((prints[at[near]], prints[at[near] + step]))
        step += 1
        at = at[at + step < reach[at]]
    for a, b in zip(starts[~short], ends[~short], strict=True):
        found.append(_spanning_links(prints[a:b], max_bits))
    if not found:
        return prints[:0], prints[:0]
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _spanning_links(prints: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is joined by links within ``max_bits``: each row is
    reached once and compared with those not yet reached."""
    left, right, todo = [], [], prints
    while len(todo):
        queue, todo = [todo[0]], todo[1:]
        while queue and len(todo):
            now = queue.pop()
            near = np.bitwise_count(todo ^ now) <= max_bits
            reached = todo[near]
            if len(reached):
                left.append(np.full(len(reached), now))
                right.append(reached)
                queue.extend(reached)
                todo = todo[~near]
    return (np.concatenate(left), np.concatenate(right)) if left else (prints[:0], prints[:0])


def _fresh_edges(left: np.ndarray, right: np.ndarray, forest: Forest) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.unique(np.stack([np.minimum(left, right), np.maximum(left, right)], axis=1), axis=0).view(np.int64)
    kept = [p for p in pairs.tolist() if forest.join(*p)]
    out = np.array(kept, dtype=np.int64).reshape(-1, 2)
    return out[:, 0], out[:, 1]


def link_fingerprints(prints: DataFrame, max_bits: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Distinct fingerprints ``fp`` -> edges (a, b) between fingerprints, which
    join exactly those that links of at most ``max_bits`` differing bits join."""
    longs = {"key": pa.int64(), "chunk": pa.int32(), "a": pa.int64(), "b": pa.int64()}

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("fp").to_numpy()
            for at in range(0, len(values), 2000):
                some = values[at : at + 2000]
                key, row = bucket_keys(some.view(np.uint64), max_bits)
                yield arrow_table({"key": key, "fp": some[row]}, {"key": pa.int64(), "fp": pa.int64()})

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for chunk, rows in whole_buckets(batches, bucket):
            key, fp = rows.column("key").to_numpy(), rows.column("fp").to_numpy()
            if chunk >= 0:
                yield arrow_table({"key": key, "chunk": np.full(len(key), chunk), "a": fp, "b": fp}, longs)
                continue
            a, b = _fresh_edges(*_close_pairs(key, fp.view(np.uint64), max_bits), forest)
            yield arrow_table({"key": np.zeros(len(a), dtype=np.int64), "chunk": np.full(len(a), -1), "a": a, "b": b}, longs)

    def verify_large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for rows in pair_groups(batches):
            a, b = _fresh_edges(*_spanning_links(rows.column("a").to_numpy().view(np.uint64), max_bits), forest)
            yield arrow_table({"a": a, "b": b}, {"a": pa.int64(), "b": pa.int64()})

    keyed = map_batches(prints.select("fp"), keys, "key long, fp long")
    found = materialize(map_batches(by_key(keyed), verify, "key long, chunk int, a long, b long"))
    large = map_batches(chunk_pairs(found.filter("chunk >= 0")), verify_large, "a long, b long")
    return found.filter("chunk < 0").select("a", "b").unionByName(large)


def _rooted(prints: DataFrame, first: Column, max_bits: int, bucket: int) -> DataFrame:
    """(fp, first, root) of every fingerprint: ``first`` over its rows, and the
    fingerprint that names its component."""
    nodes = materialize(prints.groupBy("fp").agg(first.alias("first")))
    roots = connected_components(link_fingerprints(nodes, max_bits, bucket))
    # both sides of the joins on root are written tables, of which adaptive execution splits a hot root
    return materialize(nodes.join(roots.toDF("fp", "root"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root")))


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text", bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) of every row: documents whose fingerprints are
    joined by links of at most ``max_bits`` bits share a component, named by its
    smallest id.

    Repeated rows and equal texts share a fingerprint and so a component. A
    null or wordless text has fingerprint 0, linked like any other. A null id
    keeps its row; it names a component only as null, where all ids are null.
    An empty table gives no rows; other columns are ignored.
    """
    prints = materialize(fingerprints(docs, shingle, id_col, text_col))
    rooted = _rooted(prints, F.min("doc_id"), max_bits, bucket)
    named = materialize(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    names = materialize(rooted.join(named, "root").select("fp", "component_id"))
    return prints.join(names, "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without all but one row of each component: the one with the
    smallest id, and of several with that id the first as written. Rows are told
    apart by their place in a written copy of ``docs``, so rows that repeat an
    id stay where their texts are not near. All columns stay, and so do rows
    without an id, of which none is known to be another's copy."""
    row = "near_duplicates_row"
    while row.lower() in map(str.lower, docs.columns):  # no column of the caller's
        row += "_"
    rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "simhash")
    prints = fingerprints(rows, shingle, id_col, text_col, row)
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "row")))
    kept = _rooted(prints, first, max_bits, BUCKET).groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.row").alias(row))
    known = rows.join(kept, row, "left_semi")
    return known.unionByName(rows.filter(F.col(id_col).isNull())).select(*docs.columns)
