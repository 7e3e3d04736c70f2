"""Token-id files compressed with a grammar (Re-Pair), readable at any position.

Documents are encoded whole, each ending with one end id, and laid down in
ascending id order. A file holds blocks of documents; every block has its own
grammar: rules that replace a frequent pair of symbols by a new one, applied
again and again, and the length that each rule expands to, so that a reader
can skip to any id without expanding what lies before it.

Differences from textbook Re-Pair, which replaces one pair at a time: each
round counts all pairs of a block and replaces up to ``PAIRS`` of the most
frequent ones together (where two overlap, the more frequent one wins), for
``ROUNDS`` rounds. No pair reaches over the end of a document.

File format: Parquet, one row per block, columns as in ``BLOCK_SCHEMA``.
Symbols and rules are little-endian unsigned 32-bit integers (16-bit if all
symbols of the block fit); symbol ``n_terminals + k`` is rule ``k``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabsmith.llm.common import arrow_table, map_batches, slices
from tabsmith.llm.tokens import Encoder, as_u32, encoder

ROUNDS = 6
PAIRS = 2048
MIN_COUNT = 8  # a rule must be used so often to be worth its place
BLOCK_IDS = 1_000_000  # a block is closed at the first document end after so many ids

BLOCK_SCHEMA = (
    "shard int, block int, first_id long, n_ids long, n_terminals int, doc_id array<bigint>, doc_length array<int>, "
    "symbols_per_doc array<int>, rules binary, rule_length array<int>, symbols binary, width int"
)


def compress(ids: np.ndarray, doc_lengths: np.ndarray, n_terminals: int, rounds: int = ROUNDS, pairs: int = PAIRS, min_count: int = MIN_COUNT):
    """(symbols, symbols per document, rules as an (n, 2) array, rule lengths)."""
    s = ids.astype(np.uint32)
    ends = np.cumsum(doc_lengths) - 1
    rules: list[np.ndarray] = []
    lengths = np.ones(n_terminals, dtype=np.int64)
    for turn in range(rounds):
        at, rank, made = _replaceable(s, ends, pairs, min_count, turn)
        if not len(made):
            break
        # where two replaceable pairs overlap, the more frequent one wins; in a run of one pair, the first
        overlap, order = np.diff(at) == 1, np.diff(rank)
        wins = np.ones(len(at), dtype=bool)
        wins[1:][overlap & (order >= 0)] = False
        wins[:-1][overlap & (order < 0)] = False
        at, rank = at[wins], rank[wins]
        s[at] = len(lengths) + rank
        keep = np.ones(len(s), dtype=bool)
        keep[at + 1] = False
        s, ends = s[keep], ends - np.searchsorted(at, ends)
        rules.append(made)
        lengths = np.concatenate([lengths, lengths[made[:, 0]] + lengths[made[:, 1]]])
    per_doc = np.diff(ends, prepend=-1)
    return s, per_doc, np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64), lengths[n_terminals:]


def _replaceable(s: np.ndarray, ends: np.ndarray, most: int, min_count: int, turn: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ascending places of the most frequent pairs, their rank by frequency, the pairs).

    Pairs are counted in hashed cells. A cell stands for the pair that last fell
    into it, nearly always its most frequent one, and that pair's own
    occurrences are then counted; a pair hidden by another has its chance in the
    next turn, which hashes otherwise.
    """
    bits = 18
    mixed = s[:-1] * np.uint32(0x9E3779B1 + 2 * turn)
    mixed ^= s[1:] * np.uint32(0x85EBCA6B + 2 * turn)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0xC2B2AE35)
    mixed >>= np.uint32(32 - bits)
    cell = mixed.astype(np.int64)
    cell[ends[:-1]] = 1 << bits  # no pair reaches over the end of a document
    filled = np.bincount(cell, minlength=(1 << bits) + 1)
    filled[-1] = 0
    sizes = np.bincount(np.minimum(filled, 1 << 16))
    enough = np.flatnonzero(np.cumsum(sizes[::-1])[::-1] <= most)  # fillings that at most so many cells reach
    full = filled >= max(min_count, int(enough[0]) if len(enough) else 1 << 16)
    at = np.flatnonzero(full[cell])
    cell, key = (np.cumsum(full) - 1)[cell[at]], s[at].astype(np.int64) << 32 | s[at + 1]
    owner = np.zeros(np.count_nonzero(full), dtype=np.int64)
    owner[cell] = key
    mine = owner[cell] == key
    at, cell = at[mine], cell[mine]
    counts = np.bincount(cell, minlength=len(owner))
    cells = np.flatnonzero(counts >= min_count)
    cells = cells[np.lexsort((owner[cells], -counts[cells]))]
    rank = np.full(len(owner), -1, dtype=np.int32)
    rank[cells] = np.arange(len(cells), dtype=np.int32)
    ranks = rank[cell]
    good = ranks >= 0
    return at[good], ranks[good], np.stack([owner[cells] >> 32, owner[cells] & 0xFFFFFFFF], axis=1)


def expand(symbols: np.ndarray, rules: np.ndarray, n_terminals: int) -> np.ndarray:
    """The ids that the symbols stand for."""
    made = _expand_by_level(np.arange(n_terminals, n_terminals + len(rules)), rules, n_terminals)
    flat = np.concatenate([np.arange(n_terminals), made]).astype(np.uint32)
    lengths = np.ones(n_terminals + len(rules), dtype=np.int64)
    for k, (a, b) in enumerate(rules.tolist(), n_terminals):
        lengths[k] = lengths[a] + lengths[b]
    offsets = np.cumsum(lengths) - lengths
    sizes = lengths[symbols]
    ends = np.cumsum(sizes)
    places = np.repeat(offsets[symbols] - ends + sizes, sizes)
    places += np.arange(len(places))
    return flat[places]


def _expand_by_level(s: np.ndarray, rules: np.ndarray, n_terminals: int) -> np.ndarray:
    """Replace rules by their pairs until none is left."""
    while (made := s >= n_terminals).any():
        place = np.cumsum(1 + made) - (1 + made)
        out = np.empty(len(s) + int(made.sum()), dtype=np.int64)
        rule = rules[s[made] - n_terminals]
        out[place[~made]] = s[~made]
        out[place[made]], out[place[made] + 1] = rule[:, 0], rule[:, 1]
        s = out
    return s


def read_range(block: dict, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` (counted within the block) of a block's row,
    expanding only the symbols that cover them."""
    symbols, rules = _unpack(block)
    lengths = np.concatenate([np.ones(block["n_terminals"], dtype=np.int64), np.asarray(block["rule_length"], dtype=np.int64)])
    ends = np.cumsum(lengths[symbols])
    a, b = np.searchsorted(ends, start, side="right"), np.searchsorted(ends, stop, side="left") + 1
    skipped = int(ends[a - 1]) if a else 0
    return expand(symbols[a:b], rules, block["n_terminals"])[start - skipped : stop - skipped]


def _unpack(block: dict) -> tuple[np.ndarray, np.ndarray]:
    kind = f"<u{block['width']}"
    return np.frombuffer(block["symbols"], dtype=kind).astype(np.int64), np.frombuffer(block["rules"], dtype=kind).astype(np.int64).reshape(-1, 2)


def _pack_block(shard: int, block: int, first: int, docs: list, parts: list[bytes], dtype, n_terminals: int, settings: dict) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(parts), dtype=dtype)
    lengths = np.array([len(p) // dtype.itemsize for p in parts], dtype=np.int64)
    symbols, per_doc, rules, rule_lengths = compress(ids, lengths, n_terminals, **settings)
    width = 2 if n_terminals + len(rules) <= 1 << 16 else 4
    row = {
        "shard": [shard], "block": [block], "first_id": [first], "n_ids": [len(ids)], "n_terminals": [n_terminals], "doc_id": [docs],
        "doc_length": [lengths.tolist()], "symbols_per_doc": [per_doc.tolist()], "rules": [rules.astype(f"<u{width}").tobytes()],
        "rule_length": [rule_lengths.tolist()], "symbols": [symbols.astype(f"<u{width}").tobytes()], "width": [width],
    }
    ints, longs = pa.int32(), pa.int64()
    types = {"first_id": longs, "n_ids": longs, "doc_id": pa.list_(longs), "rules": pa.binary(), "symbols": pa.binary()}
    lists = dict.fromkeys(("doc_length", "symbols_per_doc", "rule_length"), pa.list_(ints))
    return arrow_table(row, dict.fromkeys(row, ints) | types | lists)


def _blocks(batches: Iterator[pa.RecordBatch], enc: Encoder, shard: int, end_id: int, block_ids: int, settings: dict) -> Iterator[pa.RecordBatch]:
    """The blocks of one file. Texts are encoded in slices about as large as two
    blocks of English, since a word is looked up once a slice."""
    n_terminals = max(enc.n_ids, end_id + 1)
    kind = enc.dtype if end_id < enc.n_ids else np.dtype("<u4")
    end = np.array([end_id], dtype=kind).tobytes()
    block = first = held = 0
    ids: list = []
    parts: list[bytes] = []
    for batch in batches:
        for part, texts in slices(batch, "text"):
            for doc, data in zip(part.column("id").to_pylist(), enc.encode(texts), strict=True):
                ids.append(doc)
                parts.append((data if kind == enc.dtype else np.frombuffer(data, dtype=enc.dtype).astype(kind).tobytes()) + end)
                held += len(parts[-1]) // kind.itemsize
                if held >= block_ids:
                    yield _pack_block(shard, block, first, ids, parts, kind, n_terminals, settings)
                    block, first, held, ids, parts = block + 1, first + held, 0, [], []
    if ids:
        yield _pack_block(shard, block, first, ids, parts, kind, n_terminals, settings)


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text",
    block_ids: int = BLOCK_IDS, rounds: int = ROUNDS, pairs: int = PAIRS, min_count: int = MIN_COUNT, special_as_text: bool = True,
) -> None:
    """Encode every whole text and write it into grammar-compressed files.

    Rows are laid down by ascending ``id_col`` (null first; equal ids by their
    text), range-partitioned, so that a file is a contiguous run of documents.
    A null text is empty and gives the end id alone; an empty table gives an
    empty folder of Parquet without rows; other columns are ignored, whatever
    their names. A task holds the ids of one block and one slice of texts at a
    time, and one document. ``special_as_text``: see ``tokens.Encoder``.
    """
    settings = {"rounds": rounds, "pairs": pairs, "min_count": min_count}

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _blocks(batches, encoder(tokenizer, special_as_text), TaskContext.get().partitionId(), end_id, block_ids, settings)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("id", tie).sortWithinPartitions("id", tie, "text")
    map_batches(ordered, encode, BLOCK_SCHEMA).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per document, from the files alone: ``doc_id``, ``start`` (ids of
    all documents before it), ``n_tokens`` with the end id, and ``ids`` as
    little-endian unsigned 32-bit integers. A null or empty text comes back as its
    end id, repeated rows come back each, a null id as null; files without blocks
    give no rows; no column of the documents but the id is in the files."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                block = batch.slice(at, 1).to_pylist()[0]
                symbols, rules = _unpack(block)
                ids = as_u32(expand(symbols, rules, block["n_terminals"]))
                lengths = np.asarray(block["doc_length"], dtype=np.int64)
                ends = np.cumsum(lengths)
                places = pa.array(4 * np.append(0, ends), pa.int32()).buffers()[1]
                columns = {
                    "shard": np.full(len(lengths), block["shard"]), "doc_id": block["doc_id"], "local": block["first_id"] + ends - lengths,
                    "n_tokens": lengths, "ids": pa.BinaryArray.from_buffers(pa.binary(), len(lengths), [None, places, pa.py_buffer(ids)]),
                }
                types = dict.fromkeys(columns, pa.int64()) | {"shard": pa.int32(), "ids": pa.binary()}
                yield arrow_table(columns, types)

    blocks = read_blocks(spark, path)
    # one row per file, as many as the write had partitions: its ids, and those of all files before it
    sizes = blocks.groupBy(F.col("shard").alias("of")).agg(F.sum("n_ids").alias("size"))
    before = Window.orderBy("of").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("of", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("base"))
    found = map_batches(blocks, decode, "shard int, doc_id long, local long, n_tokens long, ids binary")
    return found.join(F.broadcast(starts), found.shard == starts.of).select("doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids")
