"""Exact removal of repeated passages by prefix-partitioned suffix trees.

A window is ``size`` words in a row. Wanted are the words of all windows that also
begin anywhere else. Two windows are equal exactly if the suffixes that begin
with them run down one path of the corpus' suffix tree for ``size`` words, so the
tree is needed to that depth only, and its internal nodes there are the repeats.

*Prefixes.* Windows are dealt to subtrees by a prefix of an anchored suffix: of the
``GRAM``-word sequences in a window the one with the least hash is its anchor, the
same in every copy. Neighbouring windows mostly share their anchor and travel as
one stretch of words, not as ``size`` words each.

*Pruning.* A prefix that occurs once in the corpus has no subtree. Stretches that
are alike word by word (told by a 128-bit digest) go as one with a count: all
their windows are repeats. Only prefixes followed or led by different words need a
subtree, and only one copy of each stretch is sent to it.

*Length.* A prefix with more than ``GROUP`` different stretches is too large for
one task's memory; its windows are dealt out anew by longer prefixes, the words
that seven neighbouring windows have in common, and where that is still too large
by all their words, where counting replaces the subtree.

*Subtrees.* A task builds many subtrees at once, from the root down, eight words a
step: a node's windows are parted by the names of their next eight words, and a
window that is alone in its node is a leaf and done. Windows that share a node at
depth ``size`` are repeats; where these overlap they make up a maximal repeat.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import arrow_table, map_batches, word_slices
from tabsmith.session import remove_path, scratch_path

GRAM = 8
#: Different stretches in one subtree, at most.
GROUP = 4096
#: Neighbouring windows that share a prefix when a subtree is too large.
SPLIT = 7

_OCCURRENCE = "a long, b int, pos int, n int, lead int, prefix long, content long"
_CONTENT = "struct<prefix:long,content:long,copies:long,contents:long,n:int,lead:int,words:string>"
_SPAN = "struct<start:long,length:long>"


class _Hashes(dict):
    """64-bit hashes of words, the same in every worker; starts anew when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 400_000:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def _join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return _mix(left * np.uint64(0x9E3779B97F4A7C15) + right)


def _spread(hashes: np.ndarray, width: int, join: Callable[[np.ndarray, np.ndarray], np.ndarray], overlap: bool) -> np.ndarray:
    """``join`` over every ``width`` neighbours, by doubling; the last step
    overlaps the one before, which hashing needs ``overlap`` to say is meant."""
    done = 1
    while done * 2 <= width:
        hashes = join(hashes[:-done], hashes[done:])
        done *= 2
    rest = width - done
    if rest and not overlap:
        raise ValueError("width must be a power of two")
    return join(hashes[:-rest], hashes[rest:]) if rest else hashes


def stretches(hashes: np.ndarray, sizes: np.ndarray, size: int) -> dict[str, np.ndarray]:
    """The windows of documents whose word hashes follow each other, as stretches
    of windows with one anchor: document, first window, windows, words of the
    first window before its anchor, and the digests of the anchor's words and of
    all words of the stretch."""
    starts = np.cumsum(sizes) - sizes
    none = np.zeros(0, dtype=np.int64)
    if len(hashes) < size:
        return dict.fromkeys(("doc", "first", "n", "lead", "prefix", "content"), none)
    grams = _spread(hashes, GRAM, _join, False)
    # order by 32 bits of the hash, and the leftmost of equals: the same in every copy of a window
    ranked = (_mix(grams) & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
    anchors = (_spread(ranked, size - GRAM + 1, np.minimum, True) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    room = np.repeat(starts + sizes, sizes)[: len(anchors)]
    at = np.flatnonzero(np.arange(len(anchors)) + size <= room)  # windows within their document
    if not len(at):
        return dict.fromkeys(("doc", "first", "n", "lead", "prefix", "content"), none)
    new = np.flatnonzero(np.concatenate([[True], (np.diff(anchors[at]) != 0) | (np.diff(at) != 1)]))
    first = at[new]
    n = np.diff(np.append(new, len(at)))
    doc = np.searchsorted(starts, first, side="right") - 1
    # digests of the first and the last window: together they hold every word
    whole = _spread(hashes, size, _join, True)
    content = _join(_join(whole[first], whole[first + n - 1]), n.astype(np.uint64))
    anchor = anchors[first]
    return {"doc": doc, "first": first - starts[doc], "n": n, "lead": anchor - first, "prefix": grams[anchor], "content": content}


def _occurrences(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            for part, split in word_slices(batch, "text"):
                sizes = np.array([len(w) for w in split], dtype=np.int64)
                hashes = np.fromiter(map(known.__getitem__, chain.from_iterable(split)), np.uint64, int(sizes.sum()))
                found = stretches(hashes, sizes, size)
                rows = pa.array(found["doc"])
                columns = {
                    "a": part.column("a").take(rows), "b": part.column("b").take(rows), "pos": pa.array(found["first"].astype(np.int32)),
                    "n": pa.array(found["n"].astype(np.int32)), "lead": pa.array(found["lead"].astype(np.int32)),
                    "prefix": pa.array(found["prefix"].view(np.int64)), "content": pa.array(found["content"].view(np.int64)),
                }
                yield arrow_table(columns, {})

    return occurrences


def _names(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Numbers for pairs of numbers: equal ones for equal pairs only."""
    return np.unique(left * (int(right.max(initial=0)) + 1) + right, return_inverse=True)[1]


def repeated_windows(groups: np.ndarray, texts: list[list[bytes]], windows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Subtrees of many groups at once: (row, window) of every window of a row that
    equals another window of its group. Row i has ``windows[i]`` windows, of its
    words ``texts[i]``."""
    numbers: dict[bytes, int] = {}
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    flat = np.array([numbers.setdefault(w, len(numbers)) for t in texts for w in t], dtype=np.int64)
    eight = flat
    for done in (1, 2, 4):
        eight = _names(eight[:-done], eight[done:])
    row = np.repeat(np.arange(len(texts)), windows)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    place = (np.cumsum(lengths) - lengths)[row] + offset
    node = np.unique(groups, return_inverse=True)[1][row]
    alive = np.arange(len(row))
    for depth in [*range(0, size - GRAM, GRAM), size - GRAM]:
        node = _names(node, eight[place[alive] + depth])
        inner = np.bincount(node)[node] > 1
        node, alive = node[inner], alive[inner]
        if not len(alive):
            break
    return row[alive], offset[alive]


def _subtrees(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows ordered by group -> (prefix, content, mask): which windows of a
    stretch, the lowest bit its first, are repeated. A group is never cut: the
    last one of a batch waits for the next."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        texts = [t.split() for t in table.column("words").cast(pa.binary()).to_pylist()]
        n, skip = table.column("n").to_numpy(), table.column("skip").to_numpy()
        row, window = repeated_windows(table.column("grp").to_numpy(), texts, n, size)
        masks = np.zeros(len(texts), dtype=np.int64)
        np.bitwise_or.at(masks, row, np.int64(1) << (window + skip[row]))
        hit = np.flatnonzero(masks)
        picked = table.select(["prefix", "content"]).take(pa.array(hit)).combine_chunks()
        return arrow_table({"prefix": picked.column("prefix").combine_chunks(), "content": picked.column("content").combine_chunks(), "mask": pa.array(masks[hit])}, {})

    def subtrees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = pa.concat_tables([held, table]) if held is not None else table
            groups = table.column("grp").to_numpy()
            cut = int(np.searchsorted(groups, groups[-1], side="left"))
            if cut:
                yield solve(table.slice(0, cut))
            held = table.slice(cut)
        if held is not None:
            yield solve(held)

    return subtrees


def _digest(words: list[bytes], seed: int) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words), seed=seed) - (1 << 63)


def _longer_prefixes(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each stretch cut into the windows whose anchor lies at ``SPLIT`` neighbouring
    places; the group is the digest of the words these windows share."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                words = r["words"].encode().split()
                for near in range((r["lead"] - r["n"] + 1) // SPLIT, r["lead"] // SPLIT + 1):
                    first = max(0, r["lead"] - near * SPLIT - SPLIT + 1)
                    last = min(r["n"] - 1, r["lead"] - near * SPLIT)
                    common = r["lead"] - near * SPLIT
                    rows.append((_digest(words[common : common + size - SPLIT + 1], near), r["prefix"], r["content"], first, last - first + 1, b" ".join(words[first : last + size]).decode()))
            names = ["grp", "prefix", "content", "skip", "n", "words"]
            kinds = dict.fromkeys(names, pa.int64()) | {"skip": pa.int32(), "n": pa.int32(), "words": pa.string()}
            yield arrow_table({c: [r[k] for r in rows] for k, c in enumerate(names)}, kinds)

    return parts


def _whole_windows(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for r in batch.to_pylist():
                words = r["words"].encode().split()
                for at in range(r["n"]):
                    window = words[at : at + size]
                    rows.append((_digest(window, 0), _digest(window, 1), r["prefix"], r["content"], 1 << (r["skip"] + at)))
            names = ["x", "y", "prefix", "content", "mask"]
            yield arrow_table({c: [r[k] for r in rows] for k, c in enumerate(names)}, dict.fromkeys(names, pa.int64()))

    return windows


def _repeats(contents: DataFrame, size: int, group: int) -> DataFrame:
    """(prefix, content, mask) of the different stretches of a prefix."""
    mask = "prefix long, content long, mask long"

    def solved(rows: DataFrame) -> DataFrame:
        wanted = rows.select("grp", "prefix", "content", "skip", "n", "words")
        return map_batches(wanted.repartition("grp").sortWithinPartitions("grp"), _subtrees(size), mask)

    small = contents.filter(F.col("contents") <= group).withColumns({"grp": F.col("prefix"), "skip": F.lit(0)})
    large = contents.filter(F.col("contents") > group).select("prefix", "content", "n", "lead", "words")
    parts, _ = _stored(map_batches(large, _longer_prefixes(size), "grp long, prefix long, content long, skip int, n int, words string"), "parts")
    counts, _ = _stored(parts.groupBy("grp").agg(F.count("*").alias("rows")).filter("rows > 1"), "groups")
    counted = parts.join(counts, "grp")
    windows, _ = _stored(map_batches(counted.filter(F.col("rows") > group).select("prefix", "content", "skip", "n", "words"), _whole_windows(size), "x long, y long, prefix long, content long, mask long"), "windows")
    alike, _ = _stored(windows.groupBy("x", "y").agg(F.count("*").alias("rows")).filter("rows > 1").select("x", "y"), "alike")
    found = solved(small).unionByName(solved(counted.filter(F.col("rows") <= group))).unionByName(windows.join(alike, ["x", "y"]).select("prefix", "content", "mask"))
    return found.groupBy("prefix", "content").agg(F.bit_or("mask").alias("mask"))


def _stored(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, f"substring-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _covered(n_words: int, size: int, known: list[dict], masks: list[dict]) -> np.ndarray:
    """Which words are in a repeated window: all windows of the stretches
    ``known`` are, and of those in ``masks`` the ones with their bit."""
    change = np.zeros(n_words + 1, dtype=np.int64)
    for stretch in known:
        change[stretch["pos"]] += 1
        change[stretch["pos"] + stretch["n"] + size - 1] -= 1
    for stretch in masks:
        mask, at = stretch["mask"], stretch["pos"]
        while mask:
            if mask & 1:
                change[at] += 1
                change[at + size] -= 1
            mask, at = mask >> 1, at + 1
    return np.cumsum(change)[:n_words] > 0


def _result(split: list[list[bytes]], covered: list[np.ndarray]) -> dict[str, pa.Array]:
    spans, kept = [], []
    for words, gone in zip(split, covered, strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
        spans.append([{"start": int(a), "length": int(b - a)} for a, b in zip(edges[::2], edges[1::2], strict=True)])
        kept.append(b" ".join([words[i] for i in np.flatnonzero(~gone)]) if spans[-1] else b" ".join(words))
    return {
        "n_words": pa.array([len(w) for w in split], type=pa.int64()), "n_removed": pa.array([int(g.sum()) for g in covered], type=pa.int64()),
        "removed": pa.array(spans, type=pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())]))), "kept": pa.array(kept, type=pa.binary()).cast(pa.string()),
    }


_RESULT = f"n_words long, n_removed long, removed array<{_SPAN}>, kept string"


def _first_look(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of every document: its result, if the stretches that are known to be
    repeated settle it, and the words of the stretches that subtrees ask for."""

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, split in word_slices(batch, "text"):
                known, contents, unsettled = [], [], []
                for words, info in zip(split, part.column("info").to_pylist(), strict=True):
                    info = info or []
                    known.append([s for s in info if s["copies"] > 1])
                    unsettled.append([{k: s[k] for k in ("pos", "prefix", "content")} for s in info if s["copies"] == 1])
                    asked = [s for s in info if s["asked"]]
                    contents.append([{**{k: s[k] for k in ("prefix", "content", "copies", "contents", "n", "lead")}, "words": b" ".join(words[s["pos"] : s["pos"] + s["n"] + size - 1])} for s in asked])
                result = _result(split, [_covered(len(w), size, k, []) for w, k in zip(split, known, strict=True)])
                wide = dict.fromkeys(("prefix", "content", "copies", "contents"), pa.int64()) | {"n": pa.int32(), "lead": pa.int32(), "words": pa.string()}
                place = [("pos", pa.int32()), ("prefix", pa.int64()), ("content", pa.int64())]
                columns = {
                    "id": part.column("id"), **result, "settled": pa.array([not o for o in unsettled], type=pa.bool_()),
                    "words": pa.array([b" ".join(w) if o else None for w, o in zip(split, unsettled, strict=True)], type=pa.binary()).cast(pa.string()),
                    "known": pa.array([[{"pos": s["pos"], "n": s["n"]} for s in k] if o else None for k, o in zip(known, unsettled, strict=True)], type=pa.list_(pa.struct([("pos", pa.int32()), ("n", pa.int32())]))),
                    "unsettled": pa.array(unsettled, type=pa.list_(pa.struct(place))), "contents": pa.array(contents, type=pa.list_(pa.struct(list(wide.items())))),
                }
                yield arrow_table(columns, {})

    return look


def _second_look(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, split in word_slices(batch, "words"):
                lists = zip(split, part.column("known").to_pylist(), part.column("masks").to_pylist(), strict=True)
                result = _result(split, [_covered(len(w), size, known or [], masks or []) for w, known, masks in lists])
                yield arrow_table({"id": part.column("id"), **result}, {})

    return look


def remove_repeats(
    docs: DataFrame, size: int = 35, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP,
    keep: Callable[[Column], Column] = lambda text: text,
) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, kept) of every row: its words
    (stretches without ASCII white space), how many of them a window of ``size``
    words covers that also begins elsewhere in the table, the same document
    included, these as an array of (start, length) by start, and the other words
    joined by one space. All windows are judged on the texts as they came.

    ``size`` is 17 to 64 or so (``GRAM`` words and their neighbours; masks have 63
    bits). ``keep`` is applied to the kept text before it is stored: with a digest
    here scratch copies hold whole texts only of documents that wait for a subtree.

    A null or empty text has no words and nothing to remove. Rows that repeat are
    different documents, so their windows repeat; rows alike in id and text share
    what is known of them. A null id stays null. An empty table gives no rows;
    other columns are ignored, whatever their names.

    Shuffled are the digests of stretches, the documents once, the words of
    different stretches with one prefix, and once more the documents that hold
    some of these. A prefix, stretch or text with a third of all rows is reduced
    by partial aggregates or lies on the side of a join that adaptive execution
    splits; no group is collected but a document's own stretches.
    """
    if not 2 * GRAM < size < 64 + GRAM:
        raise ValueError(f"size must be {2 * GRAM + 1} to {63 + GRAM}")
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumns({"a": F.xxhash64("id", "text"), "b": F.hash("text", "id")})
    spent = [""] * 4  # scratch tables that nothing reads any more once all documents are looked at
    occurrences, path = _stored(map_batches(rows.select("a", "b", "text"), _occurrences(size), _OCCURRENCE), "occurrences")
    # counts are written before they are joined back: a join of written tables is one whose hot keys are split
    frequent, spent[0] = _stored(occurrences.groupBy("prefix").agg(F.count("*").alias("rows")).filter("rows > 1").select("prefix"), "frequent")
    shared, spent[1] = _stored(occurrences.join(frequent, "prefix"), "shared")
    remove_path(spark, path)

    # one row per different stretch, with the place of one copy
    one, spent[2] = _stored(shared.groupBy("prefix", "content").agg(F.count("*").alias("copies"), F.min(F.struct("a", "b", "pos")).alias("copy")), "contents")
    several, spent[3] = _stored(one.groupBy("prefix").agg(F.count("*").alias("contents")), "prefixes")
    status = one.join(several, "prefix")
    mixed = F.col("contents") > 1
    told = shared.join(status, ["prefix", "content"])
    asked = mixed & (F.struct("a", "b", "pos") == F.col("copy"))
    open_ = F.col("copies") == 1
    only = lambda c: F.when(asked | open_, F.col(c)).alias(c)
    fact = F.struct("pos", "n", "copies", asked.alias("asked"), only("prefix"), only("content"), only("contents"), only("lead"))
    info = told.groupBy("a", "b").agg(F.collect_set(fact).alias("info"))
    looked = map_batches(
        rows.join(info, ["a", "b"], "left").select("id", "text", "info"), _first_look(size),
        f"id long, {_RESULT}, settled boolean, words string, known array<struct<pos:int,n:int>>, unsettled array<struct<pos:int,prefix:long,content:long>>, contents array<{_CONTENT}>",
    )
    looked = looked.withColumns({"row": F.monotonically_increasing_id(), "kept": F.when(F.col("settled"), keep(F.col("kept"))), "removed": F.when(F.col("settled"), F.col("removed"))})
    looked, _ = _stored(looked, "looked")
    for path in spent:
        remove_path(spark, path)

    # rows alike ask for the same stretches
    masks = _repeats(looked.select(F.inline("contents")).distinct(), size, group)
    waiting = looked.filter(~F.col("settled"))
    found = waiting.select("row", F.inline("unsettled")).join(masks, ["prefix", "content"])
    found = found.groupBy("row").agg(F.collect_list(F.struct("pos", "mask")).alias("masks"))
    rest = map_batches(waiting.select("row", "id", "words", "known").join(found, "row", "left").select("id", "words", "known", "masks"), _second_look(size), f"id long, {_RESULT}")
    columns = [F.col("id").alias("doc_id"), "n_words", "n_removed", "removed"]
    return looked.filter("settled").select(*columns, "kept").unionByName(rest.select(*columns, keep(F.col("kept")).alias("kept")))
