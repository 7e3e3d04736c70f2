"""Quality: a weak-label model over heuristic labellers, and a hashed scorer.

Most labellers look at one trait of a text and vote bad or nothing; two vote
good or nothing, on traits that ordinary prose shares. They overlap and none is
right alone: expectation-maximisation over the counts of all documents' vote
patterns estimates how often each votes on either kind of document, and with
those the posterior of every pattern.
No labelled quality is used. The posteriors of a bounded sample then train a
logistic scorer over hashed word shapes, and that scorer's verdict counts.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice, pairwise
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import PayloadCache, arrow_table, map_batches, slices

CELLS = 1 << 12
MAX_TRAIN_ROWS = 20_000  # the texts whose posteriors the scorer is fitted on, at most
THRESHOLD = 0.5
BAD, GOOD = 0, 1

#: name: (bad above this, ordinary below this) for traits of which much is bad
LIMITS = {
    "symbols": (0.05, 0.02),  # share of characters that are neither letters, digits nor usual punctuation
    "repeats": (0.20, 0.05),  # share of words equal to the word before
    "shouting": (0.50, 0.20),  # share of words in capitals
    "lines": (0.30, 0.10),  # share of lines that repeat another
    "marks": (0.30, 0.05),  # share of words that end in a run of marks
    "bare": (0.20, 0.05),  # share of words without a letter or digit
    "sameness": (0.80, 0.65),  # share of words seen before in the text
    "length": (12.0, 8.0),  # mean word length
}
LABELLERS = [*LIMITS, "ordinary", "sentences"]
#: the share of words that end a sentence in prose
SENTENCES = (0.02, 0.35)
_USUAL = re.compile(r"[\w\s.,;:!?'\"()\-]")
_RUN = re.compile(r"[^\w\s]{2,}$")
_LETTERS = re.compile(r"[^\W\d_]+")


def _shape(word: str) -> int:
    """Cell of a word's shape: runs of letters as A or a, of digits as 0, marks as they are."""
    shape = _LETTERS.sub(lambda m: "A" if m[0].isupper() else "a", word)
    shape = re.sub(r"\d+", "0", shape)
    shape = re.sub(r"(.)\1+", r"\1\1", shape)[:16]
    return zlib.crc32(shape.encode()) % CELLS


def _describe(word: str) -> int:
    flags = (
        (len(word) > 1 and word.isupper())
        | bool(_RUN.search(word)) << 1
        | (not any(c.isalnum() for c in word)) << 2
        | (word[-1] in ".!?") << 3
    )
    return _shape(word) | flags << 12 | min(len(_USUAL.sub("", word)), 0xFFFF) << 16


#: the same for words of lower-case letters, by the mark that follows
_PLAIN = {mark: _describe("a" + mark) for mark in ("", *".,;:!?")}


def _payload(word: str) -> bytes:
    """One number per word: shape cell, four flags, symbols, length."""
    core, mark = (word[:-1], word[-1]) if word[-1] in ".,;:!?" else (word, "")
    number = _PLAIN[mark] if core.isalpha() and not core.isupper() else _describe(word)
    return (number | min(len(word), 0xFFFFFF) << 32).to_bytes(8, "little")


_cache = PayloadCache(_payload)


@dataclass
class Look:
    """What the labellers and the scorer see of a text."""

    words: int
    ends: float  # share of words that end a sentence
    traits: np.ndarray  # in the order of LIMITS
    cells: np.ndarray
    values: np.ndarray


def look(text: str) -> Look:
    words = text.split()
    n = len(words)
    if not n:
        return Look(0, 0.0, np.zeros(len(LIMITS)), np.array([CELLS - 1]), np.array([1.0]))
    packed = np.frombuffer(_cache.join(words), dtype=np.int64)
    lengths = packed >> 32
    lines = [s for line in text.split("\n") if (s := line.strip())]
    repeats = sum(map(eq, words, islice(words, 1, None))) / n
    same_lines = 1 - len(set(lines)) / len(lines)
    share = lambda bit: np.count_nonzero(packed & (1 << bit)) / n
    # long texts see their words again by nature: judged as if in pieces of about 200 words
    pieces = max(1, round(n / 200))
    cuts = [n * k // pieces for k in range(pieces + 1)]
    seen_before = 1 - np.mean([len(set(words[a:b])) / (b - a) for a, b in pairwise(cuts)])
    symbols = float(((packed >> 16) & 0xFFFF).sum() / max(1, lengths.sum()))
    traits = np.array([symbols, repeats, share(12), same_lines, share(13), share(14), seen_before, lengths.mean()])
    counts = np.bincount(packed & (CELLS - 1), minlength=CELLS)
    cells = np.flatnonzero(counts)
    counts = counts[cells]
    # traits as features of their own, beside the shapes
    own = (np.arange(len(LIMITS)) * 7919 + 13) % CELLS
    return Look(n, share(15), traits, np.concatenate([cells, own]), np.concatenate([counts / n, np.minimum(traits, 20) / [*[1] * (len(LIMITS) - 1), 10]]))


def votes(seen: Look) -> np.ndarray:
    """Whether each labeller votes; a text without words looks ordinary."""
    bad, ordinary = np.array(list(LIMITS.values())).T
    low, high = SENTENCES
    good = [(seen.traits < ordinary).all(), low <= seen.ends <= high]
    return np.concatenate([seen.traits > bad, good])


def pattern(seen: Look) -> int:
    return int((votes(seen) << np.arange(len(LABELLERS))).sum())


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> np.ndarray:
    """Posterior of good for each vote pattern, by expectation-maximisation.

    Votes are taken as independent given the kind of document. It begins with
    the belief that a labeller mostly votes on the kind it is made for.
    Without a document there is nothing to estimate.
    """
    voted = (patterns[:, None] >> np.arange(len(LABELLERS)) & 1).astype(float)
    chance = np.empty((2, len(LABELLERS)))  # of a vote, by kind
    chance[BAD] = [0.4] * len(LIMITS) + [0.3, 0.3]
    chance[GOOD] = [0.05] * len(LIMITS) + [0.85, 0.85]
    prior = 0.8
    good = np.ones(len(patterns))
    for _ in range(rounds if len(patterns) else 0):
        log = voted @ np.log(chance).T + (1 - voted) @ np.log(1 - chance).T
        z = log[:, GOOD] - log[:, BAD] + np.log(prior / (1 - prior))
        good = 1 / (1 + np.exp(-np.clip(z, -50, 50)))
        for kind, weight in ((GOOD, counts * good), (BAD, counts * (1 - good))):
            chance[kind] = (weight @ voted + 0.5) / (weight.sum() + 1)
        prior = float(np.clip(((counts * good).sum() + 1) / (counts.sum() + 2), 1e-3, 1 - 1e-3))
    return good


@dataclass
class Model:
    bias: float
    weights: np.ndarray  # (CELLS,)
    patterns: dict[int, float]  # posterior of good by vote pattern

    def predict(self, seen: Look) -> float:
        z = self.bias + float((self.weights[seen.cells] * seen.values).sum())
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], good: np.ndarray, epochs: int = 40, rate: float = 0.1, decay: float = 1e-5, batch: int = 64) -> tuple[float, np.ndarray]:
    """Logistic regression on soft labels, AdaGrad steps, a fixed random order."""
    rng = np.random.default_rng(3)
    bias, weights = 1.0, np.zeros(CELLS)
    seen_bias, seen = 1e-6, np.full(CELLS, 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), batch):
            some = order[k : k + batch]
            cells = np.concatenate([rows[j][0] for j in some])
            x = np.concatenate([rows[j][1] for j in some])
            owner = np.repeat(np.arange(len(some)), [len(rows[j][0]) for j in some])
            z = bias + np.bincount(owner, weights=weights[cells] * x, minlength=len(some))
            error = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - good[some]
            used, inverse = np.unique(cells, return_inverse=True)
            step = np.bincount(inverse, weights=error[owner] * x, minlength=len(used)) + decay * len(some) * weights[used]
            seen[used] += step**2
            weights[used] -= rate * step / np.sqrt(seen[used])
            seen_bias += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(seen_bias)
    return bias, weights


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Vote patterns are counted over every document; the scorer is fitted on
    at most ``max_rows`` of them, those whose ids have the smallest hashes (one
    row per id, null ids left out). Without documents everything is good."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, int] = {}
        for batch in batches:
            for _, texts in slices(batch, "text"):
                for t in texts:
                    p = pattern(look(t))
                    found[p] = found.get(p, 0) + 1
        yield arrow_table({"pattern": list(found), "n": list(found.values())}, {"pattern": pa.int64(), "n": pa.int64()})

    counted = map_batches(rows.select("text"), count, "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n"))
    counted = sorted((r["pattern"], r["n"]) for r in counted.collect())  # at most 2 ** len(LABELLERS) rows
    patterns = np.array([p for p, _ in counted], dtype=np.int64)
    posterior = dict(zip(patterns.tolist(), estimate(patterns, np.array([n for _, n in counted], dtype=float)).tolist(), strict=True))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                seen = [look(t) for t in texts]
                good = [posterior[pattern(x)] for x in seen]
                columns = {"id": part.column("id"), "good": good, "cells": [s.cells for s in seen], "x": [s.values for s in seen]}
                yield arrow_table(columns, {"good": pa.float64(), "cells": pa.list_(pa.int64()), "x": pa.list_(pa.float64())})

    chosen = rows.filter("id is not null").select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(max_rows)
    sample = map_batches(rows.join(F.broadcast(chosen), "id"), describe, "id long, good double, cells array<bigint>, x array<double>")
    sample = sample.groupBy("id").agg(F.min(F.struct("good", "cells", "x")).alias("row")).select("id", "row.*").toArrow().to_pandas().sort_values("id")
    pairs = [(np.asarray(c, dtype=np.int64), np.asarray(x, dtype=float)) for c, x in zip(sample["cells"], sample["x"], strict=True)]
    bias, weights = fit(pairs, sample["good"].to_numpy())
    return Model(bias, weights, posterior)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, weak_score) of every row: the scorer's probability that
    the whole text is good, and the weak labels' own posterior (null for a
    pattern of votes that no document had when the model was trained).

    A null or wordless text is scored as empty: no labeller votes on it.
    Repeated rows each give their row; an empty table gives none; other columns
    are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                seen = [look(t) for t in texts]
                weak = [shared.value.patterns.get(pattern(x)) for x in seen]
                columns = {"doc_id": part.column("doc_id"), "score": [shared.value.predict(s) for s in seen], "weak_score": weak}
                yield arrow_table(columns, {"score": pa.float64(), "weak_score": pa.float64()})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, score double, weak_score double")


def good_documents(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more; the
    rows stay where they are. Null and empty texts are scored as texts without
    words; rows that repeat are judged alike; an empty table stays empty; columns
    of any name stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_col):
                yield part.filter(pa.array([shared.value.predict(look(t)) >= threshold for t in texts]))

    return map_batches(docs, run, docs.schema)
