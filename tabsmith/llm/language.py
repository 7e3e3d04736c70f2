"""Language identification: multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased and everything but letters becomes a space; all 1- to
4-grams of the result are hashed into ``BUCKETS`` cells. The model is a matrix
of log-probabilities (languages x cells), broadcast with the scoring function;
a batch of texts is scored in numpy by gathering the rows of its n-grams and
summing them per text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import arrow_table, map_batches, slices

BUCKETS = 1 << 14
ORDERS = (1, 2, 3, 4)
MAX_LANGUAGES = 1000  # more learned values than this raise an error: the model is broadcast
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    log_prior: np.ndarray  # (languages,)
    log_prob: np.ndarray  # (BUCKETS, languages), float32


def _letters() -> np.ndarray:
    """For every code point its lower-case letter (if that is one code point),
    or a space if it is no letter."""
    table = np.full(0x110000, 32, dtype=np.uint32)
    for code in range(0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        c = chr(code)
        if c.isalpha():
            low = c.lower()
            table[code] = ord(low) if len(low) == 1 else code
    return table


_table: list[np.ndarray] = []


def grams(texts: list[str]) -> tuple[Iterator[np.ndarray], np.ndarray, np.ndarray]:
    """(cells of the n-grams, one array per order; where each text begins in
    those arrays; letters per text). Places without an n-gram, where it would
    reach past its text or is a space, have the cell ``BUCKETS``."""
    if not _table:
        _table.append(_letters())
    joined = "".join([f" {t} \x00" for t in texts])
    codes = _table[0][np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)]
    codes[np.cumsum([len(t) + 3 for t in texts]) - 1] = 0
    space = codes == 32
    space[1:] &= space[:-1]
    space[0] = False
    codes = codes[~space]  # one space between words and at each end of a text
    stops = np.flatnonzero(codes == 0)
    starts = np.concatenate([[0], stops[:-1] + 1])
    letters = np.add.reduceat((codes != 32) & (codes != 0), starts, dtype=np.int64)

    def cells() -> Iterator[np.ndarray]:
        padded = np.concatenate([codes, np.zeros(max(ORDERS), dtype=np.uint32)])
        rolled = np.zeros(len(codes), dtype=np.uint32)
        blocked = np.zeros(len(codes), dtype=bool)
        for n in range(1, max(ORDERS) + 1):
            new = padded[n - 1 : n - 1 + len(codes)]
            rolled = rolled * np.uint32(0x01000193) + new
            blocked = blocked | (new == 0)
            if n in ORDERS:
                cell = (((rolled ^ np.uint32(n)) * np.uint32(0x9E3779B1)) >> np.uint32(18)).astype(np.int32)
                cell[blocked | (codes == 32) if n == 1 else blocked] = BUCKETS
                yield cell

    return cells(), starts, letters


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Model:
    """Count the n-grams of every row with a language (all rows, in the tasks
    that read them) and sum the counts per language and cell. Rows without a
    language or a letter teach nothing."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        docs: dict[str, int] = {}
        for batch in batches:
            for part, texts in slices(batch, "text", 1_000_000):
                cells, starts, letters = grams(texts)
                names, which = np.unique(np.array(part.column("lang").to_pylist(), dtype=object).astype(str), return_inverse=True)
                width = BUCKETS + 1
                total = np.zeros(len(names) * width, dtype=np.int64)
                for cell in cells:
                    base = np.repeat(which * width, np.diff(np.append(starts, len(cell))))
                    total += np.bincount(base + cell, minlength=len(total))
                for k, name in enumerate(names.tolist()):
                    some = total[k * width : (k + 1) * width - 1]
                    counts[name] = counts[name] + some if name in counts else some.copy()
                    docs[name] = docs.get(name, 0) + int(((which == k) & (letters > 0)).sum())
        for name, some in counts.items():
            cell = np.flatnonzero(some)
            columns = {"lang": [name] * (len(cell) + 1), "cell": np.append(cell, -1), "n": np.append(some[cell], docs[name])}
            yield arrow_table(columns, {"lang": pa.string(), "cell": pa.int32(), "n": pa.int64()})

    rows = labelled.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    sums = map_batches(rows, count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    sizes = sums.filter("cell = -1 and n > 0").select("lang", "n").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    docs = {r["lang"]: r["n"] for r in sizes}
    languages = sorted(docs)
    found = sums.filter(F.col("cell") >= 0).toArrow()  # at most MAX_LANGUAGES x BUCKETS numbers
    counts = np.zeros((BUCKETS, len(languages)))
    at = {name: k for k, name in enumerate(languages)}
    rows_of = np.array([at.get(name, -1) for name in found.column("lang").to_pylist()], dtype=np.int64)
    cell, n = found.column("cell").to_numpy(), found.column("n").to_numpy()
    counts[cell[rows_of >= 0], rows_of[rows_of >= 0]] = n[rows_of >= 0]
    counts += smoothing
    log_prob = np.log(counts) - np.log(counts.sum(axis=0, keepdims=True)) if languages else counts
    prior = np.log(np.array([docs[name] for name in languages], dtype=float))
    return Model(languages, prior, log_prob.astype(np.float32))


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score) of every row; the score is the posterior of the
    predicted language (n-gram orders overlap, so their evidence is averaged).

    A text that is null or has no letter, or any text if nothing was learned, is
    ``und`` with score 0. Of equally likely languages the first in
    alphabetical order wins. Whole texts are read, repeated rows each give
    their row, an empty table gives none, other columns are ignored.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        table = np.concatenate([m.log_prob, np.zeros((1, len(m.languages)), dtype=np.float32)])
        for batch in batches:
            for part, texts in slices(batch, "text", 1_000_000):
                cells, starts, letters = grams(texts)
                total = np.zeros((len(texts), len(m.languages)))
                for cell in cells:
                    for k in range(0, len(m.languages), 8):  # a few languages at a time bound the memory
                        total[:, k : k + 8] += np.add.reduceat(table[:, k : k + 8][cell], starts, axis=0)
                known = (letters > 0) & bool(m.languages)
                names, scores = np.full(len(texts), UNKNOWN, dtype=object), np.zeros(len(texts))
                if known.any():
                    z = total[known] / len(ORDERS) + m.log_prior
                    best = z.argmax(axis=1)
                    names[known] = np.array(m.languages, dtype=object)[best]
                    scores[known] = 1 / np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1)
                columns = {"doc_id": part.column("doc_id"), "lang_pred": names.tolist(), "score": scores}
                yield arrow_table(columns, {"lang_pred": pa.string(), "score": pa.float64()})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, score, "doc_id long, lang_pred string, score double")
