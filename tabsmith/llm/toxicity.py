"""Toxicity: a factorization machine over hashed terms.

Terms are a text's lower-cased words and their beginnings of 3 to 7 letters
(so that unseen forms of a known stem still count), hashed into ``CELLS``
cells; a term's value is its rate per hundred words. Learning keeps the
``TERMS`` cells that differ most between the labels (chi-squared over
documents) and fits

    z = w0 + sum w_i x_i + sum over i < j of <v_i, v_j> x_i x_j

by stochastic gradients: the pairwise part raises or lowers the score of terms
that occur together, which a linear score cannot.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabsmith.llm.common import PayloadCache, arrow_table, map_batches, slices

CELLS = 1 << 18
TERMS = 1000
FACTORS = 4
MAX_TRAIN_ROWS = 20_000  # the labelled rows a model is fitted on, at most
THRESHOLD = 0.7
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Model:
    cells: np.ndarray  # sorted cells of the kept terms
    bias: float
    linear: np.ndarray  # (terms,)
    factors: np.ndarray  # (terms, FACTORS)


def _payload(piece: str) -> bytes:
    """Cells of the terms of a piece without white space, behind its number of words."""
    words = _WORD.findall(piece.lower())
    terms = [t for w in words for t in (w, *("^" + w[:k] for k in range(3, min(len(w), 7) + 1)))]
    return np.array([-1] * len(words) + [zlib.crc32(t.encode()) % CELLS for t in terms], dtype=np.int32).tobytes()


_cache = PayloadCache(_payload)


def terms(text: str) -> tuple[np.ndarray, np.ndarray, int]:
    """(cells, how often each occurs, number of words) of a whole text."""
    cells, counts = np.unique(np.frombuffer(_cache.join(text.split()), dtype=np.int32), return_counts=True)
    if not len(cells):
        return cells, counts, 0
    return cells[1:], counts[1:], int(counts[0])  # the first is the mark of words


def features(text: str, kept: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(position among the kept cells, value) of the text's kept terms."""
    cells, counts, words = terms(text)
    at = np.searchsorted(kept, cells)
    at[at == len(kept)] = 0
    good = kept[at] == cells if len(kept) else np.zeros(len(cells), dtype=bool)
    return at[good], 100.0 * counts[good] / (words + 30)


def _scores(model: Model, at: np.ndarray, x: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(z, sums of factors per document, factors times values)."""
    vx = model.factors[at] * x[:, None]
    sums = np.stack([np.bincount(owner, weights=vx[:, f], minlength=n) for f in range(vx.shape[1])], axis=1)
    squares = np.bincount(owner, weights=(vx**2).sum(axis=1), minlength=n)
    z = model.bias + np.bincount(owner, weights=model.linear[at] * x, minlength=n) + 0.5 * ((sums**2).sum(axis=1) - squares)
    return z, sums, vx


def _joined(rows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    return np.concatenate([r[0] for r in rows]).astype(np.int64), np.concatenate([r[1] for r in rows]), owner


def _probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def predict(model: Model, texts: list[str]) -> np.ndarray:
    at, x, owner = _joined([features(t, model.cells) for t in texts])
    return _probability(_scores(model, at, x, owner, len(texts))[0])


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, cells: np.ndarray, epochs: int = 12, rate: float = 0.05, decay: float = 1e-4, batch: int = 64) -> Model:
    """Logistic loss, AdaGrad steps, a fixed random order."""
    rng = np.random.default_rng(5)
    share = np.clip(labels.mean() if len(labels) else 0.0, 1e-3, 1 - 1e-3)
    model = Model(cells, float(np.log(share / (1 - share))), np.zeros(len(cells)), rng.standard_normal((len(cells), FACTORS)) * 0.01)
    if len(set(labels.tolist())) < 2 or not len(cells):
        return model
    seen_bias, seen_linear, seen_factors = 1e-6, np.full(len(cells), 1e-6), np.full((len(cells), FACTORS), 1e-6)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), batch):
            some = order[k : k + batch]
            at, x, owner = _joined([rows[j] for j in some])
            z, sums, vx = _scores(model, at, x, owner, len(some))
            error = _probability(z) - labels[some]
            used, inverse = np.unique(at, return_inverse=True)
            step = np.bincount(inverse, weights=error[owner] * x, minlength=len(used)) + decay * len(some) * model.linear[used]
            seen_linear[used] += step**2
            pull = (error[owner] * x)[:, None] * (sums[owner] - vx)
            turn = np.stack([np.bincount(inverse, weights=pull[:, f], minlength=len(used)) for f in range(FACTORS)], axis=1)
            turn += decay * len(some) * model.factors[used]
            seen_factors[used] += turn**2
            seen_bias += error.sum() ** 2
            model.linear[used] -= rate * step / np.sqrt(seen_linear[used])
            model.factors[used] -= rate * turn / np.sqrt(seen_factors[used])
            model.bias -= rate * error.sum() / np.sqrt(seen_bias)
    return model


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_rows: int = MAX_TRAIN_ROWS) -> Model:
    """Fit on at most ``max_rows`` labelled ids, those with the smallest hashes.

    An id with several labels counts as toxic if one of them is; null labels
    and labels without a document teach nothing. Without both labels the model
    answers the share of toxic rows for every text. The chosen labels, bounded
    by ``max_rows``, are broadcast, so no text is shuffled.
    """
    key, label = F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")
    chosen = labels.select(key, label).filter("id is not null and label is not null").groupBy("id").agg(F.max("label").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("id"), "id").limit(max_rows)
    texts = docs.select(key, F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id").select("id", "label", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros((2, CELLS), dtype=np.int64)
        rows = [0, 0]
        for batch in batches:
            for part, some in slices(batch, "text"):
                for label, text in zip(part.column("label").to_pylist(), some, strict=True):
                    found[int(label > 0), terms(text)[0]] += 1
                    rows[int(label > 0)] += 1
        cell = np.flatnonzero(found.any(axis=0))
        columns = {"cell": np.append(cell, -1), "clean": np.append(found[0, cell], rows[0]), "toxic": np.append(found[1, cell], rows[1])}
        yield arrow_table(columns, dict.fromkeys(columns, pa.int64()))

    counts = map_batches(texts, count, "cell long, clean long, toxic long").groupBy("cell").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counts = counts.filter("cell < 0 or clean + toxic >= 4").toArrow().to_pandas()  # at most CELLS + 1 rows
    total, counts = counts[counts.cell < 0], counts[counts.cell >= 0]
    kept = select_terms(counts.cell.to_numpy(), counts.clean.to_numpy(), counts.toxic.to_numpy(), int(total.clean.sum()), int(total.toxic.sum()))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, some in slices(batch, "text"):
                rows = [features(t, kept) for t in some]
                columns = {"id": part.column("id"), "label": part.column("label"), "at": [r[0] for r in rows], "x": [r[1] for r in rows]}
                yield arrow_table(columns, {"at": pa.list_(pa.int64()), "x": pa.list_(pa.float64())})

    rows = map_batches(texts, describe, "id long, label int, at array<bigint>, x array<double>")
    # one text per id keeps the bound where ids repeat
    rows = rows.groupBy("id").agg(F.min(F.struct("label", "at", "x")).alias("row")).select("id", "row.*")
    rows = rows.toArrow().to_pandas().sort_values("id")
    pairs = [(np.asarray(a, dtype=np.int64), np.asarray(x, dtype=float)) for a, x in zip(rows["at"], rows["x"], strict=True)]
    return fit(pairs, (rows["label"].to_numpy() > 0).astype(float), kept)


def select_terms(cells: np.ndarray, clean: np.ndarray, toxic: np.ndarray, n_clean: int, n_toxic: int) -> np.ndarray:
    """The ``TERMS`` cells of the highest chi-squared (with continuity
    correction) between occurrence and label, if above 6; sorted."""
    n = n_clean + n_toxic
    gap = np.maximum(np.abs(toxic * (n_clean - clean) - clean * (n_toxic - toxic)) - n / 2, 0.0)
    below = (toxic + clean).astype(float) * (n - toxic - clean) * n_clean * n_toxic
    chi = np.divide(n * gap**2, below, out=np.zeros(len(cells)), where=below > 0)
    order = np.lexsort((cells, -chi))[:TERMS]
    return np.sort(cells[order][chi[order] > 6])


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score) of every row: the probability that the whole text is
    toxic. A null text is scored as empty; repeated rows each give their row;
    an empty table gives none; other columns are ignored."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, "text"):
                yield arrow_table({"doc_id": part.column("doc_id"), "score": predict(shared.value, texts)}, {"score": pa.float64()})

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, "doc_id long, score double")


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below ``threshold``;
    the rows stay where they are. Null and empty texts are scored as texts
    without words; rows that repeat are judged alike; an empty table stays empty;
    columns of any name stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, text_col):
                yield part.filter(pa.array(predict(shared.value, texts) < threshold))

    return map_batches(docs, run, docs.schema)
