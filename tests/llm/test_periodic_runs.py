from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.llm import periodic_runs
from tabsmith.llm.periodic_runs import fragments_of, z_function


def brute_runs(words, least=6, times=4):
    """(start, length, period) of all runs, period by period."""
    found = {}
    for q in range(1, len(words) // times + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end - at + q >= max(least, times * q):
                found.setdefault((at, end - at + q), q)
            at = end + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def stitched(fragments):
    runs = []
    for q in {f[0] for f in fragments}:
        reach = None
        for a, b in [*sorted(f[1:] for f in fragments if f[0] == q), (1 << 60, 0)]:
            if reach and a <= reach[1]:
                reach[1] = max(reach[1], b)
                continue
            if reach and reach[1] - reach[0] + q >= max(6, 4 * q):
                runs.append((reach[0], reach[1] - reach[0] + q, q))
            reach = [a, b]
    return sorted(runs)


def random_document(rng, most=200):
    words = [rng.randrange(rng.choice([1, 2, 3, 50])) for _ in range(rng.randint(0, most))]
    for _ in range(rng.randint(0, 3) if words else 0):
        a = rng.randrange(len(words))
        q = rng.randint(1, max(1, len(words) // 4))
        for i in range(a, rng.randint(a, len(words))):
            words[i] = words[a + (i - a) % q]
    return words


def test_z_function_counts_equal_words():
    for words in ([], [1], [1, 1, 1], [1, 2, 1, 2, 1, 3], [0, 1, 0, 0, 1, 0]):
        expected = [next((k for k in range(len(words) - s) if words[k] != words[s + k]), len(words) - s) for s in range(len(words))]
        assert z_function(words) == expected


@pytest.mark.parametrize("tile", [(1, 1), (4, 1), (8, 2), (1024, 16)])
def test_stitched_tiles_equal_brute_force(tile, monkeypatch):
    monkeypatch.setattr(periodic_runs, "TILE_WORDS", tile[0])
    monkeypatch.setattr(periodic_runs, "TILE_BOUNDARIES", tile[1])
    rng = random.Random(sum(tile))
    for _ in range(150):
        docs = sorted((random_document(rng) for _ in range(rng.randint(1, 5))), key=len, reverse=True)
        found = fragments_of(np.array(sum(docs, []), dtype=np.int64), np.array([len(d) for d in docs]), 4)
        for words, fragments in zip(docs, found, strict=True):
            assert stitched(fragments) == brute_runs(words)


def test_runs_and_collapsed_texts(spark, docs_of):
    rng = random.Random(7)
    texts = [" ".join(f"w{x}" for x in random_document(rng, 400)) for _ in range(60)]
    texts += ["a b c " * 4000, "x " * 30000, "one \t two\n\x0bthree\x1cfour five " * 5, "a a a a a", "a a a a a a", "ab ab ab ab"]
    docs = docs_of(list(enumerate(texts)))
    rows = {r["doc_id"]: r for r in periodic_runs.periodic_runs(docs).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        words = text.encode().split()
        if len(words) > 5000:
            continue
        runs = brute_runs(words)
        assert [(r["start"], r["length"], r["period"]) for r in rows[i]["runs"]] == runs
        assert rows[i]["collapsed"] == collapsed([w.decode() for w in words], runs)
    assert rows[60]["collapsed"] == "a b c" and [tuple(r) for r in rows[60]["runs"]] == [(0, 12000, 3)]
    assert rows[61]["collapsed"] == "x" and rows[61]["runs"][0]["length"] == 30000
    assert [len(rows[i]["runs"]) for i in (63, 64, 65)] == [0, 1, 0]


def test_nulls_empty_texts_repeated_rows(spark, docs_of):
    docs = docs_of([(1, None), (1, ""), (None, "a a a a a a a"), (2, " \n "), (2, "b b b b b b c"), (2, "b b b b b b c")])
    found = [(r["doc_id"], len(r["runs"]), r["collapsed"]) for r in periodic_runs.periodic_runs(docs).collect()]
    assert sorted(found, key=str) == sorted([(1, 0, ""), (1, 0, ""), (None, 1, "a"), (2, 0, ""), (2, 1, "b c"), (2, 1, "b c")], key=str)
    assert periodic_runs.periodic_runs(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(docs, times=3)


def test_longest_compares_exact_quotients(spark):
    runs = [[(0, 7, 1), (9, 14, 2), (30, 29, 4)], [], [(5, 8, 2), (9, 29, 7)]]
    df = spark.createDataFrame([(r,) for r in runs], "runs array<struct<start:long,length:long,period:long>>")
    best = [r[0] for r in df.select(periodic_runs.longest(F.col("runs")).alias("b")).collect()]
    assert [b and tuple(b) for b in best] == [(30, 29, 4), None, (9, 29, 7)]
