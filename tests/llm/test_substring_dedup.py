from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from tabsmith.llm import substring_dedup
from tabsmith.llm.substring_dedup import remove_repeats, repeated_windows, stretches


def brute(texts, size=35):
    """[(n_words, n_removed, removed, kept)] of each text."""
    split = [(t or "").encode().split() for t in texts]
    windows = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for words in split:
        gone = set()
        for i in range(len(words) - size + 1):
            if windows[tuple(words[i : i + size])] > 1:
                gone.update(range(i, i + size))
        starts = [i for i in sorted(gone) if i - 1 not in gone]
        spans = [(s, next(k for k in range(s, len(words) + 1) if k not in gone) - s) for s in starts]
        out.append((len(words), len(gone), spans, b" ".join(w for i, w in enumerate(words) if i not in gone).decode()))
    return out


def texts_with_repeats(rng, n=60):
    """Random texts that share passages, some with a word changed, some whole."""
    word = lambda: f"w{rng.randrange(300)}"
    passages = [[word() for _ in range(rng.randint(30, 90))] for _ in range(4)]
    line = [word() for _ in range(9)]
    texts = []
    for _ in range(n):
        words = [word() for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            piece = list(rng.choice(passages))
            if rng.random() < 0.5:
                piece[rng.randrange(len(piece))] = "other"
            at = rng.randint(0, len(words))
            words[at:at] = piece if rng.random() < 0.6 else line
        texts.append(" ".join(words))
    return texts + texts[:5] + ["same " * 100, "a b " * 40]


def rows_of(found):
    return [(r["doc_id"], r["n_words"], r["n_removed"], [tuple(s) for s in r["removed"]], r["kept"]) for r in found.collect()]


@pytest.mark.parametrize("group", [1, 3, substring_dedup.GROUP])
def test_equals_brute_force(spark, docs_of, group):
    """Groups of one and three stretches send windows to all three lengths of prefix."""
    texts = texts_with_repeats(random.Random(group))
    found = rows_of(remove_repeats(docs_of(list(enumerate(texts))), group=group))
    assert sorted(found) == [(i, *r) for i, r in enumerate(brute(texts))]


@pytest.mark.parametrize("size", [17, 40])
def test_other_sizes(spark, docs_of, size):
    texts = texts_with_repeats(random.Random(size), 30)
    found = rows_of(remove_repeats(docs_of(list(enumerate(texts))), size=size, group=2))
    assert sorted(found) == [(i, *r) for i, r in enumerate(brute(texts, size))]


def test_white_space_and_case_are_as_stated(spark, docs_of):
    words = [f"w{i}" for i in range(40)]
    texts = [" ".join(words), "\t\n".join(words) + "\x0b", "\x1c".join(words), " ".join(words).upper(), " ".join(words)]
    assert [r[2] for r in sorted(rows_of(remove_repeats(docs_of(list(enumerate(texts))))))] == [40, 40, 0, 0, 0]


def test_nulls_repeated_rows_and_empty_tables(spark, docs_of):
    long = " ".join(f"x{i}" for i in range(50))
    docs = docs_of([(1, None), (1, ""), (None, long), (2, long + " y"), (3, "z " + long[:100]), (4, "once " * 34), (5, "q r s"), (5, "q r s"), (6, long), (6, long)])
    found = sorted(rows_of(remove_repeats(docs)), key=str)
    texts = [r["text"] for r in docs.collect()]
    ids = [r["doc_id"] for r in docs.collect()]
    assert found == sorted([(i, *r) for i, r in zip(ids, brute(texts), strict=True)], key=str)
    assert remove_repeats(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        remove_repeats(docs, size=10)


def test_stretches_cover_every_window_once():
    rng = np.random.default_rng(1)
    sizes = np.array([0, 34, 35, 100, 0, 62, 3])
    hashes = rng.integers(0, 1 << 63, int(sizes.sum())).astype(np.uint64)
    found = stretches(hashes, sizes, 35)
    seen = sorted((d, f + k) for d, f, n in zip(found["doc"], found["first"], found["n"], strict=True) for k in range(n))
    assert seen == [(d, k) for d, n in enumerate(sizes) for k in range(max(0, n - 34))]
    assert (found["lead"] >= 0).all() and (found["lead"] - found["n"] + 1 >= 0).all() and (found["lead"] <= 27).all()


def test_subtrees_keep_groups_apart():
    words = [b"%d" % i for i in range(40)]
    texts = [words, words, words, words[:35], words[1:36]]
    row, window = repeated_windows(np.array([1, 1, 2, 3, 3]), texts, np.array([6, 6, 6, 1, 1]), 35)
    assert sorted(zip(row.tolist(), window.tolist(), strict=True)) == [(r, w) for r in (0, 1) for w in range(6)]
