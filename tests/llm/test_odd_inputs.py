"""Vectors of several lengths, and user columns named like the operators' own."""

from __future__ import annotations

import numpy as np

from tabsmith.llm import embedding_dedup, simhash_dedup


def test_unusable_vectors_do_not_decide_the_length(spark):
    near = [[1.0, 2.0, 3.0], [1.0, 2.0, 3.001]]
    rows = [(1, near[0]), (2, near[1]), (3, [None, 0.0, 0.0, 0.0, 0.0]), (4, [0.0] * 9), (5, None), (6, []), (7, [float("nan")] * 5)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {1: (1, 1), 2: (1, 1), 3: (0, 3), 4: (0, 4), 5: (0, 5), 6: (0, 6), 7: (0, 7)}


def test_each_length_is_searched_by_itself(spark):
    rng = np.random.default_rng(3)
    rows = []
    for dim in (2, 8, 64):
        for k in range(10):
            v = rng.normal(size=dim)
            rows += [(1000 * dim + 2 * k, v.tolist()), (1000 * dim + 2 * k + 1, (v * 2).tolist())]
    found = embedding_dedup.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), least=0.9999).collect()
    assert len(found) == 60 and all(r["n_links"] >= 1 and r["component_id"] // 1000 == r["vec_id"] // 1000 for r in found)
    big = [r for r in found if r["vec_id"] >= 64_000]
    assert all(r["n_links"] == 1 and r["component_id"] == r["vec_id"] // 2 * 2 for r in big)


def test_a_user_column_of_the_row_number_s_name_stays(spark):
    rows = [(1, "a b c d e f", 99, 5), (2, "a b c d e f", 98, 6), (3, "quite another text of words", 97, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, near_duplicates_row long, NEAR_DUPLICATES_ROW_ long")
    kept = simhash_dedup.near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
