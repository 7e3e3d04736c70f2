"""The corpus pipeline, stage by stage, on the supplied documents and planted ones."""

import itertools

import pytest

import corpus_pipeline
from tabsmith.llm import decontaminate, quality, simhash_dedup, toxicity
from tabsmith.llm.common import held_out, written

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """What every stage read and kept."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        kept = written(stage(spark, docs, SF), f"test-{name}")
        out.append((name, docs, kept))
        docs = kept
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages_are_those_asked_for(stages):
    assert [n for n, _, _ in stages] == ["quality", "toxicity", "simhash_dedup", "decontamination", "packing"]
    columns = stages[0][1].columns
    assert all(kept.columns == columns for _, _, kept in stages[:-1])


def test_filters_reject_what_their_models_reject(spark, stages):
    _, docs, kept = stages[0]
    model = quality.train(docs)
    assert set(texts(kept)) == {i for i, t in texts(docs).items() if model.predict(quality.look(t)) >= quality.THRESHOLD}
    _, docs, kept = stages[1]
    model = toxicity.train(docs, spark.read.parquet(f"{SF}/labels.parquet").filter(~held_out("doc_id")))
    assert set(texts(kept)) == {i for i, t in texts(docs).items() if toxicity.predict(model, [t])[0] < toxicity.THRESHOLD}


def test_filters_against_labels(spark, stages):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    (_, before, good), (_, _, clean) = stages[:2]
    good, clean = texts(good), texts(clean)
    judged = [labels[i] for i in texts(before) if i in labels]
    assert sum(r.doc_id in good for r in judged if r.quality == 1) >= 0.995 * sum(r.quality == 1 for r in judged)
    assert sum(r.doc_id in good for r in judged if r.quality == 0) <= 0.05 * sum(r.quality == 0 for r in judged)
    judged = [r for r in judged if r.doc_id in good]
    assert sum(r.doc_id in clean for r in judged if r.toxic == 0) >= 0.99 * sum(r.toxic == 0 for r in judged)
    assert sum(r.doc_id in clean for r in judged if r.toxic == 1) <= 0.15 * sum(r.toxic == 1 for r in judged)


def test_one_of_each_group_stays(stages):
    _, docs, kept = stages[2]
    prints = {i: int.from_bytes(simhash_dedup.fingerprint(t, 4), "big") for i, t in texts(docs).items()}
    up = {i: i for i in prints}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in itertools.combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    assert sorted(texts(kept)) == sorted({find(i) for i in prints})


def test_benchmark_passages_are_gone(spark, stages):
    _, docs, kept = stages[3]
    items = [decontaminate.normal(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before = texts(docs)
    leaking = {i for i, t in before.items() if any(item in decontaminate.normal(t) for item in items)}
    assert leaking and set(texts(kept)) == set(before) - leaking


def test_the_rest_is_packed_whole(stages):
    _, docs, kept = stages[4]
    pieces = kept.collect()
    assert {r.doc_id for r in pieces} == set(texts(docs))
    tokens, filled = {}, {}
    for r in pieces:
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert all(tokens[r.doc_id] == r.doc_tokens for r in pieces)
    assert all(n <= 4096 and n & (n - 1) == 0 for n in filled.values())


def test_stages_on_empty_and_odd_tables(spark, docs_of):
    odd = [(1, None), (2, ""), (None, "no id"), (3, "x" * 100_000), (4, "same text here"), (4, "same text here"), (5, "same text here")]
    for rows in ([], odd):
        docs = docs_of(rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, docs, SF)
            assert kept.columns == docs.columns and kept.count() <= docs.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).select("doc_id").distinct().count() == len({i for i, _ in rows})


def test_run_applies_all_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF)
    want = stages[-1][2]
    assert got.columns == want.columns
    assert {r.doc_id: r.doc_tokens for r in got.collect()} == {r.doc_id: r.doc_tokens for r in want.collect()}
