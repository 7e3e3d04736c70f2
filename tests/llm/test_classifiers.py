"""Toxicity, language and quality: held-out accuracy and edge cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsmith.llm import language, quality, queries, toxicity
from tabsmith.llm.common import held_out

SF = "/root/testdata/sf0.01"
EDGE = [(1, None), (2, ""), (3, " \n\t"), (4, "a"), (5, "12 34 !!"), (6, "x" * 200_000), (7, "word " * 30_000), (7, "word " * 30_000), (None, "text without an id")]


def test_held_out_is_crc32_of_the_id(spark):
    rows = spark.createDataFrame([(k,) for k in [*range(50), -3, 10**15, None]], "doc_id long").select("doc_id", held_out("doc_id").alias("h")).collect()
    assert [r.h for r in rows] == [r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in rows]


# --- toxicity ---------------------------------------------------------------------


def toy_toxic(n=300, seed=1):
    """Toxic where an insult meets a group word; either alone is clean."""
    rng = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        words = [rng.choice(["sun", "rain", "wind", "tree", "road", "house"]) for _ in range(30)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += ["vermin"] * 2 * insult + ["foreigners"] * 2 * group
        rng.shuffle(words)
        docs.append((k, " ".join(words)))
        labels.append((k, 1, int(insult and group)))
    return docs, labels


def test_factors_learn_what_words_mean_together(spark, docs_of):
    docs, labels = toy_toxic()
    model = toxicity.train(docs_of(docs[:200]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    scores = toxicity.predict(model, [t for _, t in docs[200:]])
    assert ((scores >= 0.5) == np.array([y for _, _, y in labels[200:]])).mean() >= 0.95
    flat = toxicity.Model(model.cells, model.bias, model.linear, np.zeros_like(model.factors))
    assert ((toxicity.predict(flat, [t for _, t in docs[200:]]) >= 0.5) == np.array([y for _, _, y in labels[200:]])).mean() < 0.95


def test_score_is_the_factorization_machine():
    rng = np.random.default_rng(0)
    kept = np.unique(toxicity.terms("alpha beta gamma alphabet beta")[0])
    model = toxicity.Model(kept, 0.3, rng.normal(size=len(kept)), rng.normal(size=(len(kept), toxicity.FACTORS)))
    for text in ("alpha beta", "beta beta gamma delta", "", "none of these"):
        at, x = toxicity.features(text, kept)
        z = 0.3 + sum(model.linear[i] * a for i, a in zip(at, x, strict=True))
        z += sum(model.factors[at[i]] @ model.factors[at[j]] * x[i] * x[j] for i in range(len(at)) for j in range(i + 1, len(at)))
        assert toxicity.predict(model, [text])[0] == pytest.approx(1 / (1 + np.exp(-z)))


def test_toxicity_on_held_out_documents(spark):
    got = queries.op2_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").filter("held_out AND quality = 1").toPandas()
    assert (got.predicted == (got.score >= 0.7)).all() and got.score.between(0, 1).all()
    assert got[got.predicted == 1].toxic.mean() >= 0.95 and got[got.toxic == 1].predicted.mean() >= 0.93


def test_toxicity_edge_cases(spark, docs_of):
    labels = spark.createDataFrame([(1, None, 1), (4, 1, 0), (4, 1, 1), (None, 1, 1), (99, 1, None)], "doc_id long, quality int, toxic int")
    docs = docs_of(EDGE)
    for model in (toxicity.train(docs, labels), toxicity.train(docs_of([]), labels), toxicity.train(docs, labels.limit(0))):
        got = toxicity.score(docs, model).collect()
        assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
        kept = toxicity.without_toxic(docs, model)
        assert kept.columns == docs.columns and kept.count() == sum(r.score < toxicity.THRESHOLD for r in got)
        assert toxicity.score(docs_of([]), model).count() == 0


def test_the_training_bound_holds(spark, docs_of, monkeypatch):
    docs, labels = toy_toxic(120)
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda rows, y, cells: seen.append(len(rows)) or toxicity.Model(cells, 0.0, np.zeros(len(cells)), np.zeros((len(cells), 4))))
    toxicity.train(docs_of([*docs, *docs[:50] * 3]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), max_rows=40)
    assert seen == [40]


# --- language ---------------------------------------------------------------------


def slow_grams(text):
    """Counts of hashed cells, n-gram by n-gram."""
    letters = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text)
    line = " " + " ".join(letters.split(" ")) + " "
    while "  " in line:
        line = line.replace("  ", " ")
    out = {}
    for n in language.ORDERS:
        for k in range(len(line) - n + 1):
            if line[k : k + n] == " ":
                continue
            h = 0
            for c in line[k : k + n]:
                h = (h * 0x01000193 + ord(c)) & 0xFFFFFFFF
            cell = ((h ^ n) * 0x9E3779B1 & 0xFFFFFFFF) >> 18
            out[cell] = out.get(cell, 0) + 1
    return out


def test_grams_match_a_plain_count():
    texts = ["Hello, Wörld!", "", "a", "12 3", "x\x00y", " lead  and trail ", "ÀÉ日本 İß", "\n\n"]
    cells, starts, letters = language.grams(texts)
    found = [{} for _ in texts]
    for cell in cells:
        for k, (a, b) in enumerate(zip(starts, [*starts[1:], len(cell)], strict=True)):
            for c in cell[a:b].tolist():
                if c < language.BUCKETS:
                    found[k][c] = found[k].get(c, 0) + 1
    assert found == [slow_grams(t) for t in texts]
    assert letters.tolist() == [sum(c.isalpha() for c in t) for t in texts]


def test_language_matches_plain_naive_bayes(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der hund und die katze", "de"), (3, "the house", "en"), (4, "das haus", "de"), (5, "no language", None), (6, None, "fr")]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(train)
    assert model.languages == ["de", "en"]
    counts = {k: {} for k in model.languages}
    for _, text, lang in rows[:4]:
        for cell, n in slow_grams(text).items():
            counts[lang][cell] = counts[lang].get(cell, 0) + n
    tests = ["the dog", "die katze und", "und the"]
    got = {r.doc_id: r for r in language.identify(spark.createDataFrame(list(enumerate(tests)), "doc_id long, text string"), model).collect()}
    for k, text in enumerate(tests):
        z = {}
        for lang in model.languages:
            total = sum(counts[lang].values()) + 0.5 * language.BUCKETS
            z[lang] = np.log(2) + sum(n * np.log((counts[lang].get(c, 0) + 0.5) / total) for c, n in slow_grams(text).items()) / len(language.ORDERS)
        best = max(z, key=z.get)
        assert got[k].lang_pred == best
        assert got[k].score == pytest.approx(1 / sum(np.exp(v - z[best]) for v in z.values()), rel=1e-4)


def test_language_on_held_out_documents(spark):
    got = queries.op4_language_id(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() >= 0.98 and got.score.between(0, 1).all()


def test_language_edge_cases(spark, docs_of):
    docs = docs_of(EDGE)
    model = language.train(docs)
    got = {(r.doc_id, r.lang_pred) for r in language.identify(docs, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (5, "und"), (4, "en"), (6, "en"), (7, "en"), (None, "en")} == got
    nothing = language.train(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, nothing).collect()} == {("und", 0.0)}
    assert language.identify(docs_of([]), model).count() == 0


def test_equal_languages_tie_to_the_first(spark):
    rows = [(1, "same text", "zz"), (2, "same text", "aa")]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    got = language.identify(spark.createDataFrame([(3, "same")], "doc_id long, text string"), model).first()
    assert got.lang_pred == "aa" and got.score == pytest.approx(0.5)


# --- quality ----------------------------------------------------------------------


def test_quality_against_labels_it_never_saw(spark):
    got = queries.op8_quality(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").toPandas()
    assert got[got.quality == 1].predicted.mean() >= 0.995 and got[got.quality == 0].predicted.mean() <= 0.05


def test_estimate_finds_the_accuracies_behind_votes():
    rng = np.random.default_rng(6)
    n, labellers = 20_000, len(quality.LABELLERS)
    good = rng.random(n) < 0.8
    chance = np.where(np.arange(labellers) < len(quality.LIMITS), 0.02, 0.9), np.where(np.arange(labellers) < len(quality.LIMITS), 0.45, 0.2)
    voted = np.where(good[:, None], rng.random((n, labellers)) < chance[0], rng.random((n, labellers)) < chance[1])
    patterns, which, counts = np.unique((voted << np.arange(labellers)).sum(axis=1), return_inverse=True, return_counts=True)
    posterior = quality.estimate(patterns, counts.astype(float))[which]
    assert ((posterior >= 0.5) == good).mean() >= 0.97


@pytest.mark.parametrize(
    "text,trait",
    [("a### b$$$ c%%% d&&&", "symbols"), ("the the the the", "repeats"), ("LOUD WORDS HERE NOW", "shouting"), ("x y\nx y\nx y", "lines"), ("no!! oh!! my!!", "marks"), ("a | b | c", "bare"), ("ab " * 40, "sameness"), ("x" * 50, "length")],
)
def test_each_labeller_votes_on_its_trait(text, trait):
    assert quality.votes(quality.look(text))[list(quality.LIMITS).index(trait)]


@pytest.mark.parametrize("n", [201, 299, 300, 499, 1099])
def test_sameness_sees_every_word(n):
    at = list(quality.LIMITS).index("sameness")
    words = [f"w{k}" for k in range(n)]
    assert quality.look(" ".join(words)).traits[at] == pytest.approx(0)
    for k in (0, 100, n // 2, n - 51):  # a run of one word, 50 times over
        assert quality.look(" ".join([*words[:k], *["same"] * 50, *words[k + 50 :]])).traits[at] > 0.03


def test_prose_is_ordinary():
    seen = quality.look("The wind came up from the sea, and the boats turned home. Nobody spoke of it again that year.")
    assert quality.votes(seen).tolist() == [False] * len(quality.LIMITS) + [True, True]


def test_quality_edge_cases(spark, docs_of):
    docs = docs_of(EDGE)
    model = quality.train(docs)
    got = quality.score(docs, model).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    kept = quality.good_documents(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.score >= quality.THRESHOLD for r in got)
    nothing = quality.train(docs_of([]))
    assert quality.score(docs_of([]), nothing).count() == 0
    assert quality.good_documents(docs, nothing).count() == len(EDGE)


def test_plain_words_are_described_as_any_other():
    for word in ("word", "Word", "word.", "word,", "word!", "WORD", "a", "A", "é", "日本", "x1", "it's", "...", "a.b", "wor-d"):
        number = int.from_bytes(quality._payload(word), "little")
        assert number == quality._describe(word) | len(word) << 32, word


def test_model_queries_return_their_columns(spark):
    assert queries.op2_toxicity(spark, "/root/testdata/sf0.001").columns == ["doc_id", "held_out", "score", "predicted"]
    out = queries.op4_language_id(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and out.filter(F.col("lang_pred").isNull()).count() == 0
