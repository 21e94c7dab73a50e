"""Word vectors from counts against plain numpy, and a signal they have to carry."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import NaiveBayes

from crowdtape import plans
from crowdtape.operators.terms import agreement
from crowdtape.plans import word_vectors
from crowdtape.plans.word_vectors import CountVectorizer

SENTENCES = [
    "the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "one two three four five six seven",
    "the the the", "mat and log", "seven six five", "dog eats cat", "", "@you gone", "two cats", "three dogs",
]


def plain_pmi(texts, window=5):
    pairs = Counter()
    for text in texts:
        words = [w for w in text.split(" ") if w and not w.startswith("@")]
        for at, word in enumerate(words):
            for other in words[at + 1 : at + 1 + window]:
                pairs[word, other] += 1
                pairs[other, word] += 1
    total = Counter()
    for (word, _), n in pairs.items():
        total[word] += n
    whole = sum(total.values())
    found = {p: np.log(n * whole / total[p[0]] / total[p[1]]) for p, n in pairs.items()}
    return {p: x for p, x in found.items() if x > 0}


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(t,) for t in [*SENTENCES, None]], "text string")


def test_pmi_and_vectors_are_those_of_numpy(spark, texts):
    expected = plain_pmi(SENTENCES)
    table = plans.positive_pmi(plans.cooccurrences(texts))
    got = {(r.word, r.context): r.pmi for r in table.collect()}
    assert got == pytest.approx(expected)
    words = sorted({w for p in expected for w in p})
    matrix = np.array([[expected.get((a, b), 0.0) for b in words] for a in words])
    values = np.linalg.eigvalsh(matrix)
    largest = values[np.argsort(-np.abs(values))][:6]
    found = {r.word: r.vector for r in plans.fit_word_vectors(texts, size=6, least=1, steps=3).collect()}
    vectors = np.array([found[w] for w in words])
    # Columns are eigenvectors, scaled by the root of the eigenvalue's size.
    assert np.linalg.norm(vectors, axis=0) ** 2 == pytest.approx(np.abs(largest), rel=1e-3)
    for column, value in zip(vectors.T, largest, strict=True):
        assert np.abs(matrix @ column - value * column).max() < 0.02 * abs(value)


@pytest.mark.parametrize("shares", [1, 3])
def test_pairs_are_counted_in_shares_and_only_those_seen_often_are_kept(spark, texts, monkeypatch, shares):
    monkeypatch.setattr(word_vectors, "COUNT_PAIRS", 1)
    monkeypatch.setattr(word_vectors, "COUNT_PASSES", shares)
    pairs = Counter()
    for sentence in SENTENCES:
        words = [w for w in sentence.split(" ") if w and not w.startswith("@")]
        for at, word in enumerate(words):
            for other in words[at + 1 : at + 6]:
                pairs[word, other] += 1
                pairs[other, word] += 1
    found = plans.cooccurrences(texts, least=3)
    assert {(r.word, r.context): r.n for r in found.collect()} == {p: n for p, n in pairs.items() if n >= 3}
    # What is returned is read from the counted shares, and no pair is shuffled a second time.
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    expected = {p: x for p, x in plain_pmi(SENTENCES).items() if pairs[p] >= 3}
    assert {(r.word, r.context): r.pmi for r in plans.pair_information(texts, least=3).collect()} == pytest.approx(expected)


def test_vectors_do_not_follow_the_partitioning(spark, texts):
    runs = []
    for parts in (1, 16):
        found = plans.fit_word_vectors(texts.repartition(parts), size=5, least=1)
        runs.append({r.word: r.vector for r in found.collect()})
    assert runs[0].keys() == runs[1].keys()
    for word, vector in runs[0].items():
        assert runs[1][word] == pytest.approx(vector, abs=1e-8)


def test_means_scale_and_awkward_texts(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0])], "word string, vector array<double>")
    posts = spark.createDataFrame([(1, "a a b zz"), (1, "a"), (2, ""), (None, None)], "id int, text string")
    got = sorted(str((r.id, r.vector)) for r in plans.mean_vectors(posts, vectors, 2).collect())
    assert got == sorted(map(str, [(1, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (None, None)]))
    scaled = CountVectorizer(vectors, [0.0, 0.5], [0.5, 0.5]).transform(posts.filter("id = 1")).collect()
    assert sorted(tuple(r.features) for r in scaled) == [(1.0, 0.5), (1.0, 0.5)]
    none = spark.createDataFrame([], "text string")
    assert plans.fit_word_vectors(none, size=3).count() == 0


def test_a_planted_signal_reaches_the_classifier_and_a_shuffled_one_does_not(spark):
    rng = random.Random(4)
    groups = ["red rose tulip bloom leaf".split(), "wheel engine brake motor gear".split()]
    rows = [(float(n % 2), " ".join(rng.choices(groups[n % 2], k=7)), str(n)) for n in range(160)]
    accuracies = {}
    for shuffled in (False, True):
        labels = [r[0] for r in rows]
        if shuffled:
            rng.shuffle(labels)
        df = spark.createDataFrame([(c, *r[1:]) for c, r in zip(labels, rows, strict=True)], "label double, text string, id string")
        features = plans.fit_count_vectorizer(df, size=4).transform(df)
        model = NaiveBayes().fit(features.filter("int(id) < 120"))
        accuracies[shuffled] = agreement(model.transform(features.filter("int(id) >= 120"))).first().accuracy
    assert accuracies[False] > 0.9 and accuracies[True] < 0.75


def test_no_row_is_made_of_a_word_of_a_text_and_spent_tables_are_gone(spark, texts, monkeypatch):
    import os

    folders, kept = [], word_vectors.stored

    def recorded(df, purpose, *args, **options):
        out = kept(df, purpose, *args, **options)
        folders.extend({(purpose, os.path.dirname(f.removeprefix("file://"))) for f in out.inputFiles()})
        return out

    monkeypatch.setattr(word_vectors, "stored", recorded)
    vectors = plans.fit_word_vectors(texts, size=4, least=1)
    assert {purpose for purpose, folder in folders if os.path.exists(folder)} == {"vectors-words"}
    assert len(folders) > 8 and vectors.count() == 19
    posts = spark.createDataFrame([(str(n), "the cat sat on the mat") for n in range(50)], "id string, text string")
    plan = plans.mean_vectors(posts, vectors, 4)._jdf.queryExecution().executedPlan().toString()
    assert "sum(" not in plan and "_h1" not in plan  # once: a sum for each text and entry, and a join of the texts


def test_means_in_several_tasks_are_those_of_one(spark, monkeypatch):
    rng = random.Random(2)
    posts = spark.createDataFrame([(n % 30, " ".join(rng.choices("abcdefg", k=n % 9))) for n in range(60)] + [(1, None)] * 2, "id int, text string")
    vectors = spark.createDataFrame([(w, [float(n), rng.random()]) for n, w in enumerate("abcdef")], "word string, vector array<double>")
    runs = []
    for characters, words in ((10**6, 1 << 16), (100, 3)):
        monkeypatch.setattr(word_vectors, "MEAN_CHARACTERS", characters)
        monkeypatch.setattr(word_vectors, "MEAN_WORDS", words)
        runs.append(sorted(str((r.id, r.text, r.vector and [round(x, 9) for x in r.vector])) for r in plans.mean_vectors(posts, vectors, 2).collect()))
    assert runs[0] == runs[1] and len(runs[0]) == 62
    by_hand = {r.word: r.vector for r in vectors.collect()}
    for r in plans.mean_vectors(posts.filter("text <> ''"), vectors, 2).collect():
        every = [by_hand.get(w, [0.0, 0.0]) for w in r.text.split(" ")]
        assert r.vector == pytest.approx(list(np.mean(every, axis=0)))
