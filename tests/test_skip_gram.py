"""The tree of runs against a plain Huffman tree, learning against a plain loop, and vectors that follow the texts alone."""

from __future__ import annotations

import heapq
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from crowdtape import plans
from crowdtape.plans import mood, skip_gram


def plain_cost(leaves):
    heap, cost = sorted(leaves), 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@pytest.mark.parametrize("seed", range(12))
def test_runs_make_a_huffman_tree(seed):
    rng = random.Random(seed)
    classes = [(w, rng.randint(1, 9)) for w in rng.sample(range(1, 40), rng.randint(1, 12))]
    tree = skip_gram.huffman(*map(list, zip(*classes, strict=True)))
    run = np.concatenate([[r] * n for r, (_, n) in enumerate(classes)])
    place = np.concatenate([np.arange(n) for _, n in classes])
    leaf, node, bit = tree.paths(run, place)
    weight = np.array([classes[r][0] for r in run])
    assert weight[leaf].sum() == plain_cost([w for w, n in classes for _ in range(n)])
    paths = [frozenset(zip(node[leaf == i].tolist(), bit[leaf == i].tolist(), strict=True)) for i in range(len(run))]
    assert len(set(paths)) == len(run) and set(node.tolist()) == set(range(len(run) - 1))
    for i, a in enumerate(paths):  # any two leaves part at one node
        for b in paths[:i]:
            assert sum((n, 1 - s) in b for n, s in a) == 1


def test_learning_one_place_at_a_time_is_that_of_a_plain_loop(monkeypatch):
    monkeypatch.setattr(skip_gram, "PLACES", 1)
    rng = np.random.default_rng(3)
    tree = skip_gram.huffman([5, 2, 1], [1, 2, 3])
    paths = tree.paths(np.array([0, 1, 1, 2, 2, 2]), np.array([0, 0, 1, 0, 1, 2]))
    start = rng.normal(size=(6, 4)).astype(np.float32)
    learner = skip_gram._Learner(paths, start.copy())
    ids, window = np.array([0, 3, 1, 0, 5, 2, 4, 0]), np.array([2, 5, 1, 3, 4, 2, 5, 1])
    sentence = np.array([0, 0, 0, 0, 1, 1, 1, 1])
    learner.learn(ids, sentence, window, lambda at: 0.1)
    words, nodes = start.astype(np.float64), np.zeros((5, 4))
    for p, word in enumerate(ids):
        around = [c for c in range(len(ids)) if c != p and abs(c - p) <= window[p] and sentence[c] == sentence[p]]
        above = [*zip(paths[1][paths[0] == word], paths[2][paths[0] == word], strict=True)]
        of_words, of_nodes, bend = np.zeros_like(words), np.zeros_like(nodes), np.ones((5, 1))
        for c in around:
            x, moved = words[ids[c]], np.zeros(4)
            for node, bit in above:
                gain = 0.1 * (1 - bit - 1 / (1 + np.exp(-x @ nodes[node])))
                moved += gain * nodes[node]
                of_nodes[node] += gain * x
                bend[node] += 0.1 / 4 * x @ x
            of_words[ids[c]] += moved / (1 + 0.1 / 4 * sum(nodes[node] @ nodes[node] for node, _ in above))
        words, nodes = words + of_words, nodes + of_nodes / bend
    assert learner.words == pytest.approx(words, abs=1e-5) and learner.nodes == pytest.approx(nodes, abs=1e-5)


def test_vectors_of_several_tasks_do_not_follow_the_partitioning(spark):
    rng = random.Random(5)
    rows = [(str(n), " ".join(rng.choices("abcdefghij", k=rng.randint(0, 12)))) for n in range(80)] + [("x", None)]
    df = spark.createDataFrame([*rows, *rows[:20]], "id string, text string")
    runs = []
    for parts in (1, 9):
        fitted = skip_gram.fit_skip_grams(df.repartition(parts), 6, 0, 7, 3)
        runs.append({r.word: tuple(r.vector) for r in fitted.getVectors().collect()})
    assert runs[0] == runs[1] and set(runs[0]) == set("abcdefghij")
    often = skip_gram.fit_skip_grams(df.limit(0).union(spark.createDataFrame([("1", "a a b")], df.schema)), 6, 2, 7, 2)
    assert [r.word for r in often.getVectors().collect()] == ["a"]


def test_words_are_not_collected(spark, monkeypatch):
    """The driver gets a row for each different count, and not one for each word."""
    df = spark.createDataFrame([(1.0, f"w{n} w{n + 1} common", str(n)) for n in range(400)], "label double, text string, id string")
    collected, collect = [], type(df).collect

    def counting(self):
        rows = collect(self)
        collected.append(len(rows))
        return rows

    monkeypatch.setattr(type(df), "collect", counting)
    vectorizer = plans.fit_vectorizer(df, size=4)
    assert max(collected) <= 50
    monkeypatch.undo()
    assert vectorizer.transform(df).count() == 400 and vectorizer.word2vec.getVectors().count() == 402


def test_a_text_without_words_or_a_null_one_has_a_vector(spark):
    df = spark.createDataFrame([(0.0, "a b a", "1"), (1.0, "b c", "2")], "label double, text string, id string")
    vectorizer = plans.fit_vectorizer(df, size=3)
    odd = spark.createDataFrame([("", "1"), (None, "1"), ("zz", "2"), ("zz", "2")], "text string, id string")
    got = vectorizer.transform(odd).collect()
    assert len(got) == 4 and len({tuple(r.features) for r in got}) == 1


def test_training_rows_do_not_hold_texts(spark):
    df = spark.createDataFrame([(float(n % 2), f"w{n}", str(n)) for n in range(20)], "label double, text string, id string")
    seen = []

    class Watching:
        def fit(self, training):
            seen.append(training.columns)

    mood.fit_mood_models(df, plans.fit_vectorizer(df, size=3), (Watching(),))
    assert seen == [["label", "features"]] and df.select(F.max("label")).first()[0] == 1


def test_many_places_at_a_time_do_not_overshoot():
    rng = np.random.default_rng(4)
    tree = skip_gram.huffman([1, 5, 200], [20, 10, 4])
    run = np.repeat([0, 1, 2], [20, 10, 4])
    paths = tree.paths(run, np.concatenate([np.arange(n) for n in (20, 10, 4)]))
    ids = np.where(rng.random(20_000) < 0.9, rng.integers(30, 34, 20_000), rng.integers(0, 30, 20_000))
    learner = skip_gram._Learner(paths, rng.normal(size=(34, 8)).astype(np.float32))
    learner.learn(ids, np.zeros(len(ids)), np.full(len(ids), 5), lambda at: 0.1)
    assert np.abs(learner.words).max() < 6 and np.abs(learner.nodes).max() < 6
