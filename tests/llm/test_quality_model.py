"""The quality classifier: its sums by definition, its probabilities on labels it has not seen."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crowdtape.llm import quality_model
from crowdtape.llm.quality_model import BUCKETS, DIMENSIONS, WINDOW

DOC = "doc_id bigint, text string, lang string, score string, row string"


def brute_sums(ids):
    """Sum of the fixed vectors of the neighbours of each word, pair by pair."""
    places = quality_model.index_places()
    fixed = np.zeros((BUCKETS, DIMENSIONS), int)
    for bucket in set(ids):
        for one, place in enumerate(places[bucket]):
            fixed[bucket, place] += 1 - 2 * (one % 2)
    sums = np.zeros((BUCKETS, DIMENSIONS), int)
    for at, word in enumerate(ids):
        for other in range(max(0, at - WINDOW), min(len(ids), at + WINDOW + 1)):
            if other != at:
                sums[word] += fixed[ids[other]]
    return sums


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=30), st.integers(1, 8))
def test_contexts_and_pools_reach_across_spans(ids, span):
    before = quality_model.SPAN
    quality_model.SPAN = span
    try:
        sums = np.zeros(BUCKETS * DIMENSIONS, np.int64)
        quality_model.add_contexts(np.array(ids, np.int64), quality_model.index_places(), sums)
        assert (sums.reshape(BUCKETS, DIMENSIONS) == brute_sums(ids)).all()
        vectors = np.random.default_rng(4).normal(size=(6, DIMENSIONS)).astype("f4")
        found = quality_model.pooled(np.array(ids, np.int64), vectors)
    finally:
        quality_model.SPAN = before
    rows = vectors[ids].astype(float) if ids else np.zeros((1, DIMENSIONS))
    pairs = (rows[1:] * rows[:-1]).sum(0) / max(len(ids) - 1, 1)
    expected = np.concatenate([rows.mean(0), rows.std(0), pairs, [len(ids)]])
    assert found == pytest.approx(expected, abs=1e-3)


@given(st.floats(0.1, 10.0))
@settings(max_examples=10, deadline=None)
def test_temperature_undoes_a_scale(scale):
    rng = np.random.default_rng(7)
    margins = rng.normal(0, 2, 4000)
    targets = (rng.random(4000) < 1 / (1 + np.exp(-margins))).astype(float)
    assert quality_model.fit_temperature(margins * scale, targets) == pytest.approx(scale, rel=0.15)


def test_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = quality_model.op12_quality_classifier(spark, sf_dir).toPandas()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where("quality IS NOT NULL").toPandas()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    seen = got.merge(labels, on="doc_id")
    seen = seen[seen.held_out]
    right = (seen.predicted == seen.quality).mean()
    assert len(seen) > 50 and right >= 0.95 and right > max(seen.quality.mean(), 1 - seen.quality.mean())
    likelihood = np.where(seen.quality > 0, seen.score, 1 - seen.score)
    assert -np.log(np.maximum(likelihood, 1e-12)).mean() < 0.25  # 0.41 for the shares of the labels alone


def test_shuffled_labels_teach_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    coins = np.random.default_rng(11).integers(0, 2, len(ids))
    truth = dict(zip(ids, coins.tolist(), strict=True))
    known = [(i, q) for i, q in truth.items() if i % 2]
    model = quality_model.fit(docs, spark.createDataFrame(known, "doc_id bigint, quality int"))
    got = quality_model.score(docs, model, ["doc_id"]).select("row.doc_id", "score").collect()
    unseen = [(r.score >= 0.5) == truth[r.doc_id] for r in got if r.doc_id % 2 == 0]
    assert 0.3 < np.mean(unseen) < 0.7


def test_awkward_rows(spark):
    rows = [
        (1, "good words here and more of them " * 9, "x", "y", "z"),
        (1, "good words here and more of them " * 9, "x", "y", "z"),
        (2, "bad! bad! bad! worse!! worse!! " * 9, None, None, None),
        (None, None, None, None, None),
        (3, "", None, None, None),
        (4, "long text of words " * 50_000, None, None, None),
        (None, "\x1c ünï 漢字 \ud83d".encode("utf-8", "ignore").decode(), None, None, None),
    ]
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (None, 1), (4, None), (9, 0)], "doc_id bigint, quality int")
    model = quality_model.fit(docs, labels)
    got = quality_model.score(docs, model, ["doc_id", "row"]).select("row.doc_id", "score").collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 1}) == 1
    assert [r.score for r in got if r.doc_id == 2][0] < 0.5 < [r.score for r in got if r.doc_id == 1][0]
    for few, share in ((labels.limit(0), 0.5), (labels.where("quality = 0"), 0.0)):
        model = quality_model.fit(docs, few)
        assert {r.score for r in quality_model.score(docs, model, ["doc_id"]).collect()} == {share}
    none = docs.limit(0)
    assert quality_model.score(none, quality_model.fit(none, labels), ["doc_id"]).count() == 0


def test_one_row_an_id_and_a_bound(spark, monkeypatch):
    monkeypatch.setattr(quality_model, "LABELLED_ROWS", 10)
    labels = spark.range(500).selectExpr("id AS doc_id", "int(id % 2) AS quality")
    assert 1 <= quality_model.labelled_targets(labels).count() <= 10
    twice = spark.createDataFrame([(1, 1), (1, 0)], "doc_id bigint, quality int")
    assert [r.target for r in quality_model.labelled_targets(twice).collect()] == [0.5]
