"""Whitening against plain numpy, and the rank-one updates by themselves."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowdtape.llm import whitening
from crowdtape.llm.whitening import Spectra

ROW = "vec_id bigint, embedding array<float>, whitened string, x string"


def scatter(points):
    away = points - points.mean(0)
    return away.T @ away


def assert_decomposes(spectrum, points):
    vectors, values = spectrum.vectors[0], spectrum.values[0]
    expected = scatter(points)
    scale = max(np.abs(expected).max(), 1e-300)
    assert np.abs(vectors * values @ vectors.T - expected).max() <= 1e-11 * scale
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-11
    assert spectrum.mean[0] == pytest.approx(points.mean(0)) and spectrum.rows[0] == len(points)


rows_of_numbers = st.integers(1, 6).flatmap(
    lambda d: st.lists(st.lists(st.integers(-3, 3), min_size=d, max_size=d), min_size=1, max_size=40)
)


@settings(max_examples=150, deadline=None)
@given(rows_of_numbers, st.integers(1, 4))
def test_updates_with_ties_and_zeros(rows, lanes):
    points = np.array(rows, float)
    count = len(points) // lanes * lanes
    if not count:
        return
    spectra = Spectra.empty(lanes, points.shape[1])
    for at in range(0, count, lanes):
        spectra.add(points[at : at + lanes])
    assert_decomposes(spectra.joined(), points[:count])


@pytest.mark.parametrize("scale", [np.ones(24), np.logspace(-7, 4, 24)])
def test_updates_of_many_scales(scale):
    points = np.random.default_rng(1).normal(size=(600, 24)) * scale
    spectra = Spectra.empty(5, 24)
    for at in range(0, 600, 5):
        spectra.add(points[at : at + 5])
    assert_decomposes(spectra.joined(), points)


def plain(embeddings):
    """Deviation, whitened, explained of the contract, by eigh of the covariance."""
    x = np.floor(64 * embeddings).astype(np.int64) + 1_000_000
    n, sums = len(x), x.sum(0)
    y = (n * x - sums) / n
    covariance = y.T @ y / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:32]
    return ((n * x - sums) ** 2).sum(1), y @ vectors[:, order] / np.sqrt(values[order]), values[order] / np.trace(covariance)


def test_query_is_that_of_plain_numpy(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").toPandas()
    deviation, whitened, explained = plain(np.stack(table.embedding).astype(float))
    got = whitening.op13_embedding_whitening(spark, sf_dir).toPandas().sort_values(["component", "vec_id"])
    count = whitened.shape[1]
    found = got.whitened.to_numpy().reshape(count, -1).T
    sign = np.sign((found * whitened).sum(0))
    assert np.abs(found * sign - whitened).max() < 1e-8
    assert got.explained.to_numpy().reshape(count, -1)[:, 0] == pytest.approx(explained, rel=1e-10)
    assert (got.deviation.to_numpy().reshape(count, -1) == deviation).all()
    assert set(got.n) == {len(table)} and got.identity_error.max() < 1e-10
    assert got.vec_id.tolist() == table.vec_id.tolist() * count


@pytest.mark.parametrize("parts", [1, 40])
def test_partitions_and_hot_vectors(spark, parts):
    rng = np.random.default_rng(2)
    vectors = np.concatenate([rng.normal(size=(300, 6)), np.tile(rng.normal(size=(1, 6)), (200, 1))]).astype("f4")
    rows = [(n, v.tolist(), None, None) for n, v in enumerate(vectors)]
    found = whitening.long_vectors(spark.createDataFrame(rows, ROW).repartition(parts), "embedding", ["vec_id"])
    model = whitening.fit(found)
    got = whitening.whiten(found, model).select("row.vec_id", "whitened").toPandas().sort_values("vec_id")
    _, whitened, explained = plain(vectors.astype(float))
    assert np.abs(np.abs(np.stack(got.whitened)) - np.abs(whitened)).max() < 1e-8
    assert model["explained"] == pytest.approx(explained) and model["identity_error"] < 1e-10


def test_awkward_rows(spark):
    rows = [
        (1, [1.0, 2.0, 0.5], "a", None),
        (1, [1.0, 2.0, 0.5], "a", None),
        (None, [0.0, -1.0, 0.25], None, None),
        (2, [0.5, 0.5, -3.0], None, None),
        (3, None, None, None),
        (4, [None, 1.0, 1.0], None, None),
        (5, [float("nan"), 1.0, 1.0], None, None),
        (6, [float("-inf"), 1.0, 1.0], None, None),
        (7, [1.0, 1.0], None, None),
        (8, [], None, None),
    ]
    table = spark.createDataFrame(rows, ROW)
    found = whitening.long_vectors(table, "embedding", ["vec_id", "x"])
    model = whitening.fit(found)
    got = whitening.whiten(found, model).select("row.*", "deviation", "whitened").collect()
    assert sorted(str(r.vec_id) for r in got) == ["1", "1", "2", "None"]
    assert {len(r.whitened) for r in got} == {2}  # four rows of three kinds span two dimensions
    assert model["identity_error"] < 1e-10
    flat = [(n, [1.0, 2.0], None, None) for n in range(5)]
    for few in (table.limit(0), spark.createDataFrame(flat, ROW), spark.createDataFrame(flat[:1], ROW)):
        rows = whitening.long_vectors(few, "embedding", ["vec_id"])
        assert [r.whitened for r in whitening.whiten(rows, whitening.fit(rows)).collect()] == [[]] * few.count()
    huge = spark.createDataFrame([(1, [3e38, 0.0], None, None), (2, [-3e38, 1.0], None, None)], ROW)
    rows = whitening.long_vectors(huge, "embedding", ["vec_id"])
    spread = whitening.whiten(rows, whitening.fit(rows)).select(F.explode("whitened").alias("w")).collect()
    assert [abs(r.w) for r in spread] == pytest.approx([1.0, 1.0])
