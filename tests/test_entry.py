from __future__ import annotations

import pytest

import __spark_entry__ as registry
from compare import compare, connect

@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_sql_query_is_registered():
    ours = {q.__name__ for q in registry.QUERIES}
    assert ours - NO_SQL <= set(registry.oracle_sql())
    assert set(registry.oracle_sql()) <= set(registry.queries())


OURS = sorted({q.__name__ for q in registry.QUERIES} & set(registry.oracle_sql()))


@pytest.mark.parametrize("name", OURS)
def test_query_matches_sql(spark, sf_dir, con, name):
    df = registry.queries()[name](spark, sf_dir)
    assert compare(df, con, registry.oracle_sql()[name]) == []


def test_entry(spark):
    df = registry.entry(spark)
    assert df.columns[0] == "date" and df.count() == 21


def test_ensemble_scores_each_document_once(spark, sf_dir, monkeypatch):
    from crowdtape import plans

    scored = []
    score = plans.score_moods
    monkeypatch.setattr(plans, "score_moods", lambda posts, *rest: scored.append(posts.count()) or score(posts, *rest))
    found = registry.ensemble_predictions(spark, sf_dir)
    documents, posts = (spark.read.parquet(f"{sf_dir}/{name}.parquet").count() for name in ("documents", "events"))
    assert scored == [documents] and posts > documents
    assert found.count() == posts and found.select("id").distinct().count() == posts


MODELS = {"cv_forest", "cv_direction", "fit_forest", "word2vec_features", "fit_mlp", "fit_nb", "ensemble_predictions"}
NO_SQL = {"count_vector_features"}
# Written by a stream, whose batches a Python function of the driver takes.
STORES = {"incremental_posts", "stored_days", "incremental_activity", "observed_counts"}


def test_native_queries_run_no_python(spark, sf_dir):
    for name in set(OURS) - MODELS - STORES - {"score_with_plugin", "load_or_build"}:
        df = registry.queries()[name](spark, sf_dir)
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString(), name
