from __future__ import annotations

import datetime as dt
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from crowdtape import operators as ops
from crowdtape import plans
from crowdtape.plans import mood
from crowdtape.session import shared_dir

LEXICON = {"good": 1, "bad": -1}


@pytest.fixture(scope="module")
def posts(spark):
    days = [dt.date(2024, 1, n) for n in range(5, 11)]  # Friday to Wednesday
    rows = [
        (day, f"{day.day}{i}", "good day" if (i + day.day) % 3 else "bad bad bad", i, 2 * i)
        for day in days
        for i in range(day.day)
    ]
    return spark.createDataFrame(
        rows, "date date, id string, text string, retweets int, favorites int"
    )


@pytest.fixture(scope="module")
def prices(spark):
    rows = [(dt.date(2024, 1, n), float(p)) for n, p in ((5, 10), (8, 12), (9, 11), (10, 11))]
    return spark.createDataFrame(rows, "date date, close double")


def test_features(spark, posts, prices):
    df = plans.build_features(posts, prices, LEXICON)
    assert df.columns == [
        "date",
        "post_count",
        "sum_shares",
        "sum_likes",
        "price",
        "next_price",
        "label",
        "total_sentiment",
    ]
    rows = df.collect()
    assert [(r.date.day, r.post_count, r.label) for r in rows] == [
        (5, 5, 1.0),
        (8, 8, 0.0),
        (9, 9, 0.0),
    ]
    assert rows[0].sum_shares == 10 and rows[0].sum_likes == 20
    # Friday: ids 0..4, of which i + 5 is a multiple of 3 for 1 and 4.
    assert rows[0].total_sentiment == 3 - 2


def test_features_with_a_scorer_and_without(spark, posts, prices):
    by_function = plans.build_features(posts, prices, lambda s: ops.score(s, LEXICON))
    assert by_function.collect() == plans.build_features(posts, prices, LEXICON).collect()
    assert "total_sentiment" not in plans.build_features(posts, prices).columns


def test_weekend_posts_change_nothing_after_the_join(spark, posts, prices):
    whole = plans.daily_sentiment(posts, LEXICON, weekdays_only=False)
    weekdays = plans.daily_sentiment(posts, LEXICON)
    assert whole.count() == 6 and weekdays.count() == 4
    assert sorted(weekdays.join(whole, ["date", "total_sentiment"]).collect()) == sorted(
        weekdays.collect()
    )


def test_features_per_ticker(spark, posts, prices):
    tickers = spark.createDataFrame([("a",), ("b",)], "ticker string")
    df = plans.build_features(
        posts.join(tickers, F.lit(True)), prices.join(tickers, F.lit(True)), LEXICON, by=["ticker"]
    )
    one = plans.build_features(posts, prices, LEXICON).collect()
    for ticker in "ab":
        part = df.filter(F.col("ticker") == ticker).drop("ticker").orderBy("date").collect()
        assert part == one


def test_reports(spark, posts, prices):
    counts = plans.posts_per_day(posts).collect()
    assert [(r.day, r.posts_per_day) for r in counts] == [(f"2024-01-{n:02d}", n) for n in range(5, 11)]
    closes = plans.price_per_day(prices).collect()
    assert [r.price for r in closes] == [10.0, 12.0, 11.0, 11.0]
    overlay = plans.normalized_overlay(posts, prices)
    assert {r.series: r["count"] for r in overlay.groupBy("series").count().collect()} == {
        "posts": 6,
        "price": 4,
    }
    for r in overlay.groupBy("series").agg(F.avg("z").alias("m"), F.stddev("z").alias("s")).collect():
        assert r.m == pytest.approx(0) and r.s == pytest.approx(1)


def test_direction_forest(spark):
    rows = [(dt.date(2020, 1, 1) + dt.timedelta(n), n, n % 2, 0, 0.0, float(n % 2)) for n in range(120)]
    df = spark.createDataFrame(
        rows,
        "date date, post_count long, sum_shares long, sum_likes long, total_sentiment double, "
        "label double",
    )
    data = plans.assemble(df, keep=["date", "label"])
    assert data.columns == ["date", "label", "features"]
    model = plans.cross_validate(data, plans.forest(num_trees=5), k=3, parallelism=3)
    assert model.avgMetrics[0] > 0.9


def test_reference_parameters():
    forest = plans.forest()
    assert forest.getNumTrees() == 100 and forest.getSeed() == 100
    net = plans.perceptron()
    assert net.getLayers() == [50, 100, 80, 100, 3]
    assert net.getBlockSize() == 128 and net.getMaxIter() == 100
    assert (mood.VECTOR_SIZE, mood.MIN_COUNT) == (50, 0)


@pytest.fixture(scope="module")
def labeled(spark):
    texts = ("awful awful trip", "a trip to town", "lovely lovely day")
    rows = [(float(n % 3), f"{texts[n % 3]} {n % 5}", str(n)) for n in range(60)]
    return spark.createDataFrame(rows, "label double, text string, id string")


@pytest.fixture(scope="module")
def vectorizer(labeled):
    return plans.fit_vectorizer(labeled, size=8, num_partitions=1)


def values(df):
    from pyspark.ml.functions import vector_to_array

    return df.select(F.explode(vector_to_array("features")).alias("x")).agg(F.min("x"), F.max("x")).first()


def test_vectors_are_scaled(spark, labeled, vectorizer):
    low, high = values(vectorizer.transform(labeled))
    assert low >= 0 and high <= 1
    other = labeled.filter("label = 0").limit(3).withColumn("text", F.lit("unknown words"))
    low, high = values(vectorizer.transform(other))
    assert low >= 0 and high <= 1
    low, high = values(vectorizer.transform(labeled, refit_scaler=True))
    assert (low, high) == (0.0, pytest.approx(1.0))


def test_features_do_not_follow_the_partitioning(labeled):
    from pyspark.ml.functions import vector_to_array

    def first(df):
        made = plans.fit_vectorizer(df, size=4).transform(df)
        return sorted((r.id, *r.v) for r in made.select("id", vector_to_array("features").alias("v")).collect())

    assert first(labeled.repartition(2)) == first(labeled.repartition(7))


def test_word_vectors_are_trained_in_more_tasks_for_longer_texts(labeled, monkeypatch):
    assert plans.fit_vectorizer(labeled, size=4).word2vec.getNumPartitions() == 1
    monkeypatch.setattr(mood, "TASK_CHARACTERS", 400)
    fitted = plans.fit_vectorizer(labeled, size=4)
    assert fitted.word2vec.getNumPartitions() == 3
    assert plans.fit_vectorizer(labeled, size=4, max_rows=20).word2vec.getNumPartitions() == 1
    words = {r.word for r in fitted.word2vec.getVectors().collect()}
    assert words == {w for r in labeled.collect() for w in r.text.split(" ")}
    assert values(fitted.transform(labeled)) == (pytest.approx(0.0), pytest.approx(1.0))


def test_training_rows_are_bounded(labeled):
    assert mood._training_rows(labeled, 3, 7).count() == 7
    assert mood._training_rows(labeled, 3).rdd.getNumPartitions() == 3


@pytest.mark.parametrize("bound", [1, 7, 59, 60, 100])
def test_training_rows_are_the_smallest_hashes_without_a_sort_of_texts(labeled, bound):
    twice = labeled.unionByName(labeled.limit(30))
    got = mood._training_rows(twice, 3, bound)
    smallest = sorted(r.h for r in twice.select(F.xxhash64("text").alias("h")).collect())[:bound]
    assert sorted(r.h for r in got.select(F.xxhash64("text").alias("h")).collect()) == smallest
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "GlobalLimit 7" not in plan
    assert mood._training_rows(labeled.limit(0), 3, bound).count() == 0


def test_features_and_scores_cover_more_rows_than_the_fit(spark, labeled):
    made = plans.word2vec_features(labeled, size=4, max_rows=7)
    assert made.count() == labeled.count() and made.select("id").distinct().count() == 60
    models = plans.fit_mood_models(labeled, classifiers=(plans.naive_bayes(),), max_rows=7)
    scored = models.classifiers[0].transform(models.vectorizer.transform(labeled))
    assert scored.where("bayes_prediction IN (0, 1, 2)").count() == labeled.count()


def test_model_queries_return_more_rows_than_they_fit_on(spark, monkeypatch):
    import __spark_entry__ as entry

    rows = [(float(n % 3), f"word{n % 3} and {n}", str(n)) for n in range(60)]
    df = spark.createDataFrame(rows, "label double, text string, id string")
    bounded = mood._training_rows
    monkeypatch.setattr(mood, "_training_rows", lambda df, partitions=2, max_rows=7: bounded(df, partitions, min(max_rows, 7)))
    monkeypatch.setattr(entry, "labeled_corpus", lambda spark, sf_dir: df)
    for query in (entry.word2vec_features, entry.fit_nb):
        assert query(spark, "").count() == 60


def test_mood_ensemble(spark, labeled, vectorizer):
    estimators = (
        mood.mood_forest(num_trees=5),
        plans.perceptron(layers=(8, 6, 3), max_iterations=20),
        plans.naive_bayes(),
    )
    models = plans.fit_mood_models(labeled, vectorizer, estimators)
    posts = labeled.withColumn("date", F.lit("2024-01-08").cast("date"))
    scored = plans.score_moods(posts, models, cap=50)
    assert scored.columns == [
        "date",
        "id",
        "text",
        "forest_prediction",
        "perceptron_prediction",
        "bayes_prediction",
        "prediction",
    ]
    assert scored.count() == 50
    assert plans.score_moods(posts, models).count() == posts.count()
    hits = scored.join(labeled.select("id", "label"), "id").filter("label = prediction").count()
    assert hits >= 40


def test_shared_dir_follows_the_cluster_setting(spark):
    def session(root, master):
        return SimpleNamespace(
            conf=SimpleNamespace(get=lambda name, default: root),
            sparkContext=SimpleNamespace(master=master),
        )

    path = shared_dir(session("hdfs://shared/", "yarn"), "features")
    assert path.startswith("hdfs://shared/features-")
    assert shared_dir(spark, "x") != shared_dir(spark, "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session(None, "yarn"), "features")


def test_vectors_and_models_are_fitted_on_all_rows_without_a_bound(spark, monkeypatch):
    import inspect

    assert not hasattr(mood, "MAX_TRAINING_ROWS")
    for fit in (plans.fit_vectorizer, plans.fit_mood_models):
        assert inspect.signature(fit).parameters["max_rows"].default is None
    rows = [(float(n % 3), f"word{n}", str(n)) for n in range(51_000)]
    labeled = spark.createDataFrame(rows, "label double, text string, id string")
    assert mood._training_rows(labeled).count() == 51_000
    seen = []

    class Watching:
        def fit(self, training):
            seen.append((training.count(), training.rdd.getNumPartitions()))

    same = SimpleNamespace(transform=lambda df: df.withColumn("features", F.lit(0.0)))
    plans.fit_mood_models(labeled, same, (Watching(),))
    assert seen == [(51_000, 9)]
