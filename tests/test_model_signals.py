"""Models find a planted signal and none where the labels are shuffled."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from crowdtape import operators as ops
from crowdtape import plans
from crowdtape.plans import mood

DAY = dt.date(2020, 1, 1)


def history(spark, shuffled):
    """Days whose label follows one of the two inputs, or nothing."""
    rng = random.Random(8)
    rows = []
    for n in range(240):
        count, noise = rng.randint(0, 100), rng.randint(0, 100)
        label = float(rng.random() < 0.5) if shuffled else float(count > 50)
        rows.append((DAY + dt.timedelta(days=n), label, count, noise))
    df = spark.createDataFrame(rows, "date date, label double, post_count int, noise int")
    return plans.assemble(df, ["post_count", "noise"], keep=["date", "label"])


@pytest.mark.parametrize("shuffled", [False, True])
def test_cross_validated_forest(spark, shuffled):
    result = plans.cross_validate(history(spark, shuffled), plans.forest(10), k=4)
    recall = result.avgMetrics[0]
    assert recall > 0.9 if not shuffled else 0.3 < recall < 0.7


def test_mean_of_the_folds_is_that_of_each_fold(spark):
    df = history(spark, False)
    folds = ops.fold_column(df, "date", 3, 100)
    recalls = []
    for k in range(3):
        model = plans.forest(5).fit(folds.filter(f"fold <> {k}").select("label", "features"))
        scored = model.transform(folds.filter(f"fold = {k}"))
        recalls.append(ops.weighted_recall(scored).first().weighted_recall)
    # Row order may differ between the two fits, and with it a few bootstrap samples.
    assert plans.cross_validate(df, plans.forest(5), k=3).avgMetrics[0] == pytest.approx(sum(recalls) / 3, abs=0.05)


def moods(spark, shuffled):
    rng = random.Random(6)
    words = {0.0: "awful broken late".split(), 1.0: "plain usual flight".split(), 2.0: "lovely quick kind".split()}
    rows = [(float(n % 3), " ".join(rng.choices(words[float(n % 3)], k=6)), str(n)) for n in range(210)]
    labels = [r[0] for r in rows]
    if shuffled:
        rng.shuffle(labels)
    return spark.createDataFrame([(c, *r[1:]) for c, r in zip(labels, rows, strict=True)], "label double, text string, id string")


@pytest.mark.parametrize("shuffled", [False, True])
def test_mood_ensemble(spark, shuffled):
    labeled = moods(spark, shuffled)
    training, unseen = labeled.filter("int(id) < 150"), labeled.filter("int(id) >= 150")
    models = plans.fit_mood_models(
        training,
        vectorizer=plans.fit_vectorizer(training, size=8),
        classifiers=(
            mood.mood_forest(num_trees=10),
            plans.perceptron(layers=(8, 6, 3), max_iterations=60),
            plans.naive_bayes(),
        ),
    )
    posts = unseen.withColumn("date", F.lit(DAY))
    scored = plans.score_moods(posts, models).join(unseen.select("id", "label"), "id")
    assert scored.count() == unseen.count()
    for name in (*(f"{m}_prediction" for m in mood.MODELS), "prediction"):
        accuracy = ops.agreement(scored, prediction=name).first().accuracy
        assert accuracy < 0.6 if shuffled else accuracy > (0.6 if name.startswith("bayes") else 0.85), name


def test_scaled_features_reach_both_ends_of_each_dimension(spark):
    labeled = moods(spark, False)
    features = plans.word2vec_features(labeled, size=6).select(F.posexplode(vector_to_array("features")).alias("j", "x"))
    ends = features.groupBy("j").agg(F.min("x").alias("low"), F.max("x").alias("high")).collect()
    assert len(ends) == 6 and all(r.low == pytest.approx(0) and r.high == pytest.approx(1) for r in ends)
