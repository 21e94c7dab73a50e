"""Predict the mood of a post from its words, by three models and their majority."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    MultilayerPerceptronClassifier,
    NaiveBayes,
    RandomForestClassifier,
)
from pyspark.ml.feature import MinMaxScaler, MinMaxScalerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtape.operators.sampling import cap_per_group
from crowdtape.operators.votes import vote
from crowdtape.plans.direction import SEED, TREES
from crowdtape.plans.skip_gram import SkipGrams, fit_skip_grams

# Vector size and word frequency limit of the word vectors;
# layers, rows per block and iterations of the perceptron.
VECTOR_SIZE = 50
MIN_COUNT = 0
LAYERS = (50, 100, 80, 100, 3)
BLOCK_SIZE = 128
MAX_ITERATIONS = 100

# Training rows go to this many partitions at least on any machine, one for each so many of them beyond: results
# follow the partitioning.
PARTITIONS = 8
PARTITION_ROWS = 6_250

# Word vectors are trained in a task for each so many characters (about a million words) of the training rows.
TASK_CHARACTERS = 6_000_000

MODELS = ("forest", "perceptron", "bayes")


def _bounded(labeled: DataFrame, max_rows: int | None) -> DataFrame:
    """All rows, or the ``max_rows`` of the smallest hashes.

    The bound is a cut through two hashes of each row, of which alone the smallest
    meet in one task; the rows pass a filter. Rows with the hashes of the cut are
    equal, so one of them is repeated as often as it takes.
    """
    if max_rows is None:
        return labeled
    hashes = F.struct(F.xxhash64("text").alias("text"), F.xxhash64(*labeled.columns).alias("row"))
    least = labeled.select(hashes.alias("h")).orderBy("h").limit(max_rows)
    cut = least.groupBy("h").count().orderBy(F.desc("h")).first()
    if cut is None:
        return labeled.limit(0)
    at = F.struct(F.lit(cut.h.text).cast("long").alias("text"), F.lit(cut.h.row).cast("long").alias("row"))
    copies = F.explode(F.array_repeat(F.lit(0), cut["count"])).alias("_copy")
    last = labeled.where(hashes == at).limit(1).select("*", copies).drop("_copy")
    return labeled.where(hashes < at).unionByName(last)


def _training_rows(labeled: DataFrame, partitions: int = PARTITIONS, max_rows: int | None = None) -> DataFrame:
    """All rows, or ``max_rows`` of them, in one order and partitioning, whatever files and cores there are."""
    order = [F.xxhash64("text"), F.xxhash64(*labeled.columns)]
    return _bounded(labeled, max_rows).repartition(partitions, F.xxhash64("text")).sortWithinPartitions(*order)


def _scaler() -> MinMaxScaler:
    return MinMaxScaler(inputCol="vector", outputCol="features")


@dataclass(frozen=True)
class Vectorizer:
    """Fitted word vectors and the scaler fitted on the same texts."""

    word2vec: SkipGrams
    scaler: MinMaxScalerModel

    def transform(self, df: DataFrame, refit_scaler: bool = False) -> DataFrame:
        """Add ``features``: the mean word vector of ``text``, scaled.

        The minimum and maximum are those of the training texts, and values
        outside of them are cut to 0..1, because naive Bayes takes no negative
        ones. ``refit_scaler`` takes them from ``df`` itself, at the price of one
        more pass over it.
        """
        vectors = self.word2vec.transform(df)
        scaler = _scaler().fit(vectors) if refit_scaler else self.scaler
        scaled = scaler.transform(vectors).drop("vector")
        if refit_scaler:
            return scaled
        inside = F.transform(
            vector_to_array("features"), lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), x))
        )
        return scaled.withColumn("features", array_to_vector(inside))


def _word_tasks(labeled: DataFrame, max_rows: int | None) -> int:
    """Tasks for the word vectors of all rows, or of ``max_rows`` of them, by the mean length of all texts."""
    found = labeled.agg(F.count("*").alias("rows"), F.sum(F.length("text")).alias("characters")).first()
    share = 1.0 if max_rows is None else min(1.0, max_rows / max(found.rows, 1))
    return max(1, math.ceil((found.characters or 0) * share / TASK_CHARACTERS))


def fit_vectorizer(
    labeled: DataFrame,
    size: int = VECTOR_SIZE,
    min_count: int = MIN_COUNT,
    seed: int = SEED,
    num_partitions: int | None = None,
    max_rows: int | None = None,
) -> Vectorizer:
    """Fit word vectors and a 0..1 scaler on the ``text`` of all rows, or of at most ``max_rows``.

    Words are trained by ``num_partitions`` tasks, without a number by one for each so many characters; vectors
    follow this number and the texts, and nothing else. No task and not the driver holds all words.
    """
    tasks = num_partitions or _word_tasks(labeled, max_rows)
    rows = _bounded(labeled, max_rows)
    word2vec = fit_skip_grams(rows, size, min_count, seed, tasks)
    return Vectorizer(word2vec, _scaler().fit(word2vec.transform(rows)))


def word2vec_features(labeled: DataFrame, **options: int) -> DataFrame:
    """All labelled posts with their own ``features``; ``max_rows`` bounds the fit alone."""
    return fit_vectorizer(labeled, **options).transform(labeled)


def _outputs(model: str) -> dict[str, str]:
    """Output columns of one model, so that models can follow each other."""
    return {
        "predictionCol": f"{model}_prediction",
        "probabilityCol": f"{model}_probability",
        "rawPredictionCol": f"{model}_raw",
    }


def mood_forest(num_trees: int = TREES, seed: int = SEED) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=num_trees, seed=seed, **_outputs("forest"))


def perceptron(
    layers: tuple[int, ...] = LAYERS, max_iterations: int = MAX_ITERATIONS, seed: int = SEED
) -> MultilayerPerceptronClassifier:
    """The first layer is the feature size, the last the number of classes."""
    return MultilayerPerceptronClassifier(
        layers=list(layers),
        blockSize=BLOCK_SIZE,
        maxIter=max_iterations,
        seed=seed,
        **_outputs("perceptron"),
    )


def naive_bayes() -> NaiveBayes:
    return NaiveBayes(**_outputs("bayes"))


@dataclass(frozen=True)
class MoodModels:
    vectorizer: Vectorizer
    classifiers: tuple[Model, ...]


def fit_mood_models(
    labeled: DataFrame,
    vectorizer: Vectorizer | None = None,
    classifiers: tuple[Estimator, ...] | None = None,
    max_rows: int | None = None,
) -> MoodModels:
    """Fit forest, perceptron and naive Bayes on all labelled posts, or on at most ``max_rows``.

    The vectors are kept in memory or on disk while the three models, which
    pass over them many times, are fitted.
    """
    vectorizer = vectorizer or fit_vectorizer(labeled, max_rows=max_rows)
    rows = _bounded(labeled, max_rows)
    partitions = max(PARTITIONS, math.ceil(rows.count() / PARTITION_ROWS))
    # Ordered by a hash of the text, so that no text is sorted.
    narrow = vectorizer.transform(rows).select("label", F.xxhash64("text").alias("text"), "features")
    training = _training_rows(narrow, partitions).select("label", "features")
    training = training.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        estimators = classifiers or (mood_forest(), perceptron(), naive_bayes())
        return MoodModels(vectorizer, tuple(e.fit(training) for e in estimators))
    finally:
        training.unpersist()


def score_moods(
    posts: DataFrame,
    models: MoodModels,
    cap: int | None = None,
    seed: int = 0,
    refit_scaler: bool = False,
) -> DataFrame:
    """Majority mood of all posts, or of at most ``cap`` random ones per date.

    The features are scaled to the range of the training texts, so the mood of a
    post depends on no other post; ``refit_scaler`` scales them to the range of
    the given posts instead. The models add their columns one after another to the same rows, so their
    predictions meet without a join.
    """
    sample = posts.select("date", "id", "text")
    if cap is not None:
        drawn = cap_per_group(posts.select("date", "id"), "date", "id", cap, seed)
        sample = sample.join(drawn, ["date", "id"], "left_semi")
    scored = models.vectorizer.transform(sample, refit_scaler)
    for classifier in models.classifiers:
        scored = classifier.transform(scored)
    columns = [f"{name}_prediction" for name in MODELS]
    return vote(scored.select("date", "id", "text", *columns), columns)
