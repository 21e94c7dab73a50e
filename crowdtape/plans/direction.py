"""Predict the price direction of a day from its features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import Estimator
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame

from crowdtape.operators.folds import fold_column
from crowdtape.session import drop, stored

FEATURES = ("post_count", "sum_shares", "sum_likes", "total_sentiment")

# Forest size, number of folds and fold seed.
TREES = 100
FOLDS = 10
SEED = 100


def assemble(
    df: DataFrame,
    inputs: Sequence[str] = FEATURES,
    keep: Sequence[str] = ("label",),
    handle_invalid: str = "error",
) -> DataFrame:
    """Gather the input columns into the vector ``features`` next to ``keep``."""
    assembler = VectorAssembler(
        inputCols=list(inputs), outputCol="features", handleInvalid=handle_invalid
    )
    return assembler.transform(df).select(*keep, "features")


def forest(
    num_trees: int = TREES, seed: int = SEED, prediction: str = "prediction"
) -> RandomForestClassifier:
    return RandomForestClassifier(numTrees=num_trees, seed=seed, predictionCol=prediction)


def cross_validate(
    df: DataFrame,
    estimator: Estimator | None = None,
    k: int = FOLDS,
    seed: int = SEED,
    key: str | Sequence[str] = "date",
    metric: str = "weightedRecall",
    parallelism: int = 4,
) -> CrossValidatorModel:
    """Fit and evaluate ``estimator`` on each of ``k`` folds of (key, label, features).

    ``avgMetrics[0]`` of the result is the mean over the folds. The input is
    written once and kept in memory or on disk meanwhile, since each fold reads
    it; lost blocks are read again. A written table has as many partitions as its
    bytes need: those of the shuffle before it would each cost a task in every job
    of a fold, however few rows they hold.
    """
    scratch: list[str] = []
    folds = stored(fold_column(df, key, k, seed).select("fold", "label", "features"), "folds", scratch)
    folds = folds.persist(StorageLevel.MEMORY_AND_DISK)
    validator = CrossValidator(
        estimator=estimator or forest(),
        estimatorParamMaps=ParamGridBuilder().build(),
        evaluator=MulticlassClassificationEvaluator(metricName=metric),
        numFolds=k,
        foldCol="fold",
        parallelism=parallelism,
    )
    try:
        return validator.fit(folds)
    finally:
        folds.unpersist()
        drop(df.sparkSession, scratch)
