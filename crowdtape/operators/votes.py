"""Combine the predictions of three classifiers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtape.functions.scores import majority_vote


def join_predictions(
    predictions: Sequence[DataFrame], keys: Sequence[str] = ("date", "id", "text")
) -> DataFrame:
    """Inner-join predictions that were stored apart.

    When ``id`` is unique, ``keys=["id"]`` on sides without the text gives the
    same rows and does not shuffle the texts. Models that are at hand are better
    chained on one DataFrame, which needs no join.
    """
    return reduce(lambda left, right: left.join(right, list(keys)), predictions)


def vote(df: DataFrame, columns: Sequence[str], output: str = "prediction") -> DataFrame:
    """Add the majority of three prediction columns."""
    first, second, third = (F.col(c) for c in columns)
    return df.withColumn(output, majority_vote(first, second, third))
