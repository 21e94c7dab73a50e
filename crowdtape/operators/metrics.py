"""Classification metrics as aggregations. Each row has a label and a prediction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Number of rows per label and prediction."""
    return df.groupBy(*by, label, prediction).agg(F.count("*").alias("rows"))


def accuracy(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Share of rows whose prediction equals the label; a row without either is a miss."""
    hit = F.coalesce(F.col(label) == F.col(prediction), F.lit(False)).cast("double")
    return df.groupBy(*by).agg(F.avg(hit).alias("accuracy"))


def weighted_recall(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Recall of each label, averaged with the label frequencies as weights."""
    per_label = df.groupBy(*by, label).agg(
        F.count("*").alias("n"),
        F.count_if(F.col(label) == F.col(prediction)).alias("hits"),
    )
    recall = F.col("hits") / F.col("n")
    return per_label.groupBy(*by).agg(
        (F.sum(F.col("n") * recall) / F.sum("n")).alias("weighted_recall")
    )
