"""Sentiment lexicons."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crowdtape.schemas import LEXICON, conform


def read_lexicon(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read CSV files with the header columns ``token`` and ``polarity``."""
    return conform(spark.read.csv(path, header=True), LEXICON)
