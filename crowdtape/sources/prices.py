"""Daily price files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from crowdtape.schemas import PRICE, conform


def read_prices(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read header CSV files and keep the seven price columns, found by name.

    Values that are no number or date become NULL. Every column is read as text
    first, so no extra pass is spent on guessing types.
    """
    return conform(spark.read.csv(path, header=True), PRICE)
