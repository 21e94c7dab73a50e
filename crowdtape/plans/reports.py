"""Chart series as tidy tables, sorted for the reader."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtape.operators.normalize import zscore


def _post_counts(posts: DataFrame) -> DataFrame:
    return posts.groupBy("date").agg(F.count("*").alias("posts_per_day"))


def posts_per_day(posts: DataFrame) -> DataFrame:
    """Posts per date, from the quietest day to the busiest, ties by date."""
    return (
        _post_counts(posts)
        .orderBy("posts_per_day", "date")
        .select(F.col("date").cast("string").alias("day"), "posts_per_day")
    )


def price_per_day(prices: DataFrame, price: str = "close") -> DataFrame:
    """Closing price per date."""
    return prices.orderBy("date").select(
        F.col("date").cast("string").alias("day"), F.col(price).alias("price")
    )


def normalized_overlay(posts: DataFrame, prices: DataFrame, price: str = "close") -> DataFrame:
    """Post counts and prices as standard scores in one table (series, day, z)."""
    counts = zscore(_post_counts(posts), "posts_per_day").withColumn("series", F.lit("posts"))
    closes = zscore(prices.select("date", price), price).withColumn("series", F.lit("price"))
    columns = ["series", F.col("date").cast("string").alias("day"), "z"]
    return counts.select(*columns).unionByName(closes.select(*columns)).orderBy("series", "day")
