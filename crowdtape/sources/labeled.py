"""Labelled posts used to train the text classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.functions.scores import mood_label
from crowdtape.functions.text import non_empty, valid_id
from crowdtape.sources.csv_records import read_records

# The columns of the labelled file, in file order.
COLUMNS = [
    "tweet_id",
    "airline_sentiment",
    "airline_sentiment_confidence",
    "negativereason",
    "negativereason_confidence",
    "airline",
    "airline_sentiment_gold",
    "name",
    "negativereason_gold",
    "retweet_count",
    "text",
    "tweet_coord",
    "tweet_created",
    "tweet_location",
    "user_timezone",
]


def read_labeled_posts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Read the labelled CSV files and return ``label``, ``text`` and ``id``.

    Records are read whole, line breaks and doubled quotes in texts included; a large
    file is read by many tasks. Line breaks in texts become ``\\n``.
    """
    schema = ", ".join(f"{name} string" for name in COLUMNS)
    records = read_records(spark, path).filter("number > 0")  # the header comes first
    fields = F.from_csv("record", F.lit(schema), {"escape": '"'})
    raw = records.select(fields.alias("fields")).select("fields.*")
    return label_posts(raw, mood="airline_sentiment", text="text", post_id="tweet_id")


def label_posts(raw: DataFrame, mood: str, text: str = "text", post_id: str = "id") -> DataFrame:
    """Map mood words to class numbers and drop rows without a text or a valid id."""
    return raw.filter(non_empty(F.col(text)) & valid_id(F.col(post_id).cast("string"))).select(
        mood_label(F.col(mood)).alias("label"),
        F.col(text).alias("text"),
        F.col(post_id).cast("string").alias("id"),
    )
