"""The given tables seen as posts, prices and labelled posts, for queries and tests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.functions.dates import is_trading_day
from crowdtape.sources.labeled import COLUMNS
from crowdtape.sources.raw_posts import HEADER

# Tokens frequent in the given documents, spread over all polarities.
LEXICON = {"the": 1, "of": -1, "with": 1, "to": -1, "from": 2, "re": -2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One post per event, without its text."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("id"),
        F.col("ts").alias("timestamp"),
        F.to_date("ts").alias("date"),
        F.col("user_id").cast("string").alias("username"),
        (F.col("event_id") % 17).cast("int").alias("retweets"),
        F.floor("value").cast("int").alias("favorites"),
    )


def with_document(spark: SparkSession, sf_dir: str, some_posts: DataFrame, documents: DataFrame):
    """Add the columns of ``documents``: those of the document the post's number falls on."""
    number = table(spark, sf_dir, "documents").agg(F.count("*").alias("n")).scalar()
    numbered = some_posts.withColumn("doc_id", F.col("id").cast("bigint") % number)
    return documents.join(numbered, "doc_id").drop("doc_id")


def _daily_ohlc(trades: DataFrame, keys: list[str]) -> DataFrame:
    """Event numbers are in time order, so the lowest is the first trade of the day."""
    return trades.groupBy(*keys).agg(
        F.min_by("value", "event_id").alias("open"),
        F.max("value").alias("high"),
        F.min("value").alias("low"),
        F.max_by("value", "event_id").alias("close"),
        F.count("*").alias("volume"),
        F.max_by("value", "event_id").alias("adjClose"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices on weekdays: purchase events are the trades."""
    trades = table(spark, sf_dir, "events").filter("event_type = 'purchase'")
    trades = trades.withColumn("date", F.to_date("ts")).filter(is_trading_day(F.col("date")))
    return _daily_ohlc(trades, ["date"])


def ticker_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily prices on weekdays of one series per event type."""
    trades = table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    trades = trades.withColumnRenamed("event_type", "ticker")
    return _daily_ohlc(trades.filter(is_trading_day(F.col("date"))), ["ticker", "date"])


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the posts of a long history."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("string").alias("id"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_linenumber").alias("retweets"),
        F.col("l_quantity").cast("int").alias("favorites"),
    )


def order_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One price per weekday of the long history: the total of the day's last order."""
    orders = table(spark, sf_dir, "orders").withColumn("date", F.to_date("o_orderdate"))
    return (
        orders.filter(is_trading_day(F.col("date")))
        .groupBy("date")
        .agg(F.max_by("o_totalprice", "o_orderkey").alias("close"))
    )


# Planted holidays of the long history, as month and day.
HOLIDAYS = ("01-01", "07-04", "12-25")


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weekdays with orders, but no holidays: the days on which the exchange was open."""
    dates = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("date")).distinct()
    return dates.filter(is_trading_day(F.col("date")) & ~F.date_format("date", "MM-dd").isin(*HOLIDAYS))


def mood_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with the mood as a word: (id, text, mood)."""
    labels = table(spark, sf_dir, "labels")
    mood = (
        F.when(F.col("toxic") == 1, "negative")
        .when(F.col("quality") == 1, "positive")
        .otherwise("neutral")
    )
    return (
        table(spark, sf_dir, "documents")
        .join(labels, "doc_id")
        .select(F.col("doc_id").cast("string").alias("id"), "text", mood.alias("mood"))
    )


def mood_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled documents in the columns of the labelled file."""
    known = {"tweet_id": "id", "airline_sentiment": "mood", "text": "text"}
    columns = [F.col(known[c]) if c in known else F.lit(None).cast("string") for c in COLUMNS]
    rows = mood_rows(spark, sf_dir)
    return rows.select(*(value.alias(name) for name, value in zip(COLUMNS, columns, strict=True)))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stand-in predictions: a label and three votes per event, from its fields."""
    n = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("date"),
        n.cast("string").alias("id"),
        F.col("props").alias("text"),
        (F.col("user_id") % 3).cast("double").alias("label"),
        (n % 3).cast("double").alias("forest_prediction"),
        (F.floor(n / 3) % 3).cast("double").alias("perceptron_prediction"),
        (F.floor(F.col("value")) % 3).cast("double").alias("bayes_prediction"),
    )


def _line(time: Column, retweets: Column, post_id: Column, text: Column, permalink: str) -> Column:
    quoted = [F.concat(F.lit('"'), c, F.lit('"')) for c in (text, post_id)]
    return F.concat_ws(
        ";",
        F.col("user_id").cast("string"),
        time,
        retweets.cast("string"),
        F.floor("value").cast("string"),
        quoted[0],
        F.lit(""),
        F.lit("@u"),
        F.lit("#t"),
        quoted[1],
        F.lit(permalink),
    )


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event as a header, a good line and a line broken in one of four ways."""
    return _event_lines(table(spark, sf_dir, "events"))


def _event_lines(events: DataFrame) -> DataFrame:
    n = F.col("event_id")
    time = F.date_format("ts", "yyyy/MM/dd HH:mm")
    number = n % 17
    post_id = n.cast("string")
    text = F.concat(F.col("event_type"), F.lit(";"), F.replace("props", F.lit('"'), F.lit('""')))
    link = "http://x/p"
    broken = (
        F.when(n % 4 == 0, _line(F.lit("2024/13/40 25:61"), number, post_id, text, link))
        .when(n % 4 == 1, _line(time, F.concat(number, F.lit("x")), post_id, text, link))
        .when(n % 4 == 2, _line(time, number, F.concat(post_id, F.lit("a")), text, link))
        .otherwise(_line(time, number, post_id, text, ""))
    )
    return events.select(
        F.explode(F.array(F.lit(HEADER), _line(time, number, post_id, text, link), broken)).alias(
            "value"
        )
    )


def deliveries(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Raw lines in a base and three deltas, one or some types of events after the other.

    The last delta repeats stored posts: errors an hour later, signups 40 days earlier.
    """
    events = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    kind = F.col("event_type")
    again = F.when(kind == "error", F.make_dt_interval(hours=F.lit(1)))
    again = again.when(kind == "signup", F.make_dt_interval(days=F.lit(-40)))
    repeated = events.withColumn("ts", F.col("ts") + again).filter(again.isNotNull())
    return [
        _event_lines(part)
        for part in (
            events.filter(~kind.isin("click", "purchase")),
            events.filter(kind == "click"),
            events.filter(kind == "purchase"),
            repeated,
        )
    ]


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each whole document as the text of one line, on which line breaks become blanks."""
    text = F.replace(F.translate("text", "\r\n", "  "), F.lit('"'), F.lit('""'))
    return table(spark, sf_dir, "documents").select(
        F.concat_ws(
            ";",
            "source",
            F.lit("2024/1/2 3:04"),
            (F.col("doc_id") % 17).cast("string"),
            F.col("n_chars").cast("string"),
            F.concat(F.lit('"'), text, F.lit('"')),
            F.lit(""),
            F.lit(""),
            F.col("lang"),
            F.concat(F.lit('"'), F.col("doc_id").cast("string"), F.lit('"')),
            F.lit("http://x/d"),
        ).alias("value")
    )
