"""Price-direction labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdtape.fence import fence
from crowdtape.functions.dates import is_trading_day, previous_trading_day
from crowdtape.functions.scores import direction_label

MODES = ("calendar", "next_row")


def next_day_label(
    prices: DataFrame,
    mode: str = "calendar",
    date: str = "date",
    price: str = "close",
    by: Sequence[str] = (),
) -> DataFrame:
    """Pair each day's price with the next trading day's and label the direction.

    Returns ``by``, ``date``, ``price``, ``next_price`` and ``label``.

    * ``calendar``: the next trading day is the next calendar day, or Monday
      after a Friday. A day whose next trading day has no price drops out.
      Weekend prices are left out, and two prices for one (by, date) are an error.
    * ``next_row``: the next dated row of the series, however far away. ``by``
      splits the series between tasks; one series has one row per trading day.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")
    # Fenced, so that both sides of the join read one and the same price table.
    series = fence(prices, *by, date, F.col(price).alias("price"))
    if mode == "next_row":
        following = Window.partitionBy(*by).orderBy(date)
        paired = series.withColumn("next_price", F.lead("price").over(following)).withColumn(
            "has_next", F.lead(F.lit(True)).over(following)
        )
        paired = paired.filter("has_next").drop("has_next")
    else:
        series = series.filter(is_trading_day(F.col(date)))
        once = series.groupBy(*by, date).agg(F.first("price").alias("price"), F.count("*").alias("_n"))
        twice = F.raise_error(F.concat(F.lit("two prices for "), F.col(date).cast("string")))
        price_once = F.when(F.col("_n") == 1, F.col("price")).otherwise(twice.cast("double"))
        series = once.select(*by, date, price_once.alias("price"))
        shifted = series.select(
            *by,
            previous_trading_day(F.col(date)).alias(date),
            F.col("price").alias("next_price"),
        )
        paired = series.join(shifted, [*by, date])
    return paired.withColumn("label", direction_label(F.col("price"), F.col("next_price")))
