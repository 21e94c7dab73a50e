"""Labels by the sessions of an exchange, through as-of joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crowdtape.functions.scores import direction_label


def asof_join(
    left: DataFrame,
    right: DataFrame,
    values: Sequence[str],
    date: str = "date",
    by: Sequence[str] = (),
    forward: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Add ``values`` of the nearest row of ``right`` that is not later (with ``forward``: not earlier).

    ``strict`` leaves out a row of the same date; of several rows of one date the largest
    values count; dates without such a row get nulls. Both sides are cut into months, so
    the search sorts a month in a task; what a month ends with is carried to the next
    ones over one row per month. Dates of ``left`` are looked up once each, however many
    rows they have, and then joined by equality.
    """
    found = "_found"
    sign = F.desc if forward else F.asc
    month = F.trunc(date, "month").alias("_month")
    value = F.struct(F.col(date).alias("_date"), *values)
    dates = left.select(*by, date).filter(F.col(date).isNotNull()).distinct()
    asked = dates.select(*by, date, F.lit(None).cast(right.select(value.alias("v")).schema["v"].dataType).alias("_value"))
    given = right.filter(F.col(date).isNotNull()).select(*by, date, value.alias("_value"))
    # At one date, what is given comes first, unless it must not count.
    order = F.when(F.col("_value").isNull(), 0 if strict else 1).otherwise(1 if strict else 0)
    rows = asked.unionByName(given).select("*", month, order.alias("_order"))

    within = Window.partitionBy(*by, "_month").orderBy(sign(date), "_order", "_value")
    within = within.rowsBetween(Window.unboundedPreceding, 0)
    nearest = rows.withColumn("_nearest", F.last("_value", True).over(within)).filter(F.col("_value").isNull())

    # Negated days make the first of a month its maximum; max_by passes over rows that ask.
    day = F.datediff(F.col(date), F.lit("1970-01-01").cast("date"))
    place = F.struct(-day if forward else day, F.col("_value"))
    last = F.max_by("_value", F.when(F.col("_value").isNotNull(), place))
    months = rows.groupBy(*by, "_month").agg(last.alias("_last"))
    carried = Window.partitionBy(*by).orderBy(sign("_month")).rowsBetween(Window.unboundedPreceding, -1)
    months = months.select(*by, "_month", F.last("_last", True).over(carried).alias("_carried"))
    looked_up = nearest.join(months, [*by, "_month"]).select(
        *by, date, F.coalesce("_nearest", "_carried").alias(found)
    )
    joined = left.join(looked_up, [*by, date], "left")
    return joined.select(*left.columns, *(F.col(f"{found}.{v}").alias(v) for v in values))


def session_labels(
    days: DataFrame,
    prices: DataFrame,
    sessions: DataFrame,
    date: str = "date",
    price: str = "close",
    by: Sequence[str] = (),
) -> DataFrame:
    """Label each day by the last price up to it and the first price of a later session.

    ``sessions(date)`` says on which days the exchange was open: prices of other days do
    not count, and no rule of weekdays is assumed. A day without a session (a holiday)
    keeps its row and has the price of the last session; a session that the prices lack
    is passed over. Adds ``price``, ``price_date``, ``next_price``, ``next_date`` and
    ``label``; before the first and after the last price they are null.
    """
    known = prices.filter(F.col(price).isNotNull()).join(sessions.select(date).distinct(), date, "left_semi")
    now = known.select(*by, date, F.col(price).alias("price"), F.col(date).alias("price_date"))
    later = known.select(*by, date, F.col(price).alias("next_price"), F.col(date).alias("next_date"))
    told = asof_join(days, now, ["price", "price_date"], date, by)
    told = asof_join(told, later, ["next_price", "next_date"], date, by, forward=True, strict=True)
    return told.withColumn("label", direction_label(F.col("price"), F.col("next_price")))
