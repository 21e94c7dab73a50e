"""Daily activity of posts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdtape.functions.dates import is_trading_day


def trading_days(
    df: DataFrame, date: str = "date", start: str | None = None, end: str | None = None
) -> DataFrame:
    """Keep rows dated Monday to Friday, optionally within ``start`` <= date <= ``end``.

    The weekday test runs on each row; the bounds are plain comparisons, which
    the Parquet reader uses to skip row groups and partitions.
    """
    kept = df.filter(is_trading_day(F.col(date)))
    if start is not None:
        kept = kept.filter(F.col(date) >= F.lit(start).cast("date"))
    if end is not None:
        kept = kept.filter(F.col(date) <= F.lit(end).cast("date"))
    return kept


def daily_activity(
    df: DataFrame,
    measures: Mapping[str, str] | None = None,
    date: str = "date",
    by: Sequence[str] = (),
) -> DataFrame:
    """Row count and measure sums per date, in a single aggregation.

    ``measures`` maps output names to the columns to sum; by default every
    numeric column is summed as ``sum_<column>``. ``by`` adds group columns,
    such as a ticker. Partial sums are formed before the shuffle, so a day with
    most of the rows costs its reducer one row per map task.
    """
    keys = [*by, date]
    if measures is None:
        measures = {
            f"sum_{field.name}": field.name
            for field in df.schema
            if isinstance(field.dataType, T.NumericType) and field.name not in keys
        }
    return df.groupBy(*keys).agg(
        F.count("*").alias("post_count"),
        *(F.sum(column).alias(name) for name, column in measures.items()),
    )
