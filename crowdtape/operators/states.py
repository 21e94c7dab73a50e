"""Daily tables as sums that add up, so that a delta of posts updates them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sums of squares of whole numbers stay exact.
SQUARES = "decimal(38,0)"


def daily_states(
    df: DataFrame, measures: Mapping[str, str], date: str = "date", by: Sequence[str] = ()
) -> DataFrame:
    """Partial state of each day: its rows and, for each measure, its known values, their sum and squares.

    ``measures`` maps output names to columns of whole numbers. States of disjoint rows
    add up to that of all, and the state of removed rows is subtracted with
    :func:`negated`, both exactly.
    """
    parts = [F.count("*").alias("rows")]
    for name, column in measures.items():
        value = F.col(column).cast("bigint")
        parts += [
            F.count(value).alias(f"{name}_n"),
            F.sum(value).alias(f"{name}_sum"),
            F.sum((value.cast(SQUARES) * value).cast(SQUARES)).cast(SQUARES).alias(f"{name}_squares"),
        ]
    states = df.groupBy(*by, date).agg(*parts)
    return states.fillna(0) if measures else states


def _numbers(states: DataFrame) -> list[str]:
    return [n for n in states.columns if n == "rows" or n.endswith(("_n", "_sum", "_squares"))]


def negated(states: DataFrame) -> DataFrame:
    numbers = _numbers(states)
    return states.select(*(c for c in states.columns if c not in numbers), *((-F.col(c)).alias(c) for c in numbers))


def merge_states(states: DataFrame, drop_empty: bool = True) -> DataFrame:
    """One state per day; days whose rows are all gone disappear, unless they are to be merged again."""
    numbers = _numbers(states)
    kinds = dict(states.dtypes)
    keys = [c for c in states.columns if c not in numbers]
    merged = states.groupBy(*keys).agg(*(F.sum(c).cast(kinds[c]).alias(c) for c in numbers))
    return merged.filter(F.col("rows") != 0) if drop_empty else merged


def activity_of(states: DataFrame, measures: Sequence[str]) -> DataFrame:
    """The columns of ``daily_activity``: ``post_count`` and one sum per measure, null where no value is known."""
    keys = [c for c in states.columns if c not in _numbers(states)]
    sums = (F.when(F.col(f"{m}_n") > 0, F.col(f"{m}_sum")).alias(m) for m in measures)
    return states.select(*keys, F.col("rows").alias("post_count"), *sums)


def moments_of(states: DataFrame, measures: Sequence[str]) -> DataFrame:
    """Mean and sample deviation of each measure's values on each day, from the sums."""
    keys = [c for c in states.columns if c not in _numbers(states)]
    columns = []
    for m in measures:
        n, total, squares = (F.col(f"{m}_{part}") for part in ("n", "sum", "squares"))
        # Whole numbers up to here: no difference of rounded sums.
        spread = (n.cast(SQUARES) * squares - total.cast("decimal(19,0)") * total.cast("decimal(19,0)")).cast("double")
        variance = F.when(n > 1, spread / n / (n - 1))
        columns += [F.when(n > 0, total / n).alias(f"{m}_mean"), F.sqrt(variance).alias(f"{m}_sd")]
    return states.select(*keys, *columns)
