"""A projection that filters are not pushed through."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fence(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Select ``columns`` so that Spark evaluates them once, here.

    Spark moves a filter below a projection by copying the projected expressions
    into it, which repeats expensive ones for each test, and pushes a different
    filter into each use of a common input, which then no longer is common. The
    rows of an exploded array of one are the same rows, but stay where they are.
    """
    return df.select(F.inline(F.array(F.struct(*columns))))
