"""Standard scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zscore(df: DataFrame, column: str, output: str = "z") -> DataFrame:
    """Add ``output``: ``column`` minus its mean, over its sample standard deviation.

    A single row or a constant column gives 0. Mean and deviation come from one
    aggregation used as scalar subqueries, so no row has to meet all others in
    one task, as it would in a window over the whole table.
    """
    value = F.col(column).cast("double")
    stats = df.agg(F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"))
    mean = stats.select("mean").scalar()
    sd = stats.select("sd").scalar()
    scaled = (value - mean) / F.nullif(sd, F.lit(0.0))
    return df.withColumn(output, F.when(value.isNotNull(), F.coalesce(scaled, F.lit(0.0))))
