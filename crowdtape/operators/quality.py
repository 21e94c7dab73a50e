"""Row counts of pipeline steps and of classes."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def class_balance(df: DataFrame, label: str = "label") -> DataFrame:
    """Number of rows per label, in one scan."""
    return df.groupBy(label).agg(F.count("*").alias("rows"))


def step_counts(steps: Mapping[str, DataFrame]) -> DataFrame:
    """Number of rows of each named DataFrame, as one table from one job.

    Exchanges the steps have in common run once. A step that was written as a
    snapshot is counted from the Parquet footers.
    """
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("step"), "rows")
        for name, df in steps.items()
    ]
    return reduce(DataFrame.unionByName, counts)


class StepCounter:
    """Counts the rows of steps in the job that makes them, without a scan of its own.

    The steps should belong to a ``counting_session``.
    Pass it as ``watch`` to a plan, run the plan (by writing its result, say), then ask
    for :meth:`counts`. A step counts what the first job that runs it passes on, so a
    step that two branches of a plan read is watched in one of them. Where a lost
    executor makes Spark run tasks again, their rows may count twice.
    """

    def __init__(self) -> None:
        self._seen: dict[str, Observation] = {}

    def __call__(self, df: DataFrame, step: str) -> DataFrame:
        self._seen[step] = Observation()
        return df.observe(self._seen[step], F.count(F.lit(1)).alias("rows"))

    def counts(self, spark: SparkSession) -> DataFrame:
        """Table (step, rows) of the steps, once a job has run them; waits for it."""
        found = [(step, int(seen.get["rows"])) for step, seen in self._seen.items()]
        return spark.createDataFrame(found, "step string, rows bigint")


def unwatched(df: DataFrame, step: str) -> DataFrame:
    """The ``watch`` of plans whose steps nobody counts."""
    return df
