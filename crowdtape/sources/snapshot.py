"""Parquet snapshots that are built once and read afterwards, and series export."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.sources.manifest import FILES, input_files, options_hash, states


def is_complete(spark: SparkSession, path: str) -> bool:
    """True when a job finished writing ``path``: its success marker is there.

    Part files left by a job that died do not count.
    """
    return exists(spark, f"{path}/_SUCCESS")


def _located(spark: SparkSession, path: str):
    """File system and path object of ``path``, on any store Hadoop reaches."""
    located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), located


def exists(spark: SparkSession, path: str) -> bool:
    system, located = _located(spark, path)
    return system.exists(located)


def is_file(spark: SparkSession, path: str) -> bool:
    system, located = _located(spark, path)
    return system.exists(located) and system.getFileStatus(located).isFile()


def mark(spark: SparkSession, path: str) -> None:
    """Leave an empty file at ``path``."""
    system, located = _located(spark, path)
    system.create(located).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete ``path`` with all below it; a missing one is no error."""
    system, located = _located(spark, path)
    system.delete(located, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders right below ``path``."""
    system, located = _located(spark, path)
    return [s.getPath().getName() for s in system.listStatus(located)] if system.exists(located) else []


def load_or_build(
    spark: SparkSession,
    path: str,
    build: Callable[[], DataFrame],
    partition_by: Sequence[str] = (),
    inputs: str | list[str] | None = None,
    options: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Read the snapshot at ``path``; if there is none, write ``build()`` there first.

    Only a missing or unfinished snapshot leads to a build. Any other failure,
    such as an unreadable file, is raised. What is returned is always read back
    from the files, so its lineage is short and every reader sees the same rows.

    With ``inputs`` (paths or globs of files) or ``options``, the snapshot also counts
    as missing when a file was added, changed or removed since, or an option differs.
    Files are listed before the build: one that arrives meanwhile leads to a build the
    next time. Where no input file is left, an existing snapshot stands.
    """
    if inputs is None and options is None:
        if not is_complete(spark, path):
            build().write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return spark.read.parquet(path)

    token = f"{options_hash(options or {})}-{uuid.uuid4().hex}"
    manifests = f"{path.rstrip('/')}.manifests"
    if inputs is not None:
        input_files(spark, inputs).write.parquet(f"{manifests}/{token}")
    if not _is_current(spark, path, manifests, token, inputs is not None):
        build().write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        # The marker lies in the snapshot, so the next build removes it with the rest.
        mark(spark, f"{path}/_made_of/{token}")
    (made_of,) = children(spark, f"{path}/_made_of")
    for other in set(children(spark, manifests)) - {made_of}:
        remove(spark, f"{manifests}/{other}")
    return spark.read.parquet(path)


def _is_current(spark: SparkSession, path: str, manifests: str, token: str, has_inputs: bool) -> bool:
    """Whether the snapshot is there and was made of the files and options of ``token``."""
    made_of = children(spark, f"{path}/_made_of")
    if not is_complete(spark, path) or len(made_of) != 1:
        return False
    if made_of[0].split("-")[0] != token.split("-")[0]:
        return False
    if not has_inputs:
        return True
    found = spark.read.schema(FILES).parquet(f"{manifests}/{token}")
    if found.isEmpty():
        return True
    if not is_complete(spark, f"{manifests}/{made_of[0]}"):
        return False
    return states(spark.read.schema(FILES).parquet(f"{manifests}/{made_of[0]}"), found) == {"same"}


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write ``df``, replacing the partitions it has rows of and no other; it may read ``path`` itself."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by).parquet(path)


def month_of(date: Column) -> Column:
    """Name of the monthly partition of a date."""
    return F.date_format(date, "yyyy-MM")


def between_dates(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Rows of ``df(date, month)`` with ``start`` <= date <= ``end``; other months are not read."""
    for bound, keep in ((start, "__ge__"), (end, "__le__")):
        if bound is not None:
            day = F.lit(bound).cast("date")
            df = df.filter(getattr(F.col("month"), keep)(month_of(day)) & getattr(F.col("date"), keep)(day))
    return df


def write_series(series: DataFrame, path: str, file_format: str = "parquet") -> None:
    """Write a report series as Parquet, or as CSV with a header."""
    writer = series.write.mode("overwrite")
    if file_format == "csv":
        writer = writer.option("header", True)
    writer.format(file_format).save(path)
