"""What a snapshot was made of: its input files and its options."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILES = "file string, length bigint, modified timestamp"


def input_files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``file``, ``length`` and ``modified`` of every file below the paths or globs.

    A path without files adds none. Only the listing is read, never a file.
    """
    found = []
    for path in [paths] if isinstance(paths, str) else paths:
        try:
            listed = spark.read.format("binaryFile").load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found.append(listed.select(F.col("path").alias("file"), "length", F.col("modificationTime").alias("modified")))
    return reduce(DataFrame.unionByName, found) if found else spark.createDataFrame([], FILES)


def differences(known: DataFrame, found: DataFrame) -> DataFrame:
    """``file`` and ``state`` (added, changed, removed or same) of the files of either list."""
    was = known.select("file", F.struct("length", "modified").alias("was"))
    now = found.select("file", F.struct("length", "modified").alias("now"))
    state = (
        F.when(F.col("was").isNull(), "added")
        .when(F.col("now").isNull(), "removed")
        .when(F.col("was") == F.col("now"), "same")
        .otherwise("changed")
    )
    return was.join(now, "file", "full_outer").select("file", state.alias("state"))


def states(known: DataFrame, found: DataFrame) -> set[str]:
    """The states that any file is in."""
    return {row.state for row in differences(known, found).select("state").distinct().collect()}


def options_hash(options: Mapping[str, Any]) -> str:
    """A short name for a set of options, equal where they are."""
    text = json.dumps(options, sort_keys=True, default=str)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def content_hash(table: DataFrame | Mapping) -> str:
    """A name for the rows of a small table or the entries of a dictionary, in any order."""
    if isinstance(table, Mapping):
        return options_hash({str(key): value for key, value in table.items()})
    total = F.sum(F.xxhash64(*table.columns).cast("decimal(38,0)"))
    return "-".join(map(str, table.agg(F.count("*"), total).first()))
