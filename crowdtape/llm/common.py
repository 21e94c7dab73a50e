"""What several operators share: scratch tables, flat files, words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.session import drop, stored  # noqa: F401

#: White space that ends a word; everything else belongs to words.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: A-Z to a-z and nothing else, for Python strings.
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def open_folder(uri: str):
    """File system and path of a shared folder, for tasks that write or read flat files."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def new_name(suffix: str) -> str:
    """A file name that no other attempt of the same task uses."""
    return f"{uuid.uuid4().hex}{suffix}"


def string_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
