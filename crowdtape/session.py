"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Only settings that change results or plans. Master, memory and the number of
# shuffle partitions belong to the deployment.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app_name: str = "crowdtape", **extra: str) -> SparkSession:
    """Return the running session, or start one with :data:`SETTINGS`."""
    builder = SparkSession.builder.appName(app_name)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def counting_session(spark: SparkSession) -> SparkSession:
    """A session with the same settings for jobs whose rows are observed.

    A session that has observed a job cannot be sent to tasks any more, which the
    evaluation of a model does with the session of its rows.
    """
    other = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if other.conf.isModifiable(name):
            other.conf.set(name, value)
    return other


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """Return a fresh folder name below ``spark.checkpoint.dir``.

    Every executor must see the folder, so on a cluster the setting has to be
    there; only a local session, where it is unset, falls back to a new
    temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="crowdtape-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: While a table is written: drop the shuffle files once it is there; describe long plans in short.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.maxPlanStringLength": "100000",
}


def stored(df: DataFrame, purpose: str, scratch: list[str] | None = None, **options: int) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; its path is added to ``scratch``.

    Cuts the lineage: later steps read files that every executor sees, so a lost
    executor costs no recomputation of what came before, and the shuffle files that
    led to the table are not needed any more. ``options`` are those of the writer.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    before = {name: spark.conf.get(name, None) for name in WRITING}
    for name, value in WRITING.items():
        spark.conf.set(name, value)
    try:
        df.write.options(compression="zstd", **options).parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    if scratch is not None:
        scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop(spark: SparkSession, scratch: list[str]) -> None:
    """Delete scratch tables that no result reads any more: all that was made of them is written."""
    for path in scratch:
        located = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        located.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(located, True)
    scratch.clear()
