"""From raw post files to a store of distinct posts that follows its files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crowdtape.operators.dedupe import (
    dedupe,
    dedupe_against,
    filter_blocks,
    filter_fill,
    key_filter,
    merge_filters,
)
from crowdtape.operators.states import activity_of, daily_states, merge_states, negated
from crowdtape.schemas import POST
from crowdtape.sources.manifest import FILES, input_files, options_hash, states
from crowdtape.sources.raw_posts import parse_posts
from crowdtape.sources.snapshot import (
    between_dates,
    children,
    exists,
    is_complete,
    is_file,
    mark,
    month_of,
    overwrite_partitions,
    remove,
)

#: Sums kept per day next to the posts.
ACTIVITY = {"sum_shares": "retweets", "sum_likes": "favorites"}

STORED = T.StructType([*POST, T.StructField("month", T.StringType())])
PARSED = T.StructType(
    [*POST, *(T.StructField(n, T.StringType()) for n in ("reject_reason", "raw", "status", "batch"))]
)
FILTER = "block bigint, bits binary, blocks bigint"
CURRENT = "generation string, options string, manifest string"
#: A filter with more of its bits set is made anew with more blocks.
FULL = 0.5


def load_posts(
    spark: SparkSession,
    raw_path: str | list[str],
    snapshot_path: str,
    start: str | None = None,
    end: str | None = None,
    **parse_options: bool,
) -> tuple[DataFrame, DataFrame]:
    """Return the distinct posts (of some days) and the rejected lines of the raw files.

    The store at ``snapshot_path`` is brought up to date first, see :func:`sync_posts`.
    """
    sync_posts(spark, raw_path, snapshot_path, **parse_options)
    return read_posts(spark, snapshot_path, start, end), read_rejected(spark, snapshot_path)


def sync_posts(spark: SparkSession, raw_path: str | list[str], snapshot_path: str, **parse_options: bool) -> str:
    """Bring the store up to date with its files; returns ``same``, ``grown`` or ``built``.

    A manifest of the store names its files with length and time. New files are parsed
    by a file stream that remembers what it has read, and their posts are merged into
    the store: months that lose rows are rewritten, those that get some get files more. Changed or removed files, other
    options, or a merge that did not end lead to a new generation, which replaces the
    old one once it is whole. Where no raw file is left, the store stands as it is.
    """
    paths = [raw_path] if isinstance(raw_path, str) else list(raw_path)
    options = options_hash({"parse": parse_options, "paths": sorted(paths)})
    current = _current(spark, snapshot_path)
    manifest = f"manifest-{uuid.uuid4().hex}"
    # Listed before anything is read: what arrives meanwhile is found to be new the next time.
    input_files(spark, paths).write.parquet(f"{snapshot_path}/{manifest}")
    found = spark.read.schema(FILES).parquet(f"{snapshot_path}/{manifest}")
    if current is not None and found.isEmpty():
        remove(spark, f"{snapshot_path}/{manifest}")
        return "same"
    grows = current is not None and current.options == options
    if grows:
        known = spark.read.schema(FILES).parquet(f"{snapshot_path}/{current.manifest}")
        met = states(known, found)
        grows = met <= {"same", "added"} and not exists(spark, f"{snapshot_path}/{current.generation}/_merging")
        if grows and met == {"same"}:
            remove(spark, f"{snapshot_path}/{manifest}")
            return "same"
    generation = current.generation if grows else f"generation-{uuid.uuid4().hex}"
    for path in paths:
        _read_new_files(spark, path, f"{snapshot_path}/{generation}", parse_options)
    row = spark.createDataFrame([(generation, options, manifest)], CURRENT)
    row.coalesce(1).write.mode("overwrite").parquet(f"{snapshot_path}/current")
    for name in set(children(spark, snapshot_path)) - {"current", generation, manifest}:
        if name.startswith(("generation-", "manifest-")):
            remove(spark, f"{snapshot_path}/{name}")
    return "grown" if grows else "built"


def _current(spark: SparkSession, snapshot_path: str):
    """The pointer to the generation that counts, None where nothing whole is there."""
    if not is_complete(spark, f"{snapshot_path}/current"):
        return None
    return spark.read.schema(CURRENT).parquet(f"{snapshot_path}/current").first()


def _root(spark: SparkSession, snapshot_path: str) -> str:
    current = _current(spark, snapshot_path)
    if current is None:
        raise FileNotFoundError(f"no posts at {snapshot_path}: call load_posts first")
    return f"{snapshot_path}/{current.generation}"


def _read_new_files(spark: SparkSession, path: str, root: str, parse_options: Mapping[str, bool]) -> None:
    """Parse and merge the files of one path that the stream of this generation has not seen."""
    if input_files(spark, path).isEmpty():
        return
    name = options_hash({"path": path})

    def take(lines: DataFrame, number: int) -> None:
        _take_batch(spark, lines, root, f"{name}-{number:09d}", parse_options)

    # By default a stream passes over files much older than the newest one.
    source = _as_pattern(path) if is_file(spark, path) else path
    lines = spark.readStream.option("maxFileAge", "36500d").text(source)
    writer = lines.writeStream.foreachBatch(take).option("checkpointLocation", f"{root}/checkpoint-{name}")
    writer.trigger(availableNow=True).start().awaitTermination()


def _as_pattern(file: str) -> str:
    """A pattern that fits one file alone: streams read folders and patterns only."""
    folder, _, name = file.rpartition("/")
    pattern = re.sub(r"[A-Za-z0-9]", lambda c: f"[{c[0]}]", name, count=1)
    return f"{folder}/{pattern}" if folder else pattern


def _take_batch(
    spark: SparkSession, lines: DataFrame, root: str, batch: str, parse_options: Mapping[str, bool]
) -> None:
    """Parse one batch of lines in one pass, then merge its good posts; a second call changes nothing.

    The merge runs in the caller's session: that of a stream plans without run-time sizes.
    """
    if exists(spark, f"{root}/_merged/{batch}"):
        return
    parsed = parse_posts(lines, **parse_options)
    status = F.when(F.col("reject_reason").isNull(), "accepted").otherwise("rejected")
    parsed = parsed.withColumn("status", status).withColumn("batch", F.lit(batch))
    overwrite_partitions(parsed, f"{root}/parsed", ["status", "batch"])
    delta = _parsed(spark, root, "accepted").filter(F.col("batch") == batch).select(*POST.fieldNames())
    _merge(spark, root, delta, batch)
    mark(spark, f"{root}/_merged/{batch}")
    remove(spark, f"{root}/_merging")
    remove(spark, f"{root}/scratch")


def _parsed(spark: SparkSession, root: str, status: str) -> DataFrame:
    if not exists(spark, f"{root}/parsed"):
        return spark.createDataFrame([], PARSED)
    return spark.read.schema(PARSED).parquet(f"{root}/parsed").filter(F.col("status") == status)


def _merge(spark: SparkSession, root: str, delta: DataFrame, batch: str) -> None:
    """Add a batch's posts: one row per id, those with an empty id all, since they cannot be told apart."""

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{root}/scratch/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/scratch/{name}")

    first = dedupe(delta.filter("id <> ''"), "id", ["timestamp"])
    loose = delta.filter("id = '' OR id IS NULL")
    stored, blocks = None, 0
    if exists(spark, f"{root}/posts"):
        stored = spark.read.schema(STORED).parquet(f"{root}/posts")
        filters = spark.read.schema(FILTER).parquet(f"{root}/ids")
        blocks = filters.agg(F.max("blocks")).first()[0] or 0
    superseded = None
    if blocks:
        fresh, superseded = dedupe_against(first, stored, filters.select("block", "bits"), blocks, keep, part="month")
        superseded = keep(superseded, "superseded")
        superseded = None if superseded.isEmpty() else superseded
    else:
        fresh = first
    fresh = keep(fresh.unionByName(loose).withColumn("month", month_of(F.col("date"))), "fresh")

    # From here on the store changes; a run that finds this mark builds a new generation.
    mark(spark, f"{root}/_merging")
    _write_months(spark, root, stored, fresh, superseded)
    _write_filter(spark, root, fresh, batch, blocks)
    change = daily_states(fresh, ACTIVITY)
    if superseded is not None:
        change = merge_states(change.unionByName(negated(daily_states(superseded, ACTIVITY))), drop_empty=False)
    change = change.withColumn("month", month_of(F.col("date"))).withColumn("batch", F.lit(batch))
    overwrite_partitions(change.hint("rebalance", "month"), f"{root}/daily", ["month", "batch"])


def _write_months(
    spark: SparkSession, root: str, stored: DataFrame | None, fresh: DataFrame, superseded: DataFrame | None
) -> None:
    """Rewrite the months that lose rows, without a shuffle of their stored ones, and add files to those that only get some."""
    if superseded is not None:
        losing = superseded.select(month_of(F.col("date")).alias("month")).distinct()
        again = F.col("month").isin([row.month for row in losing.collect()])
        kept = stored.filter(again).join(superseded.select("id"), "id", "left_anti")
        content = kept.select(*STORED.fieldNames()).unionByName(fresh.filter(again).hint("rebalance", "month"))
        overwrite_partitions(content, f"{root}/posts", ["month"])
        fresh = fresh.filter(~again)
    # A merge that does not end leads to a new generation, so that no rows are added twice.
    added = fresh.hint("rebalance", "month").write.mode("overwrite" if stored is None else "append")
    added.option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(f"{root}/posts")


def _write_filter(spark: SparkSession, root: str, fresh: DataFrame, batch: str, blocks: int) -> None:
    """Add the new ids to the filter of stored ids, or make it anew when it has become too full."""
    ids = fresh.filter("id <> ''").select("id")
    older = [name for name in children(spark, f"{root}/ids") if name.startswith("batch=")]
    if blocks:
        known = spark.read.schema(FILTER).parquet(*(f"{root}/ids/{name}" for name in older)).select("block", "bits")
        merged = merge_filters(known, key_filter(ids, "id", blocks))
        if filter_fill(merged, blocks) > FULL:
            blocks = 0
    if not blocks:
        ids = spark.read.schema(STORED).parquet(f"{root}/posts").filter("id <> ''").select("id")
        blocks = filter_blocks(4 * ids.count())
        merged = key_filter(ids, "id", blocks)
    merged.withColumn("blocks", F.lit(blocks)).write.mode("overwrite").parquet(f"{root}/ids/batch={batch}")
    for name in older:
        if name != f"batch={batch}":
            remove(spark, f"{root}/ids/{name}")


def read_posts(
    spark: SparkSession, snapshot_path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The stored posts with ``start`` <= date <= ``end``; the folders of other months are not read."""
    root = _root(spark, snapshot_path)
    if not exists(spark, f"{root}/posts"):
        return spark.createDataFrame([], POST)
    posts = spark.read.schema(STORED).parquet(f"{root}/posts")
    return between_dates(posts, start, end).select(*POST.fieldNames())


def read_rejected(spark: SparkSession, snapshot_path: str) -> DataFrame:
    """Rejected lines with the reason."""
    return _parsed(spark, _root(spark, snapshot_path), "rejected").select("raw", "reject_reason")


def read_daily_states(
    spark: SparkSession, snapshot_path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """The state of each stored day, see ``operators.daily_states``; no post is read."""
    root = _root(spark, snapshot_path)
    empty = daily_states(spark.createDataFrame([], POST), ACTIVITY)
    schema = T.StructType([*empty.schema, *(T.StructField(n, T.StringType()) for n in ("month", "batch"))])
    if not exists(spark, f"{root}/daily"):
        return empty
    changes = between_dates(spark.read.schema(schema).parquet(f"{root}/daily"), start, end)
    return merge_states(changes.select(*empty.columns))


def read_daily_activity(
    spark: SparkSession, snapshot_path: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """``daily_activity`` of the stored posts, from the states of their days."""
    return activity_of(read_daily_states(spark, snapshot_path, start, end), list(ACTIVITY))
