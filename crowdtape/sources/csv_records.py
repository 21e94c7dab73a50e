"""Records of large CSV files, found in parallel.

A quoted field may hold line breaks, so whether a line starts a record depends on all
lines before it. But a line only maps the state before it (outside or inside a quoted
field) to the state behind it, and such maps compose. Two scans of prefixes find every
state: one over the lines of each split of a file, one over the splits of each file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Where a reader of a line stands when it meets a quote.
FIELD_START, UNQUOTED, QUOTED, CLOSING = range(4)


def _ends_quoted(pieces: Column, start: int) -> Column:
    """Whether a line, cut at its quotes, ends inside a quoted field when read from ``start``.

    A quote opens a field at its first character only; within one, a doubled quote is a
    character, and what follows a single one belongs to the field up to the separator.
    """

    def meet(state: Column, piece: Column) -> Column:
        opens = F.when(F.endswith(piece, F.lit(",")), QUOTED).otherwise(UNQUOTED)
        return (
            F.when(state == QUOTED, CLOSING)
            .when(((state == CLOSING) | (state == FIELD_START)) & (piece == ""), QUOTED)
            .otherwise(opens)
        )

    before_quotes = F.slice(pieces, F.lit(1), F.size(pieces) - 1)
    return F.aggregate(before_quotes, F.lit(start), meet) == QUOTED


def _scan(df: DataFrame, parts: list[str], order: str) -> DataFrame:
    """Add ``from_outside`` and ``from_inside``: the state before each row, by the state before its part.

    ``outside`` and ``inside`` say whether a row ends inside when it starts outside or
    inside. A row that turns the state is counted; one that ends in the same state from
    either hides all before it.
    """
    upto = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*parts).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    turns = F.col("outside") & ~F.col("inside")
    fixed = F.col("outside") == F.col("inside")
    counted = df.withColumn("_turns", F.sum(turns.cast("long")).over(upto))
    last_fixed = F.when(fixed, F.struct(F.col("outside").alias("state"), F.col("_turns").alias("turns")))
    passed = F.coalesce(F.last("_turns").over(before), F.lit(0))
    found = counted.withColumn("_fixed", F.last(last_fixed, True).over(before)).withColumn("_passed", passed)
    odd = (F.col("_passed") - F.coalesce(F.col("_fixed.turns"), F.lit(0))) % 2 == 1

    def state(start: bool) -> Column:
        return F.coalesce(F.col("_fixed.state"), F.lit(start)) != odd

    return found.select(*df.columns, state(False).alias("from_outside"), state(True).alias("from_inside"))


def _behind(start: Column) -> Column:
    return F.when(start, F.col("inside")).otherwise(F.col("outside"))


def read_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file``, ``number`` (from 0 in each file) and text ``record`` of the records of CSV files.

    Fields are separated by commas and quoted with ``"``, doubled within. Blank lines
    outside quotes are no records. A file is read in as many splits as Spark cuts it
    into; lines are dealt once, by split, and only records of several lines once more.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    pieces = F.split("value", '"', -1)
    quoted = F.contains("value", F.lit('"'))
    lines = lines.select(
        "*",
        (quoted & _ends_quoted(pieces, FIELD_START)).alias("outside"),
        (~quoted | _ends_quoted(pieces, QUOTED)).alias("inside"),
    )
    by_split = _scan(lines, ["file", "block"], "row")

    def starts(state: str) -> Column:
        return ~F.col(state) & (F.col("value") != "")

    splits = by_split.groupBy("file", "block").agg(
        F.max_by(_behind(F.col("from_outside")), "row").alias("outside"),
        F.max_by(_behind(F.col("from_inside")), "row").alias("inside"),
        F.sum(starts("from_outside").cast("long")).alias("n_outside"),
        F.sum(starts("from_inside").cast("long")).alias("n_inside"),
    )
    # A file starts outside; splits are few, one row for each.
    placed = _scan(splits, ["file"], "block").withColumn(
        "n", F.when(F.col("from_outside"), F.col("n_inside")).otherwise(F.col("n_outside"))
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.select(
        "file",
        "block",
        F.col("from_outside").alias("split_inside"),
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"),
    )
    state = F.when(F.col("split_inside"), F.col("from_inside")).otherwise(F.col("from_outside"))
    told = by_split.join(placed, ["file", "block"]).withColumn("continues", state)
    inside_split = Window.partitionBy("file", "block").orderBy("row").rowsBetween(Window.unboundedPreceding, 0)
    numbered = told.select(
        "file",
        (F.col("first") + F.sum(starts("continues").cast("long")).over(inside_split) - 1).alias("number"),
        "block",
        "row",
        "value",
        "continues",
        _behind(F.col("continues")).alias("goes_on"),
    ).filter(F.col("continues") | (F.col("value") != ""))
    whole = numbered.filter(~F.col("continues") & ~F.col("goes_on")).select(
        "file", "number", F.col("value").alias("record")
    )
    parts = numbered.filter(F.col("continues") | F.col("goes_on"))
    joined = parts.groupBy("file", "number").agg(
        F.sort_array(F.collect_list(F.struct("block", "row", "value"))).alias("lines")
    )
    return whole.unionByName(
        joined.select("file", "number", F.array_join(F.col("lines.value"), "\n").alias("record"))
    )
