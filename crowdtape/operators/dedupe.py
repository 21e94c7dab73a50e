"""Keep one row per key, in one table or against rows that are already stored."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERED = (T.MapType, T.VariantType)


def dedupe(
    df: DataFrame, key: str | Sequence[str] = "id", order: Sequence[str] = ("timestamp",)
) -> DataFrame:
    """Keep the first row of each key, by ``order`` and then by all other columns.

    With the remaining columns as tie-break, equal keys leave the same row on
    every run. Spark limits each key to one row before the shuffle, so a key
    with a third of all rows sends its reducer one row per map task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rest = [
        field.name
        for field in df.schema
        if field.name not in {*keys, *order} and not isinstance(field.dataType, _UNORDERED)
    ]
    first = Window.partitionBy(*keys).orderBy(*order, *rest)
    return (
        df.withColumn("_rank", F.row_number().over(first)).filter(F.col("_rank") == 1).drop("_rank")
    )


# --- against stored rows ----------------------------------------------------

#: Bits of one block of a filter (the size of Spark's bitmaps), probes of a key, and keys a block is made for.
BLOCK_BITS = 32768
PROBES = 8
BLOCK_KEYS = 2048

#: Rows that may repeat stored ones are broadcast up to this number.
BROADCAST_ROWS = 1_000_000


def filter_blocks(keys: int) -> int:
    """Blocks of a filter for so many keys, a power of two."""
    return 1 << max(0, -(-keys // BLOCK_KEYS) - 1).bit_length()


def _probes(key: str) -> Column:
    """Places of a key's bits within its block."""
    return F.array(*(F.pmod(F.xxhash64(F.lit(n), F.col(key)), F.lit(BLOCK_BITS)) for n in range(PROBES)))


def key_filter(df: DataFrame, key: str, blocks: int) -> DataFrame:
    """Bloom filter of the keys as rows (block, bits), one row per block with keys.

    Keys go to the task of their block first, so no task makes bits for blocks it has
    one key of.
    """
    hashed = df.select(F.pmod(F.xxhash64(key), F.lit(blocks)).alias("block"), key)
    dealt = hashed.repartition("block").select("block", F.explode(_probes(key)).alias("place"))
    return dealt.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits"))


def merge_filters(*filters: DataFrame) -> DataFrame:
    """The filter of all keys of filters with the same number of blocks."""
    return reduce(DataFrame.unionByName, filters).groupBy("block").agg(F.bitmap_or_agg("bits").alias("bits"))


def filter_fill(filters: DataFrame, blocks: int) -> float:
    """Share of the bits that are set."""
    return float(filters.agg(F.sum(F.bitmap_count("bits"))).first()[0] or 0) / (blocks * BLOCK_BITS)


def may_be_stored(df: DataFrame, filters: DataFrame, key: str, blocks: int) -> DataFrame:
    """``df`` with ``may_be_stored``: false only for keys that the filter was not made of."""

    def is_set(place: Column) -> Column:
        byte = F.substring("bits", F.shiftright(place.cast("int"), 3) + 1, F.lit(1))
        return F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (place % 8).cast("int")) == 1

    hashed = df.withColumn("block", F.pmod(F.xxhash64(key), F.lit(blocks)))
    met = hashed.join(filters, "block", "left")
    found = F.col("bits").isNotNull() & F.forall(_probes(key), is_set)
    return met.withColumn("may_be_stored", found).drop("block", "bits")


def dedupe_against(
    delta: DataFrame,
    stored: DataFrame,
    filters: DataFrame,
    blocks: int,
    keep: Callable[[DataFrame, str], DataFrame],
    key: str = "id",
    order: Sequence[str] = ("timestamp",),
    part: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(fresh, superseded)``: rows of ``delta`` to add to ``stored``, and stored rows that these replace.

    Both sides have one row per key. The outcome is that of :func:`dedupe` over both:
    the first by ``order`` and all other columns stays, the stored one if all are
    equal. ``filters`` covers the stored keys. Rows it does not know are fresh without
    a look at the stored ones; the others meet these in an exact join, which reads the
    stored keys where they lie and shuffles none of them while the others are few.
    Whole rows are then read from the partitions (by column ``part``) with repeats alone.
    ``keep(df, name)`` writes an intermediate table and reads it back.
    """
    judged = keep(may_be_stored(delta, filters, key, blocks), "judged")
    new = judged.filter(~F.col("may_be_stored")).drop("may_be_stored")
    possible = judged.filter("may_be_stored").drop("may_be_stored")
    ids = possible.select(key)
    if possible.count() <= BROADCAST_ROWS:
        ids = F.broadcast(ids)
    hits = keep(stored.select(key, *[part] * bool(part)).join(ids, key, "left_semi"), "hits")
    few = hits.count() <= BROADCAST_ROWS
    if part:
        parts = [row[0] for row in hits.select(part).distinct().collect()]
        stored = stored.filter(F.col(part).isin(parts))
    hits = F.broadcast(hits.select(key)) if few else hits.select(key)
    met = keep(stored.select(*delta.columns).join(hits, key, "left_semi"), "met")
    both = met.withColumn("is_new", F.lit(False)).unionByName(possible.withColumn("is_new", F.lit(True)))
    won = keep(dedupe(both, key, order).filter("is_new").drop("is_new"), "won")
    return new.unionByName(won), met.join(won.select(key), key, "left_semi")
