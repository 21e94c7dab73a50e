"""Reproducible random samples with a fixed size per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Fixed value: posts scored per day.
MAX_PER_DAY = 200


def random_order(key: Sequence[str], seed: int) -> Column:
    """A hash of seed and key: random across keys, the same on every run."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *key))


def cap_per_group(
    df: DataFrame,
    group: str | Sequence[str] = "date",
    key: str | Sequence[str] = "id",
    cap: int = MAX_PER_DAY,
    seed: int = 0,
    salts: int = 64,
) -> DataFrame:
    """Keep at most ``cap`` random rows of each group, the same ones on every run.

    ``key`` must tell the rows of a group apart. Rows are ranked twice: first
    within the group's share of a salt, then within the whole group. The best
    ``cap`` of all are among the best ``cap`` of any share, so the result does
    not depend on the salt, and a group with most of the rows is spread over
    ``salts`` tasks. The salt is the number of the map task: a task holds one
    share of a group, which lets Spark drop all but ``cap`` rows per group
    before the first shuffle.

    Spark only does that up to ``spark.sql.optimizer.windowGroupLimitThreshold``;
    beyond it every row is shuffled, and the salts grow to all shuffle partitions.
    """
    groups = [group] if isinstance(group, str) else list(group)
    keys = [key] if isinstance(key, str) else list(key)
    conf = df.sparkSession.conf
    if cap > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        salts = max(salts, int(conf.get("spark.sql.shuffle.partitions")))

    order = ["_order", *keys]
    share = Window.partitionBy(*groups, "_salt").orderBy(*order)
    whole = Window.partitionBy(*groups).orderBy(*order)
    rank = F.row_number()
    return (
        df.withColumns(
            {
                "_order": random_order(keys, seed),
                "_salt": F.pmod(F.spark_partition_id(), F.lit(salts)),
            }
        )
        .withColumn("_rank", rank.over(share))
        .filter(F.col("_rank") <= cap)
        .drop("_rank", "_salt")
        .withColumn("_rank", rank.over(whole))
        .filter(F.col("_rank") <= cap)
        .drop("_rank", "_order")
    )
