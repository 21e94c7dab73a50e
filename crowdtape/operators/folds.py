"""Cross-validation folds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtape.operators.sampling import random_order


def fold_column(
    df: DataFrame,
    key: str | Sequence[str] = "date",
    k: int = 10,
    seed: int = 100,
    output: str = "fold",
) -> DataFrame:
    """Add the fold of each row, 0 to ``k`` - 1, from a hash of seed and key.

    Folds are drawn independently per key, are about equally large, and do not
    depend on how the rows are partitioned.
    """
    keys = [key] if isinstance(key, str) else list(key)
    draw = F.conv(F.substring(random_order(keys, seed), 1, 8), 16, 10).cast("bigint")
    return df.withColumn(output, F.pmod(draw, F.lit(k)).cast("int"))
