"""Quality rules: rule statistics of whole texts, judged by an isolation forest.

``rule_statistics`` counts what the rules look at in one pass over the texts. The
forest splits random subsamples of these statistics at random places; documents
that few splits isolate are anomalous. The threshold on their score comes from
labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.llm.common import stored, table

#: Bounds of the labelled rows the trees are drawn from, and of the rows that replace them where no good row is labelled.
LABELLED_ROWS = 20_000
SAMPLE_ROWS = 20_000
#: Bad rows among those of the trees, as a share of the good ones and besides it: without any, junk lies in no tree's range.
BAD_SHARE, LEAST_BAD = 0.03, 4
#: Parts into which each pass of the search for a rank cuts the range of scores.
RANK_PARTS = 1024
#: Trees, and rows of each.
TREES = 256
TREE_ROWS = 128
#: Share of labelled good rows that the threshold may reject at most.
MAX_FALSE_REJECTS = 0.002
#: Score above which documents are rejected when there is nothing to calibrate with.
DEFAULT_THRESHOLD = 0.7
SEED = 17

SYMBOLS = b"#*$%&|<>"
UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

STATISTICS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_upper bigint, n_lines bigint"
)


def text_statistics(text: str) -> tuple[int, ...]:
    """The columns of ``STATISTICS`` for one text."""
    data = text.encode()
    words = data.split()  # at the same six ASCII characters as the contract's words
    spaces = len(data) - len(data.translate(None, b" \t\n\v\f\r"))
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(text) - spaces,
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(data) - len(data.translate(None, UPPER)),
        len(lines),
    )


def repeated_words(words: list[bytes], size: int = 3) -> int:
    """Words that lie in a window of ``size`` words found twice or more."""
    import numpy as np

    count = len(words) - size + 1
    if count < 2:
        return 0
    numbers = {word: n for n, word in enumerate(set(words))}
    ids = np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))
    windows = ids[:count]
    for at in range(1, size):
        if (int(windows.max()) + 1) * len(numbers) >= 1 << 62:
            windows = np.unique(windows, return_inverse=True)[1]
        windows = windows * len(numbers) + ids[at : at + count]
    ordered = np.sort(windows)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    covered = np.zeros(len(words), bool)
    for start in range(size):
        covered[start : start + count] |= np.isin(windows, twice)
    return int(covered.sum())


def rule_statistics(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row`` (columns ``keep`` of ``docs``) and the statistics of ``text``; null has no words."""

    def count(batches: Iterator) -> Iterator:
        import pyarrow as pa

        fields = [pa.field(name, pa.int64()) for name in _statistic_names()]
        for batch in batches:
            rows = [text_statistics(text.as_py() or "") for text in batch.column(0)]
            columns = list(zip(*rows, strict=True)) or [[]] * len(fields)
            arrays = [pa.array(c, "int64") for c in columns]
            schema = pa.schema([batch.schema.field(1), *fields])
            yield pa.RecordBatch.from_arrays([batch.column(1), *arrays], schema=schema)

    row = F.struct(*keep).alias("row")
    narrow = docs.select(F.col("text").cast("string"), row)
    kind = narrow.schema["row"].dataType.simpleString()
    return narrow.mapInArrow(count, f"row {kind}, {STATISTICS}")


def _statistic_names() -> list[str]:
    return [part.split(" ")[0] for part in STATISTICS.split(", ")]


def base_failed() -> Column:
    """Too short, or more than half of the words in repeated windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def feature_matrix(counts):
    """Shares that do not depend on a text's length, from columns in the order of ``STATISTICS``.

    Repetition is left to the base rules: clean texts now and then repeat a line,
    and would look as rare as junk.
    """
    import numpy as np

    n_words, word_chars, n_symbols, _, _, n_upper, _ = np.asarray(counts, "f8")
    words = np.maximum(n_words, 1)
    return np.column_stack(
        [word_chars / words, n_symbols / words, n_upper / np.maximum(word_chars, 1)]
    )


@dataclass
class Forest:
    """Trees as arrays: ``feature`` is -1 at a leaf, where ``value`` is the path length."""

    feature: list
    value: list
    left: list
    right: list
    norm: float

    def scores(self, rows):
        """2 ** (-mean path length / that of a random search); near 1 is anomalous."""
        import numpy as np

        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for feature, value, left, right in zip(self.feature, self.value, self.left, self.right, strict=True):
            node = np.zeros(len(rows), np.int64)
            while True:
                split = feature[node]
                inner = split >= 0
                if not inner.any():
                    break
                low = rows[every, np.maximum(split, 0)] < value[node]
                node = np.where(inner, np.where(low, left[node], right[node]), node)
            total += value[node]
        return 2.0 ** (-total / len(self.feature) / self.norm)


def search_length(n: int) -> float:
    """Mean path length of an unsuccessful search in a binary tree of ``n`` rows."""
    import math

    if n < 2:
        return 0.0
    return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n if n > 2 else 1.0


def fit_forest(rows, trees: int = TREES, tree_rows: int = TREE_ROWS, seed: int = SEED) -> Forest:
    """Grow isolation trees on random subsamples of a bounded sample of feature rows."""
    import math

    import numpy as np

    rng = np.random.default_rng(seed)
    size = min(tree_rows, len(rows))
    limit = math.ceil(math.log2(max(size, 2)))
    forest = Forest([], [], [], [], max(search_length(size), 1e-9))
    for _ in range(trees):
        nodes: list[list] = []

        def grow(part, depth, nodes=nodes):
            at = len(nodes)
            spread = part.max(0) > part.min(0) if len(part) else np.zeros(part.shape[1], bool)
            if depth >= limit or not spread.any():
                nodes.append([-1, depth + search_length(len(part)), 0, 0])
                return at
            feature = rng.choice(np.flatnonzero(spread))
            low, high = part[:, feature].min(), part[:, feature].max()
            value = rng.uniform(low, high)
            value = value if value > low else high
            nodes.append([feature, value, 0, 0])
            below = part[:, feature] < value
            nodes[at][2] = grow(part[below], depth + 1)
            nodes[at][3] = grow(part[~below], depth + 1)
            return at

        grow(rows[rng.choice(len(rows), size, replace=False)], 0)
        for name, column, kind in zip(
            ("feature", "value", "left", "right"), zip(*nodes, strict=True), ("i8", "f8", "i8", "i8"), strict=True
        ):
            getattr(forest, name).append(np.array(column, kind))
    return forest


def ranked_score(rows: DataFrame, rank: int) -> float:
    """The ``rank``-th largest ``anomaly`` (from 0) of ``rows``, exact, by counts of narrowing ranges."""
    ends = rows.agg(F.min("anomaly"), F.max("anomaly")).first()
    low, high = ends
    while low < high:
        part = F.floor((F.col("anomaly") - low) / (high - low) * RANK_PARTS)
        part = F.least(part, F.lit(RANK_PARTS - 1)).alias("part")
        inside = rows.where(F.col("anomaly").between(low, high)).groupBy(part)
        counts = inside.agg(F.count("*").alias("n"), F.min("anomaly").alias("low"), F.max("anomaly").alias("high"))
        for found in sorted(counts.collect(), key=lambda r: -r.part):
            if rank < found.n:
                low, high = found.low, found.high
                break
            rank -= found.n
    return low


def calibrate(scored: DataFrame, default: float = DEFAULT_THRESHOLD) -> float:
    """Threshold on ``anomaly`` that rejects most bad rows while losing at most ``MAX_FALSE_REJECTS`` of the good.

    All rows of ``scored(good, anomaly)`` count.
    """
    sizes = {r.good: r["count"] for r in scored.groupBy("good").count().collect()}
    if len(sizes) < 2:
        return default
    least = ranked_score(scored.where("good"), int(MAX_FALSE_REJECTS * sizes[True]))
    # Halfway to the next rejected row, so that rows just like the clean ones stay.
    above = scored.where(~F.col("good") & (F.col("anomaly") > least)).agg(F.min("anomaly")).first()[0]
    return float(least if above is None else (least + above) / 2)


def _sampled(df: DataFrame, key: Column, bound: int) -> DataFrame:
    """At most ``bound`` rows, those with the smallest hash.

    A sort with a limit sends ``bound`` rows of each task to the driver. So hashes
    that are too large to count are left out first, in a share that still leaves enough.
    """
    share = 4 * bound / max(df.count(), 1)
    while share < 1:
        few = df.where(key < F.lit(int(share * 2**64) - 2**63))
        if few.count() >= bound:
            return few.orderBy(key).limit(bound)
        share *= 4
    return df.orderBy(key).limit(bound)


def judge(docs: DataFrame, labels: DataFrame, keep: list[str]) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``), statistics, ``anomaly``, ``base_failed``, ``kept``.

    One row per row of ``docs``. A null or empty text has no words and fails the
    base rules. ``labels(doc_id, quality)`` calibrates: null labels and ids are left
    out, a document with several labels counts once with each; without good and bad
    rows the threshold is ``DEFAULT_THRESHOLD``. The trees come from at most
    ``LABELLED_ROWS`` labelled rows of the smallest hashes, the good ones and few bad
    ones (where none is good, from at most ``SAMPLE_ROWS`` of any rows); the threshold
    covers all labelled rows, statistics and scores every row. Repeated rows get equal results; other columns of ``docs`` are ignored unless kept.
    """
    spark = docs.sparkSession
    names = _statistic_names()
    counted = rule_statistics(docs.withColumn("doc_id", F.col("doc_id").cast("long")), keep)
    counted = stored(counted.select("row", *names), "statistics")
    fit_on = counted.where(~base_failed())
    marked = labels.where("quality IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("labelled"), (F.col("quality") > 0).alias("good")
    )
    known = fit_on.join(marked, F.col("row.doc_id") == F.col("labelled")).select("labelled", "good", *names)
    known = stored(known, "labelled")
    pool = _sampled(known, F.xxhash64("labelled", "good", *names), LABELLED_ROWS).select("good", *names).toPandas()
    good = pool["good"].astype(bool)
    pool = pd.concat([pool[good], pool[~good].head(LEAST_BAD + int(BAD_SHARE * good.sum()))])
    if not good.any():
        pool = _sampled(fit_on, F.xxhash64("row.doc_id", *names), SAMPLE_ROWS).select(*names).toPandas()
    forest, threshold = None, DEFAULT_THRESHOLD
    if len(pool):
        forest = fit_forest(feature_matrix(pool[names].to_numpy().T))
    model = spark.sparkContext.broadcast(vars(forest) if forest else None)  # plain arrays
    if forest:
        threshold = calibrate(stored(_score(known, names, model).select("good", "anomaly"), "labelled-scores"))

    scored = _score(counted, names, model) if forest else counted.withColumn("anomaly", F.lit(0.0))
    failed = base_failed()
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~failed & (F.col("anomaly") <= F.lit(threshold))
    )


def _score(counted: DataFrame, names: list[str], model) -> DataFrame:
    @F.pandas_udf("double")
    def anomaly(*columns: pd.Series) -> pd.Series:
        return pd.Series(Forest(**model.value).scores(feature_matrix([c.to_numpy() for c in columns])))

    return counted.withColumn("anomaly", anomaly(*names))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *columns, "base_failed", "kept", F.round("anomaly", 6).alias("anomaly"))
