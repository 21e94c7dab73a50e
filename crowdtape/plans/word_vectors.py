"""Word vectors from co-occurrence counts, made in many tasks and the same in every partitioning.

The positive pointwise mutual information of words and their neighbours is a symmetric
sparse matrix. Its leading eigenvectors come from a randomised subspace iteration: the
start is a hash of each word, a step is a join and a grouped sum, and only matrices of
the size of the subspace reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from crowdtape.functions.text import tokens
from crowdtape.session import drop, stored

#: Entries of a vector, neighbours on either side, and directions of the subspace beside those that are kept.
VECTOR_SIZE = 50
WINDOW = 5
OVERSAMPLING = 10
#: Multiplications with the matrix after the first one.
STEPS = 2
#: Pairs seen fewer times say more about chance than about words, and are most of all pairs.
LEAST = 2
#: Pairs are shuffled in passes of so many, in at most so many passes, told apart by one of so many shares of each word.
COUNT_PAIRS, COUNT_PASSES, SHARES = 50_000_000, 8, 64
#: Characters of the texts whose words' vectors one task holds, and words of texts that are added up at a time.
MEAN_CHARACTERS, MEAN_WORDS = 24_000_000, 1 << 16


def _token_lists(texts: DataFrame, text: str, scratch: list[str]) -> DataFrame:
    """``words``, the tokens of each text, and ``shares``, a small number by the hash of each: worked out once."""
    lists = texts.filter(F.col(text).isNotNull()).select(tokens(F.col(text)).alias("words"))
    share = F.transform("words", lambda word: F.pmod(F.xxhash64(word), F.lit(SHARES)).cast("byte"))
    return stored(lists.select("words", share.alias("shares")), "token-lists", scratch)


def _totals(lists: DataFrame, window: int) -> DataFrame:
    """``word`` and ``total``, the pairs it is in, counted from its places and not from the pairs."""
    placed = lists.select(F.size("words").alias("size"), F.posexplode("words").alias("at", "word"))
    before, after = F.least("at", F.lit(window)), F.least(F.col("size") - 1 - F.col("at"), F.lit(window))
    total = placed.groupBy("word").agg(F.sum(before + after).alias("total"))
    return total.filter("total > 0")


def _counted_pairs(lists: DataFrame, window: int, least: int, scratch: list[str] | None = None) -> DataFrame:
    """``word``, ``context`` and ``n`` of the pairs seen ``least`` times or more, both ways; stored tables of ``scratch``.

    A pair is counted under one string, whichever of its words comes first. Pairs are
    dealt into passes by the sum of their words' shares, and one pass is shuffled after the other, so
    that shuffle files hold one pass at most; of each, only what was seen often enough is kept.
    """
    number = lists.agg(F.sum(F.size("words"))).first()[0] or 0
    passes = max(1, min(COUNT_PASSES, -(-number * window // COUNT_PAIRS)))
    # Rows of a place and a gap, not arrays of pairs: all of it is compiled into one loop.
    gaps = F.explode(F.array(*(F.lit(gap) for gap in range(1, window + 1)))).alias("gap")
    placed = lists.select("*", F.posexplode("words").alias("at", "word")).select("*", gaps)
    there = F.col("at") + F.col("gap")
    placed = placed.filter(there < F.size("words"))
    share = F.get("shares", F.col("at")).cast("int") + F.get("shares", there).cast("int")
    word, context = F.col("word"), F.get("words", there)
    pair = F.concat(F.least(word, context), F.lit(" "), F.greatest(word, context)).alias("pair")
    parts = []
    for part in range(passes):
        own = placed.filter(F.pmod(share, F.lit(passes)) == part) if passes > 1 else placed
        counted = own.select(pair).groupBy("pair").agg(F.count("*").alias("n"))
        # A token holds no blank.
        ends = counted.select(F.split("pair", " ").alias("pair"), "n").select(
            F.col("pair")[0].alias("a"), F.col("pair")[1].alias("b"), "n"
        )
        times = F.when(F.col("a") == F.col("b"), 2 * F.col("n")).otherwise(F.col("n"))
        often = ends.withColumn("n", times).filter(F.col("n") >= least)
        parts.append(stored(often, "pairs", scratch))
    counted = reduce(DataFrame.unionByName, parts)
    there = counted.select(F.col("a").alias("word"), F.col("b").alias("context"), "n")
    back = counted.filter("a <> b").select(F.col("b").alias("word"), F.col("a").alias("context"), "n")
    return there.unionByName(back)


def cooccurrences(texts: DataFrame, text: str = "text", window: int = WINDOW, least: int = 1) -> DataFrame:
    """``word``, ``context`` and ``n``: how often two words are at most ``window`` tokens apart, both ways."""
    scratch: list[str] = []
    pairs = _counted_pairs(_token_lists(texts, text, scratch), window, least)
    drop(texts.sparkSession, scratch)
    return pairs


def positive_pmi(pairs: DataFrame, least: int = 1, totals: DataFrame | None = None) -> DataFrame:
    """``pmi`` of the pairs seen ``least`` times or more together, where it is above 0.

    ``totals`` (``word, total``) are the sums of all pairs of each word, where ``pairs`` does not hold them all.
    """
    sums = pairs.groupBy("word").agg(F.sum("n").alias("total")) if totals is None else totals
    whole = sums.agg(F.sum("total")).scalar()
    kept = pairs.filter(F.col("n") >= least)
    met = kept.join(sums.withColumnRenamed("total", "n_word"), "word")
    met = met.join(sums.select(F.col("word").alias("context"), F.col("total").alias("n_context")), "context")
    ratio = (F.col("n").cast("double") / F.col("n_word")) * (whole / F.col("n_context"))
    return met.select("word", "context", F.log(ratio).alias("pmi")).filter("pmi > 0")


def pair_information(
    texts: DataFrame, text: str = "text", window: int = WINDOW, least: int = 1, scratch: list[str] | None = None
) -> DataFrame:
    """``positive_pmi`` of the words of ``texts``: of all pairs, only those seen ``least`` times are ever stored.

    ``scratch`` receives the tables that the result reads, to be dropped when it is written.
    """
    spent: list[str] = []
    lists = _token_lists(texts, text, spent)
    totals = stored(_totals(lists, window), "word-totals", scratch)
    pairs = _counted_pairs(lists, window, least, scratch)
    drop(texts.sparkSession, spent)
    return positive_pmi(pairs, least, totals)


def _sums(rows: DataFrame, keys: list[str], entry, size: int) -> DataFrame:
    """Grouped sums of ``size`` entries, as one array ``v``."""
    found = rows.groupBy(*keys).agg(*(F.sum(entry(j)).alias(f"s{j}") for j in range(size)))
    return found.select(*keys, F.array(*(F.col(f"s{j}") for j in range(size))).alias("v"))


def _products(rows: DataFrame, left: str, right: str, size: int):
    """``sum(left_i * right_j)`` over all rows, a small matrix: summed in tasks, then by Spark."""
    import numpy as np

    def part(batches):
        import pyarrow as pa

        total = np.zeros((size, size))
        for batch in batches:
            if batch.num_rows:
                total += as_matrix(batch.column(0)).T @ as_matrix(batch.column(1))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size * size)), pa.array(total.ravel())], ["place", "x"])

    parts = rows.select(F.col(left), F.col(right).alias("_right")).mapInArrow(part, "place bigint, x double")
    matrix = np.zeros(size * size)
    for row in parts.groupBy("place").agg(F.sum("x").alias("x")).collect():
        matrix[row.place] = row.x
    return matrix.reshape(size, size)


def _turned(rows: DataFrame, column: str, by, output: str) -> DataFrame:
    """``word`` and the array ``column`` times a small matrix."""

    def turn(batches):
        import pyarrow as pa

        for batch in batches:
            if batch.num_rows:
                found = list_array(as_matrix(batch.column(1)) @ by)
                yield pa.RecordBatch.from_arrays([batch.column(0), found], ["word", output])

    return rows.select("word", column).mapInArrow(turn, f"word string, {output} array<double>")


def _orthonormal(rows: DataFrame, size: int) -> DataFrame:
    """The same columns, orthonormal; directions without length become zero."""
    import numpy as np

    values, vectors = np.linalg.eigh(_products(rows, "v", "v", size))
    kept = values > 1e-12 * max(values.max(), 1e-300)
    scale = np.where(kept, 1 / np.sqrt(np.where(kept, values, 1.0)), 0.0)
    return _turned(rows, "v", vectors * scale, "v")


def fit_word_vectors(
    texts: DataFrame,
    size: int = VECTOR_SIZE,
    window: int = WINDOW,
    least: int = LEAST,
    steps: int = STEPS,
    text: str = "text",
) -> DataFrame:
    """``word`` and ``vector`` (array of ``size`` doubles) of the words of all texts.

    Every occurrence in every text counts. Words with no positive information about any
    neighbour they were seen with ``least`` times have no vector; where the words span less than ``size`` dimensions, the
    other entries are 0. Vectors do not depend on files, partitions or cores, but for
    the rounding of sums.
    """
    import numpy as np

    spark, scratch, whole = texts.sparkSession, [], []
    matrix = stored(pair_information(texts, text, window, least, scratch), "vectors-pmi", whole)
    drop(spark, scratch)

    def keep(df: DataFrame, name: str) -> DataFrame:
        # Cuts the lineage: the steps repeat joins over one matrix. The table it was made of is dropped.
        spent = scratch.copy()
        scratch.clear()
        kept = stored(df, f"vectors-{name}", scratch)
        drop(spark, spent)
        return kept

    wide = size + OVERSAMPLING
    bits = F.xxhash64("context")
    # One hash gives a word's row of random signs.
    start = _sums(matrix, ["word"], lambda j: F.col("pmi") * (1 - 2 * F.getbit(bits, F.lit(j % 64))), wide)
    basis = keep(_orthonormal(keep(start, "start"), wide), "basis")

    def step(basis: DataFrame) -> DataFrame:
        of_contexts = basis.select(F.col("word").alias("context"), F.col("v").alias("b"))
        return _sums(matrix.join(of_contexts, "context"), ["word"], lambda j: F.col("pmi") * F.col("b")[j], wide)

    for _ in range(steps):
        basis = keep(_orthonormal(keep(_orthonormal(keep(step(basis), "step"), wide), "turned"), wide), "basis")
    # The basis is read once more.
    image = stored(step(basis).join(basis.select("word", F.col("v").alias("b")), "word"), "vectors-image", whole)
    small = _products(image, "b", "v", wide)
    drop(spark, whole)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-np.abs(values), kind="stable")[:size]
    vectors = _turned(basis, "v", turn[:, order] * np.sqrt(np.abs(values[order])), "v")
    # The sign of an eigenvector is free: the one with a positive weighted sum is taken.
    weight = (F.pmod(F.xxhash64("word", F.lit(1)), F.lit(1 << 20)) + 1).cast("double")
    sums = vectors.agg(*(F.sum(weight * F.col("v")[j]).alias(f"s{j}") for j in range(len(order)))).first()
    signs = np.diag([-1.0 if (s or 0.0) < 0 else 1.0 for s in sums])
    return keep(_turned(vectors, "v", signs, "vector"), "words")


def dealt(rows: DataFrame, tasks: int):
    """The column ``task``: a hash of each row, so that equal texts of different rows are spread."""
    columns = [f.name for f in rows.schema.fields if "map<" not in f.dataType.simpleString()]
    return F.pmod(F.xxhash64(*columns), F.lit(tasks)).cast("int").alias("task")


def as_matrix(column):
    """An Arrow column of arrays of one length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def list_array(rows):
    """The reverse."""
    import numpy as np
    import pyarrow as pa

    places = pa.array(np.arange(len(rows) + 1) * rows.shape[1], pa.int32())
    return pa.ListArray.from_arrays(places, pa.array(rows.ravel()))


def packed(rows):
    """An Arrow column of the rows of a matrix: the largest size of an entry, then 16-bit shares of it."""
    import numpy as np
    import pyarrow as pa

    most = np.abs(rows).max(1, initial=0).astype("<f4")
    shares = np.rint(rows / np.where(most > 0, most, 1)[:, None] * 32767).astype("<i2")
    data = np.concatenate([most[:, None].view(np.uint8), shares.view(np.uint8)], axis=1)
    places = np.arange(len(rows) + 1, dtype=np.int32) * data.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(places), pa.py_buffer(data.tobytes())])


def unpacked(column):
    """The rows of ``packed``, or of a column of arrays."""
    import numpy as np
    import pyarrow as pa

    if not pa.types.is_binary(column.type):
        return as_matrix(column)
    data = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)
    most = np.ascontiguousarray(data[:, :4]).view("<f4")
    return np.ascontiguousarray(data[:, 4:]).view("<i2") * (most / np.float32(32767))


def _mean_of_words(size: int):
    """Means of the texts of one task, which come after the vectors of their words."""

    def means(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names, held, words, vectors = [], [], None, None
        for batch in batches:
            known = pc.is_valid(batch.column("word"))
            if (own := batch.filter(known)).num_rows:
                names.append(own.column("word"))
                held.append(unpacked(own.column("v")))
            texts = batch.filter(pc.invert(known))
            if not texts.num_rows:
                continue
            if words is None:
                words = pa.chunked_array(names, pa.string()).combine_chunks()
                # The last row is that of words without a vector.
                vectors = np.concatenate([*held, np.zeros((1, size), held[0].dtype if held else np.float64)])
                held.clear()
            lists = texts.column("words")
            ids = pc.index_in(lists.flatten(), value_set=words).fill_null(-1).to_numpy(zero_copy_only=False)
            ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            found = np.zeros((len(lists), size))
            starts = np.concatenate([[0], ends[:-1]])
            filled = np.flatnonzero(ends > starts)
            low = 0
            while low < len(filled):  # so many words at a time, or one text
                high = max(low + 1, int(np.searchsorted(ends[filled], starts[filled[low]] + MEAN_WORDS, "right")))
                some = filled[low:high]
                at = starts[some] - starts[some[0]]
                sums = np.add.reduceat(vectors[ids[starts[some[0]] : ends[some[-1]]]], at, dtype=np.float64)
                found[some] = sums / (ends[some] - starts[some])[:, None]
                low = high
            column = list_array(found)
            null = pc.is_null(lists)
            if null.true_count:
                column = pc.if_else(null, pa.scalar(None, column.type), column)
            yield pa.RecordBatch.from_arrays([texts.column("row"), column], ["row", "vector"])

    return means


def mean_vectors(posts: DataFrame, vectors: DataFrame, size: int = VECTOR_SIZE, text: str = "text") -> DataFrame:
    """Add ``vector``, the mean of the vectors of a text's words (zeros for none, null for a null text).

    Words without a vector count as zeros, as in Spark's ``Word2Vec``. Texts are dealt over
    tasks, and a task gets the vectors of the words of its own texts, each once: no row is made
    of a word of a text, and no table of all vectors is held in one place. Vectors are arrays or ``packed``.
    """
    characters = posts.agg(F.sum(F.length(text))).first()[0] or 0
    tasks = max(1, -(-characters // MEAN_CHARACTERS))
    task = dealt(posts, tasks)
    own = posts.filter(F.col(text).isNotNull()).select(task, F.explode(tokens(F.col(text))).alias("word")).distinct()
    words = own.join(vectors.select("word", F.col("vector").alias("v")), "word").select("task", "word", "v")
    rows = posts.select(task, F.struct(*posts.columns).alias("row"))
    met = words.unionByName(rows, allowMissingColumns=True).repartitionById(tasks, "task")
    met = met.sortWithinPartitions(F.col("word").isNull())
    met = met.select("word", "v", "row", tokens(F.col("row")[text]).alias("words"))
    schema = StructType([StructField("row", posts.schema), StructField("vector", ArrayType(DoubleType()))])
    found = met.mapInArrow(_mean_of_words(size), schema)
    return found.select("row.*", "vector")


@dataclass(frozen=True)
class CountVectorizer:
    """Word vectors from counts and the range of the training texts' means."""

    vectors: DataFrame
    low: list[float]
    high: list[float]

    def transform(self, df: DataFrame, refit_scaler: bool = False) -> DataFrame:
        """Add ``features``: the mean word vector of ``text``, scaled to 0..1 and cut to it."""
        from pyspark.ml.functions import array_to_vector

        means = mean_vectors(df, self.vectors, len(self.low))
        low, high = _range(means, len(self.low)) if refit_scaler else (self.low, self.high)
        scaled = [
            F.lit(0.5) if b <= a else F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("vector")[j] - a) / (b - a)))
            for j, (a, b) in enumerate(zip(low, high, strict=True))
        ]
        return means.withColumn("features", array_to_vector(F.array(*scaled))).drop("vector")


def _range(means: DataFrame, size: int) -> tuple[list[float], list[float]]:
    ends = [f(F.col("vector")[j]) for j in range(size) for f in (F.min, F.max)]
    found = means.agg(*ends).first()
    return [x or 0.0 for x in found[::2]], [x or 0.0 for x in found[1::2]]


def fit_count_vectorizer(labeled: DataFrame, size: int = VECTOR_SIZE, **options: int) -> CountVectorizer:
    """Word vectors of all texts of ``labeled`` and the range of their means."""
    vectors = fit_word_vectors(labeled, size, **options)
    low, high = _range(mean_vectors(labeled, vectors, size), size)
    return CountVectorizer(vectors, low, high)
