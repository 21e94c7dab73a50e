"""A quality classifier on random-indexing word vectors.

Random indexing gives each word a fixed sparse vector of ones and minus ones; the
vector of a word is the sum of the fixed vectors of its neighbours in all texts.
Words share buckets of a hash, so the table of vectors has one size for any corpus,
and its sums are whole numbers, the same in every partitioning. A document pools the
vectors of its words; a two-layer network learns from labelled documents, and a
temperature fitted on labelled rows that the network has not seen makes its answers
probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.llm.common import stored, table

#: Buckets of words, entries of a vector, and ones (half of them negative) of a fixed vector.
BUCKETS = 1 << 14
DIMENSIONS = 32
ONES = 4
#: Neighbours on either side of a word.
WINDOW = 2
#: Words of a text that are looked at together, which bounds memory; windows reach across.
SPAN = 1 << 16
#: Words that a task remembers the buckets of.
REMEMBERED = 1 << 20
#: Labelled documents (those of the smallest hashes) that the network and its temperature are fitted on.
LABELLED_ROWS = 20_000
#: One in so many of them is kept for the temperature.
CALIBRATION = 5
#: Short texts are pulled towards the mean document as by so many of its words.
PRIOR_WORDS = 10.0
HIDDEN = 32
SEED = 29


class Buckets(dict):
    """Bucket of each word seen so far."""

    def __missing__(self, word: bytes) -> int:
        import zlib

        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = zlib.crc32(word) % BUCKETS
        return found

    def of(self, text: str | None):
        import numpy as np

        words = (text or "").encode().split()  # at the six ASCII white space characters
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def index_places():
    """Places of the ones of each bucket's fixed vector; every other one of them is negative."""
    import numpy as np

    return np.random.default_rng(SEED).integers(0, DIMENSIONS, (BUCKETS, ONES))


def spans(ids):
    """Parts of ``ids`` with the neighbours before them, and how many of these there are."""
    for at in range(0, max(len(ids), 1), SPAN):
        before = min(at, WINDOW)
        yield ids[at - before : at + SPAN], before


def add_contexts(ids, places, sums) -> None:
    """Add the fixed vectors of all neighbours to the sums of each word."""
    import numpy as np

    for part, before in spans(ids):
        for gap in range(1, WINDOW + 1):
            # Pairs that lie wholly in the words of the part before were counted there.
            first = max(before - gap, 0)
            left, right = part[first : len(part) - gap], part[first + gap :]
            for word, neighbour in ((left, right), (right, left)):
                for one in range(ONES):
                    np.add.at(sums, word * DIMENSIONS + places[neighbour, one], 1 - 2 * (one % 2))


def context_sums(docs: DataFrame) -> DataFrame:
    """``bucket``, ``n`` and ``DIMENSIONS`` sums ``c0``, ... over all texts of ``docs(text)``."""
    names = [f"c{at}" for at in range(DIMENSIONS)]
    schema = ", ".join(f"{name} bigint" for name in ("bucket", "n", *names))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        buckets, places = Buckets(), index_places()
        sums, counts = np.zeros(BUCKETS * DIMENSIONS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for text in batch.column(0):
                ids = buckets.of(text.as_py())
                counts += np.bincount(ids, minlength=BUCKETS)
                add_contexts(ids, places, sums)
        met = np.flatnonzero(counts)
        columns = [met, counts[met], *sums.reshape(BUCKETS, DIMENSIONS)[met].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["bucket", "n", *names])

    parts = docs.select(F.col("text").cast("string")).mapInArrow(run, schema)
    return parts.groupBy("bucket").agg(*(F.sum(name).alias(name) for name in ("n", *names)))


def word_vectors(docs: DataFrame):
    """Vector of each bucket, of length one around the mean word of the corpus: one table of fixed size."""
    import numpy as np

    rows = np.array(context_sums(docs).collect(), np.int64).reshape(-1, 2 + DIMENSIONS)
    vectors, counts = np.zeros((BUCKETS, DIMENSIONS)), np.zeros(BUCKETS)
    vectors[rows[:, 0]], counts[rows[:, 0]] = rows[:, 2:], rows[:, 1]
    vectors = _unit(vectors)
    mean = counts @ vectors / max(counts.sum(), 1)
    return _unit(vectors - mean).astype("f4")


def _unit(vectors):
    import numpy as np

    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)


def pooled(ids, vectors):
    """Mean and spread of a text's word vectors and their mean product with the next one, and its words."""
    import numpy as np

    n = len(ids)
    total, squares, products = np.zeros((3, DIMENSIONS))
    for part, before in spans(ids):
        rows = vectors[part]
        new = rows[before:]
        total += new.sum(0, dtype=float)
        squares += (new * new).sum(0, dtype=float)
        pairs = rows[max(before - 1, 0) :]
        products += (pairs[1:] * pairs[:-1]).sum(0, dtype=float)
    mean = total / max(n, 1)
    spread = np.sqrt(np.maximum(squares / max(n, 1) - mean * mean, 0.0))
    return np.concatenate([mean, spread, products / max(n - 1, 1), [n]])


# --- network --------------------------------------------------------------------------


def _scaled(features, model):
    """Features around those of the training rows; texts of few words lie nearer to their mean."""
    words = features[:, -1:]
    return (features[:, :-1] - model["mean"]) / model["deviation"] * (words / (words + PRIOR_WORDS))


def _margins(features, model):
    import numpy as np

    hidden = np.tanh(_scaled(features, model) @ model["w1"] + model["b1"])
    return hidden @ model["w2"] + model["b2"]


def probabilities(features, model):
    """Probability of label 1; the share of the labels where there was nothing to learn."""
    import numpy as np

    if "w1" not in model:
        return np.full(len(features), model["share"])
    margins = _margins(features, model) / model["temperature"]
    return 1 / (1 + np.exp(-np.clip(margins, -700, 700)))


def fit_network(features, targets, steps: int = 400, rate: float = 0.01, decay: float = 0.01) -> dict:
    """Two layers by full-batch gradient descent with adaptive moments, from a fixed start."""
    import numpy as np

    model = {"mean": features[:, :-1].mean(0), "deviation": features[:, :-1].std(0) + 1e-6}
    rows = _scaled(features, model)
    rng = np.random.default_rng(SEED)
    size = rows.shape[1]
    names = ("w1", "b1", "w2", "b2")
    model["w1"] = rng.normal(0, size**-0.5, (size, HIDDEN))
    model["b1"] = np.zeros(HIDDEN)
    model["w2"] = rng.normal(0, HIDDEN**-0.5, HIDDEN)
    model["b2"] = np.zeros(())
    first, second = ({name: np.zeros_like(model[name]) for name in names} for _ in range(2))
    for step in range(1, steps + 1):
        hidden = np.tanh(rows @ model["w1"] + model["b1"])
        margin = hidden @ model["w2"] + model["b2"]
        slope = (1 / (1 + np.exp(-np.clip(margin, -700, 700))) - targets) / len(rows)
        back = np.outer(slope, model["w2"]) * (1 - hidden * hidden)
        slopes = {
            "w1": rows.T @ back + decay * model["w1"] / size,
            "b1": back.sum(0),
            "w2": hidden.T @ slope + decay * model["w2"],
            "b2": slope.sum(),
        }
        for name in names:
            first[name] = 0.9 * first[name] + 0.1 * slopes[name]
            second[name] = 0.999 * second[name] + 0.001 * slopes[name] ** 2
            move = first[name] / (1 - 0.9**step) / (np.sqrt(second[name] / (1 - 0.999**step)) + 1e-8)
            model[name] = model[name] - rate * move
    return model


def fit_temperature(margins, targets) -> float:
    """Divisor of the margins that makes the targets likeliest, found by golden section on its logarithm."""
    import numpy as np

    def loss(log_temperature: float) -> float:
        scaled = margins / np.exp(log_temperature)
        return float((np.logaddexp(0, scaled) - targets * scaled).mean())

    ratio = (5**0.5 - 1) / 2
    low, high = np.log(0.05), np.log(20.0)
    for _ in range(60):
        one, other = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, other) if loss(one) <= loss(other) else (one, high)
    return float(np.exp((low + high) / 2))


# --- on Spark -------------------------------------------------------------------------


def pooled_features(docs: DataFrame, vectors, keep: list[str]) -> DataFrame:
    """``row`` (columns ``keep``) and ``features``, of every whole text of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        buckets, vectors = Buckets(), shared.value
        for batch in batches:
            rows = [pooled(buckets.of(text.as_py()), vectors) for text in batch.column(0)]
            flat = np.concatenate(rows) if rows else np.zeros(0)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * (3 * DIMENSIONS + 1), pa.int32()), flat)
            schema = pa.schema([batch.schema.field(1), pa.field("features", pa.list_(pa.float64()))])
            yield pa.RecordBatch.from_arrays([batch.column(1), lists], schema=schema)

    narrow = docs.select(F.col("text").cast("string"), F.struct(*keep).alias("row"))
    kind = narrow.schema["row"].dataType.simpleString()
    return narrow.mapInArrow(run, f"row {kind}, features array<double>")


def labelled_targets(labels: DataFrame) -> DataFrame:
    """``labelled`` id and ``target``, the share of its labels above 0, of at most ``LABELLED_ROWS`` ids.

    Rows with a null id or label are left out. Ids beyond the bound go by a cut through
    their hashes, so that no sort brings them together.
    """
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
    known = known.groupBy(F.col("doc_id").cast("long").alias("labelled")).agg(
        F.avg((F.col("quality") > 0).cast("double")).alias("target")
    )
    known = stored(known.withColumn("key", F.xxhash64("labelled")), "quality-labels")
    count, share = known.count(), 1.0
    while count > LABELLED_ROWS:
        share *= 0.98 * LABELLED_ROWS / count
        known = known.where(F.col("key") < F.lit(int(share * 2**64) - 2**63))
        count = known.count()
    return known.drop("key")


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """Model from all texts of ``docs(doc_id, text)`` and from ``labels(doc_id, quality)``.

    Word vectors cover every text. Of an id that several documents share, the one of the
    smallest text hash is learned from. Without labels of both kinds the score is the share
    of label 1, or 0.5 without any.
    """
    import numpy as np

    model: dict = {"vectors": word_vectors(docs), "share": 0.5}
    known = F.broadcast(labelled_targets(labels))  # at most LABELLED_ROWS narrow rows
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    rows = narrow.join(known, F.col("doc_id") == F.col("labelled"))
    examples = pooled_features(rows.withColumn("hash", F.xxhash64("text")), model["vectors"], ["labelled", "target", "hash"])
    first = examples.groupBy("row.labelled").agg(F.min_by(F.struct("row.target", "features"), "row.hash").alias("one"))
    pool = first.select("labelled", "one.*").toPandas().sort_values("labelled")
    if not len(pool):
        return model
    features, targets = np.stack(pool["features"]), pool["target"].to_numpy()
    model["share"] = float(targets.mean())
    if targets.min() == targets.max():
        return model
    aside = np.arange(len(pool)) % CALIBRATION == CALIBRATION - 1
    if len({*(targets[~aside] >= 0.5)}) < 2 or len({*(targets[aside] >= 0.5)}) < 2:
        aside[:] = False  # too few rows to keep some for the temperature
    model |= fit_network(features[~aside], targets[~aside])
    model["temperature"] = fit_temperature(_margins(features[aside], model), targets[aside]) if aside.any() else 1.0
    return model


def score(docs: DataFrame, model: dict, keep: list[str]) -> DataFrame:
    """``row`` (the columns ``keep`` of ``docs``) and ``score`` for every row of ``docs(text)``.

    A null or empty text has no words and gets the score of the mean document. Equal
    texts get equal scores. Other columns, also those named like an output, are not
    looked at.
    """
    vectors = model["vectors"]
    network = {name: part for name, part in model.items() if name != "vectors"}
    shared = docs.sparkSession.sparkContext.broadcast(network)
    rows = pooled_features(docs, vectors, keep)
    kind = rows.schema["row"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            features = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, 3 * DIMENSIONS + 1)
            found = pa.array(probabilities(features, shared.value), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), found], schema=pa.schema([batch.schema.field(0), pa.field("score", pa.float64())])
            )

    return rows.mapInArrow(run, f"row {kind}, score double")


def held_out(doc_id: Column) -> Column:
    """Whether labels of a document stay out of training: crc32 of its id as text, modulo 3, is 1."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1, F.lit(False))


def op12_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    scored = score(docs, fit(docs, labels), ["doc_id"])
    return scored.select(
        "row.doc_id",
        held_out(F.col("row.doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
