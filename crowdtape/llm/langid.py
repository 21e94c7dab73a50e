"""Language identification with error-correcting output codes.

Every language gets a codeword; each bit is learned by a binary classifier over
hashed n-grams of bytes. A text's bit margins are compared with all codewords,
each bit weighted by its loss, and the nearest codeword wins; where two are
nearly as near, the text is flagged as ambiguous.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.llm.common import table

#: n-grams of 1 to 3 bytes fall into so many buckets.
BUCKETS = 1 << 12
#: Training rows of each language at most: those of the smallest hashes.
ROWS_PER_LANGUAGE = 256
#: Shares of a language's rows that are ranked apart before the whole language is.
SHARES = 64
#: Bytes of a text that are counted at a time, which bounds memory.
SPAN = 1 << 20
#: Codewords of more than this many languages are drawn instead of enumerated.
EXHAUSTIVE = 6
DRAWN_BITS = 63
#: Texts whose two nearest codewords are this close in probability are ambiguous.
MARGIN = 0.2
UNKNOWN = "und"


def codewords(languages: int):
    """Matrix of +1 and -1, a row per language: all splits in two, or drawn ones for many."""
    import numpy as np

    if languages == 1:
        return np.ones((1, 1))
    if languages <= EXHAUSTIVE:
        columns = [(1, *rest) for rest in product((1, -1), repeat=languages - 1) if -1 in rest]
        return np.array(columns, "f8").T
    rng = np.random.default_rng(5)
    best, best_gap = None, -1.0
    for _ in range(64):
        code = rng.choice([-1.0, 1.0], (languages, DRAWN_BITS))
        code = code[:, np.abs(code.sum(0)) < languages]
        distance = (code.shape[1] - code @ code.T) / 2 + code.shape[1] * np.eye(languages)
        if distance.min() > best_gap:
            best, best_gap = code, distance.min()
    return best


def ngram_counts(text: str):
    """Bucket shares of a whole text's n-grams, square-rooted and of length one."""
    import numpy as np

    data = np.frombuffer((" " + text.lower() + " ").encode(), np.uint8)
    counts = np.zeros(BUCKETS)
    for at in range(0, len(data), SPAN):
        part = data[at : at + SPAN + 2].astype(np.uint32)
        new = min(SPAN, len(part))
        pairs = part[:-1] * 256 + part[1:]
        triples = pairs[:-1] * 256 + part[2:]
        counts += np.bincount(part[:new], minlength=BUCKETS)
        for grams, salt in ((pairs, 0x9E3779B1), (triples, 0x85EBCA77)):
            mixed = grams[:new] * np.uint32(salt)
            counts += np.bincount(mixed >> np.uint32(32 - BUCKETS.bit_length() + 1), minlength=BUCKETS)
    shares = np.sqrt(counts)
    return (shares / np.linalg.norm(shares)).astype(np.float32)


def fit_bits(features, targets, steps: int = 300, rate: float = 4.0, decay: float = 1e-4):
    """Logistic regression of all bits at once by accelerated full-batch gradient descent."""
    import numpy as np

    targets = targets.astype(features.dtype)
    weights = np.zeros((features.shape[1], targets.shape[1]), features.dtype)
    bias = np.zeros(targets.shape[1], features.dtype)
    moved, moved_bias = weights, bias
    for step in range(steps):
        margin = (features @ moved + moved_bias) * targets
        slope = -targets / (1 + np.exp(np.clip(margin, -30, 30))) / len(features)
        next_weights = moved - rate * (features.T @ slope + decay * moved)
        next_bias = moved_bias - rate * slope.sum(0)
        pull = step / (step + 3)
        moved = next_weights + pull * (next_weights - weights)
        moved_bias = next_bias + pull * (next_bias - bias)
        weights, bias = next_weights, next_bias
    return weights, bias


def decode(margins, code, importance):
    """Probability of each language from the loss of its codeword, bits weighted by ``importance``."""
    import numpy as np

    loss = np.logaddexp(0, -margins[:, None, :] * code[None, :, :]) @ importance
    weight = np.exp(loss.min(1, keepdims=True) - loss)
    return weight / weight.sum(1, keepdims=True)


def held_out(doc_id: Column) -> Column:
    """Whether a document stays out of training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame) -> dict | None:
    """Model from ``docs(text, lang)``: at most ``ROWS_PER_LANGUAGE`` rows of each language.

    Rows without text or language are left out; None where nothing is left.
    """
    import numpy as np
    from pyspark.sql import Window

    known = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    key = F.xxhash64("text")
    # The narrow rank drops all but the first rows of a language in each task before it shuffles,
    # and all but those of each share before a language meets in one task.
    share = Window.partitionBy("lang", F.pmod("key", F.lit(SHARES))).orderBy("key")
    whole = Window.partitionBy("lang").orderBy("key")
    last = known.select("lang", key.alias("key")).distinct()
    for rows in (share, whole):
        last = last.withColumn("rank", F.row_number().over(rows)).where(F.col("rank") <= ROWS_PER_LANGUAGE)
    limits = {r["lang"]: r["most"] for r in last.groupBy("lang").agg(F.max("key").alias("most")).collect()}
    if not limits:
        return None
    chosen = F.lit(False)
    for language, most in limits.items():
        chosen = chosen | ((F.col("lang") == language) & (key <= most))
    rows = known.where(chosen).dropDuplicates(["lang", "text"])
    sample = rows.repartition(key).mapInArrow(_features, "lang string, features array<float>").toPandas()
    languages = sorted(limits)
    features = np.stack(sample["features"])
    target = np.array([languages.index(name) for name in sample["lang"]])
    code = codewords(len(languages))
    weights, bias = fit_bits(features, code[target])
    # A bit counts by how surely it is told on the training rows.
    agreement = np.logaddexp(0, -(features @ weights + bias) * code[target]).mean(0)
    importance = np.exp(-agreement)
    return {
        "languages": languages,
        "code": code,
        "weights": weights.astype("f4"),
        "bias": bias,
        "importance": importance / importance.mean(),
    }


def _features(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        rows = [ngram_counts(text.as_py()) for text in batch.column(0)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(1), pa.array(rows, pa.list_(pa.float32()))], ["lang", "features"]
        )


def predict(docs: DataFrame, model: dict | None, keep: list[str]) -> DataFrame:
    """``row`` (columns ``keep``), ``lang_pred``, ``score`` and ``ambiguous`` for every row.

    Null texts and texts without a letter are ``und`` with score 0, as is every text
    when there is no model. Equal texts get equal answers. Other columns, also those
    named like an output, are not looked at.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        model = shared.value
        for batch in batches:
            names, scores, unsure = [], [], []
            for text in batch.column(0):
                text = text.as_py()
                if model is None or not text or not any(map(str.isalpha, text)):
                    names.append(UNKNOWN)
                    scores.append(0.0)
                    unsure.append(True)
                    continue
                margins = ngram_counts(text) @ model["weights"] + model["bias"]
                share = decode(margins[None, :], model["code"], model["importance"])[0]
                order = np.argsort(-share, kind="stable")
                second = share[order[1]] if len(order) > 1 else 0.0
                names.append(model["languages"][order[0]])
                scores.append(float(min(1.0, share[order[0]])))
                unsure.append(bool(share[order[0]] - second < MARGIN))
            fields = [batch.schema.field(1), pa.field("lang_pred", pa.string())]
            fields += [pa.field("score", pa.float64()), pa.field("ambiguous", pa.bool_())]
            columns = [batch.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(unsure, pa.bool_())], schema=pa.schema(fields)
            )

    narrow = docs.select(F.col("text").cast("string"), F.struct(*keep).alias("row"))
    kind = narrow.schema["row"].dataType.simpleString()
    return narrow.mapInArrow(run, f"row {kind}, lang_pred string, score double, ambiguous boolean")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    judged = predict(docs.select("doc_id", "text"), model, ["doc_id"])
    return judged.select(
        "row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous"
    )
