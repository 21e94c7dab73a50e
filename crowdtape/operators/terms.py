"""Models of terms made of grouped counts: naive Bayes, and a lexicon learned from labels."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdtape.functions.scores import NEUTRAL
from crowdtape.operators.sentiment import sentence_tokens
from crowdtape.session import stored

#: Terms of a model that are broadcast at most; a larger one is joined by its terms.
BROADCAST_TERMS = 1_000_000
#: Digits of a class score that count, so that the order of its terms does not.
DIGITS = 6


def text_terms(text: Column) -> Column:
    """The word tokens of a cleaned text, over all of its sentences."""
    return F.flatten(sentence_tokens(text))


@dataclass
class TermBayes:
    """``terms(term, weights)`` with the log-likelihood of each class, and the classes' log-priors."""

    classes: list[float]
    priors: list[float]
    terms: DataFrame
    count: int


def fit_term_bayes(labeled: DataFrame, smoothing: float = 1.0, text: str = "text", label: str = "label") -> TermBayes:
    """Multinomial naive Bayes over the terms of ``labeled``, from grouped sums.

    Priors and likelihoods are smoothed by ``smoothing`` rows and occurrences. Rows
    without a label or text are left out. Only the classes and their totals reach the
    driver; a term with a third of all occurrences is counted where it is met.
    """
    known = labeled.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    rows = {r[label]: r["count"] for r in known.groupBy(label).count().collect()}
    classes = sorted(rows)
    total = sum(rows.values()) + smoothing * len(classes)
    priors = [math.log((rows[c] + smoothing) / total) for c in classes]
    words = known.select(label, F.explode(text_terms(F.col(text))).alias("term"))
    by_class = (F.count(F.when(F.col(label) == c, 1)).alias(f"c{n}") for n, c in enumerate(classes))
    counts = words.groupBy("term").agg(F.count("*").alias("n"), *by_class)
    sums = counts.agg(F.count("*").alias("terms"), *(F.sum(f"c{n}") for n in range(len(classes)))).first()
    weights = [
        F.log((F.col(f"c{n}") + F.lit(smoothing)) / F.lit((sums[n + 1] or 0) + smoothing * sums.terms))
        for n in range(len(classes))
    ]
    return TermBayes(classes, priors, counts.select("term", F.array(*weights).alias("weights")), sums.terms)


def predict_terms(posts: DataFrame, model: TermBayes, text: str = "text", output: str = "prediction") -> DataFrame:
    """Add the likeliest class of each text, the smaller one of equals; null for a null text.

    A model of no rows says neutral. Terms the model does not know do not count. A class belongs to a text, by a 128-bit
    hash, so ids may repeat. The terms of a text are counted before they meet the model:
    by broadcast, or by a join on the term, whose frequent terms Spark splits.
    """
    keys = ["_h1", "_h2"]
    known = F.col(text).isNotNull()
    if not model.classes:
        return posts.withColumn(output, F.when(known, F.lit(NEUTRAL)))
    hashed = posts.withColumns(
        {
            "_h1": F.when(known, F.xxhash64(text)),
            "_h2": F.when(known, F.xxhash64(F.lit("second"), F.col(text))),
        }
    )
    texts = hashed.filter(known).select(*keys, text).dropDuplicates(keys)
    counted = texts.select(*keys, F.explode(text_terms(F.col(text))).alias("term"))
    counted = counted.groupBy(*keys, "term").agg(F.count("*").alias("times"))
    terms = F.broadcast(model.terms) if model.count <= BROADCAST_TERMS else model.terms
    met = counted.join(terms, "term")
    sums = (F.sum(F.col("times") * F.col("weights")[n]).alias(f"s{n}") for n in range(len(model.classes)))
    totals = met.groupBy(*keys).agg(*sums)
    scored = hashed.join(totals, keys, "left")
    options = [
        F.struct(
            F.round(F.lit(prior) + F.coalesce(f"s{n}", F.lit(0.0)), DIGITS).alias("score"),
            F.lit(-float(c)).alias("negative"),
            F.lit(float(c)).alias("label"),
        )
        for n, (c, prior) in enumerate(zip(model.classes, model.priors, strict=True))
    ]
    best = F.array_max(F.array(*options))["label"]
    return scored.select(*posts.columns, F.when(known, best).alias(output))


# --- learned lexicon ------------------------------------------------------------

#: Texts that the prior counts as, spread over the terms as in the corpus.
PRIOR_TEXTS = 100.0
#: Standard errors from which a term has a polarity; twice as many give it a strong one.
CUT = 1.96


def learn_lexicon(
    labeled: DataFrame,
    positive: float = 2.0,
    negative: float = 0.0,
    prior: float = PRIOR_TEXTS,
    cut: float = CUT,
    text: str = "text",
    label: str = "label",
) -> DataFrame:
    """``token``, ``polarity`` (-2, -1, 1 or 2) and ``z`` of the terms that tell positive from negative texts.

    The log-odds of a term among positive and negative texts are compared under a
    Dirichlet prior with the frequencies of the whole corpus; terms within ``cut``
    standard errors of equal odds are left out. A text counts a term once. The terms are
    counted at once, into a table of the shared folder.
    """
    known = labeled.filter(F.col(label).isNotNull() & F.col(text).isNotNull())
    held = known.select(label, F.explode(F.array_distinct(text_terms(F.col(text)))).alias("token"))
    counts = held.groupBy("token").agg(
        F.count("*").alias("n"),
        F.count(F.when(F.col(label) == positive, 1)).alias("p"),
        F.count(F.when(F.col(label) == negative, 1)).alias("m"),
    )
    # A row a term; the sums, the lexicon and whoever sizes it read these rows, and the texts are split once.
    counts = stored(counts, "term-counts")
    sums = counts.agg(F.sum("n").alias("n"), F.sum("p").alias("p"), F.sum("m").alias("m"))
    total = {c: F.coalesce(sums.select(c).scalar(), F.lit(0)) for c in "npm"}
    weight = F.lit(prior) * F.col("n") / total["n"]

    def log_odds(c: str) -> Column:
        own = F.col(c) + F.col("weight")
        return F.log(F.try_divide(own, total[c] + F.lit(prior) - own))  # null where no other term is left

    spread = F.sqrt(1 / (F.col("p") + F.col("weight")) + 1 / (F.col("m") + F.col("weight")))
    scored = counts.withColumn("weight", weight).withColumn("z", (log_odds("p") - log_odds("m")) / spread)
    strength = F.when(F.abs("z") >= 2 * cut, 2).otherwise(1)
    polarity = (F.signum("z") * strength).cast("int")
    return scored.filter(F.abs("z") >= cut).select("token", polarity.alias("polarity"), "z")


def agreement(df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()) -> DataFrame:
    """Rows, share of right predictions, and the share of the commonest label, which any model has to beat."""
    counts = df.groupBy(*by, label).agg(
        F.count("*").alias("n"), F.count(F.when(F.col(label) == F.col(prediction), 1)).alias("right")
    )
    return counts.groupBy(*by).agg(
        F.sum("n").alias("rows"),
        (F.sum("right") / F.sum("n")).alias("accuracy"),
        (F.max("n") / F.sum("n")).alias("majority"),
    )
