"""Sentiment of posts: a lexicon scorer in Spark, or a model plugged into tasks.

Both follow one contract. A text is cleaned and split into sentences, each
sentence has a class from 0 (very negative) to 4 (very positive) and a number of
word tokens. The class minus 2, times the tokens, is summed over the sentences
and the sum is put into one of three buckets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crowdtape.functions.scores import HIGH, LOW, bucket, class_polarity
from crowdtape.functions.text import clean, sentences, word_tokens
from crowdtape.schemas import LEXICON, conform

# Lexicons up to this many tokens are compiled into the plan as hash sets.
INLINE_LIMIT = 10_000
# And with up to this many different polarities, each of which is one set test.
INLINE_POLARITIES = 64
# Lexicons up to this many tokens (some 100 MB) are broadcast.
BROADCAST_LIMIT = 1_000_000

Lexicon = DataFrame | Mapping[str, int]
# Takes texts; gives for each a list of sentences as dicts(tokens=..., sentence_class=...).
Scorer = Callable[[pd.Series], pd.Series]


def sentence_tokens(text: Column) -> Column:
    """Word tokens of each sentence of a cleaned text, as an array of arrays."""
    return F.transform(sentences(clean(text)), word_tokens)


def sentence_polarity(polarity_sum: Column) -> Column:
    """Polarity -2..2 of a sentence (its class minus 2) from the sum over its tokens."""
    return F.greatest(F.lit(-2), F.least(F.lit(2), polarity_sum))


def weighted(token_count: Column, polarity: Column) -> Column:
    """What one sentence adds to the sum of its post."""
    return (token_count * polarity).cast("long")


def score(
    posts: DataFrame,
    lexicon: Lexicon,
    text: str = "text",
    low: int = LOW,
    high: int = HIGH,
    form: str = "signed",
    inline_limit: int = INLINE_LIMIT,
    broadcast_limit: int = BROADCAST_LIMIT,
    salts: int | None = None,
) -> DataFrame:
    """Add ``sentiment``, the bucketed lexicon score of ``text``.

    The lexicon holds one polarity per token; polarities of a repeated token
    add up. Its size decides the plan. Up to ``inline_limit`` tokens it becomes
    part of the expression and rows are scored where they are, without a
    shuffle. A larger one is joined to the tokens of the texts: by broadcast up to
    ``broadcast_limit`` tokens, else by a sort-merge join, salted over all shuffle
    partitions since a few tokens make up most of a text.

    Joined scores belong to texts, known by a 128-bit hash, not to rows: ids may
    repeat or be null, equal texts are scored once, and no text is shuffled unless
    it is part of the result.
    """
    inline = _inline_lexicon(lexicon, inline_limit)
    if inline is not None:
        # The sum is a column of its own, so that the bucket's tests share it.
        scored = posts.withColumn("_total", _inline_total(F.col(text), inline))
        return scored.withColumn("sentiment", bucket(F.col("_total"), low, high, form)).drop(
            "_total"
        )
    # Null for a null text, so the test for it below the join needs no text above it.
    hashes = {
        "_h1": F.when(F.col(text).isNotNull(), F.xxhash64(text)),
        "_h2": F.when(F.col(text).isNotNull(), F.xxhash64(F.lit("second"), F.col(text))),
    }
    keys = list(hashes)
    hashed = posts.withColumns(hashes)
    merged = (
        _as_frame(posts, lexicon)
        .dropna()
        .groupBy("token")
        .agg(F.sum("polarity").alias("_polarity"))
    )
    words = _word_rows(hashed.withColumn("_row", F.monotonically_increasing_id()), text, [*keys, "_row"])
    if merged.count() <= broadcast_limit:
        matched = words.join(F.broadcast(merged), "token")
    else:
        salts = salts or int(posts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        salt = F.pmod(F.col("_h1"), F.lit(salts))
        every_salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>"))
        matched = words.withColumn("_salt", salt).join(
            merged.withColumn("_salt", every_salt).hint("merge"), ["token", "_salt"]
        )
    totals = _post_totals(matched, keys)
    total = F.when(F.col("_h1").isNotNull(), F.coalesce("_total", F.lit(0)))
    return (
        hashed.join(totals, keys, "left")
        .withColumn("sentiment", bucket(total, low, high, form))
        .drop("_total", *keys)
    )


def _as_frame(posts: DataFrame, lexicon: Lexicon) -> DataFrame:
    if isinstance(lexicon, DataFrame):
        return conform(lexicon, LEXICON)
    return posts.sparkSession.createDataFrame(list(lexicon.items()), LEXICON)


def _inline_lexicon(lexicon: Lexicon, limit: int) -> dict[str, int] | None:
    """The lexicon as a dict, or None when it has more than ``limit`` entries."""
    if not isinstance(lexicon, DataFrame):
        fits = len(lexicon) <= limit and len(set(lexicon.values())) <= INLINE_POLARITIES
        return dict(lexicon) if fits else None
    rows = conform(lexicon, LEXICON).dropna().limit(limit + 1).collect()
    if len(rows) > limit:
        return None
    merged: dict[str, int] = {}
    for token, polarity in rows:
        merged[token] = merged.get(token, 0) + polarity
    return merged if len(set(merged.values())) <= INLINE_POLARITIES else None


def _token_polarity(token: Column, lexicon: Mapping[str, int]) -> Column:
    """Polarity of one token: one hash-set test per distinct polarity."""
    by_polarity: dict[int, list[str]] = {}
    for word, polarity in lexicon.items():
        by_polarity.setdefault(polarity, []).append(word)
    result = F.lit(0)
    for polarity, words in sorted(by_polarity.items()):
        result = F.when(token.isin(words), F.lit(polarity)).otherwise(result)
    return result


def _inline_total(text: Column, lexicon: Mapping[str, int]) -> Column:
    def sentence_total(words: Column) -> Column:
        polarity = F.aggregate(words, F.lit(0), lambda acc, w: acc + _token_polarity(w, lexicon))
        return weighted(F.size(words), sentence_polarity(polarity))

    return F.aggregate(
        sentence_tokens(text),
        F.lit(0).cast("long"),
        lambda acc, words: acc + sentence_total(words),
    )


def _word_rows(posts: DataFrame, text: str, keys: list[str]) -> DataFrame:
    """One row per token, with the number of its sentence and that sentence's size."""
    by_sentence = posts.select(*keys, F.posexplode(sentence_tokens(F.col(text))))
    return by_sentence.select(
        *keys,
        F.col("pos").alias("_sentence"),
        F.size("col").alias("_words"),
        F.explode("col").alias("token"),
    )


def _post_totals(matched: DataFrame, keys: list[str]) -> DataFrame:
    """Sum per text from its tokens with a polarity; texts without one do not come out."""
    # A row's tokens come from one task, which adds them up before anything is sent.
    by_sentence = matched.groupBy(*keys, "_row", "_sentence", "_words").agg(
        F.sum("_polarity").alias("_polarity")
    )
    part = weighted(F.col("_words"), sentence_polarity(F.col("_polarity")))
    by_row = by_sentence.groupBy(*keys, "_row").agg(F.sum(part).alias("_total"))
    # Rows with equal texts have equal sums, of which one counts.
    return by_row.groupBy(*keys).agg(F.max("_total").alias("_total"))


def score_with(
    posts: DataFrame,
    scorer_factory: Callable[[], Scorer],
    text: str = "text",
    low: int = LOW,
    high: int = HIGH,
    form: str = "signed",
) -> DataFrame:
    """Add ``sentiment`` from a model of your own.

    ``scorer_factory`` runs once per task and returns a function from a batch of
    cleaned texts to their sentences, each a dict with ``tokens`` (how many) and
    ``sentence_class`` (0..4). Only the text column travels to Python, in Arrow
    batches; weighting and buckets stay in Spark.
    """

    @F.pandas_udf("array<struct<tokens: int, sentence_class: int>>")
    def annotate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = scorer_factory()
        for batch in batches:
            yield scorer(batch)

    total = F.aggregate(
        "_sentences",
        F.lit(0).cast("long"),
        lambda acc, s: acc + weighted(s["tokens"], class_polarity(s["sentence_class"])),
    )
    return (
        posts.withColumn("_sentences", annotate(clean(F.col(text))))
        .withColumn("_total", total)
        .withColumn("sentiment", bucket(F.col("_total"), low, high, form))
        .drop("_sentences", "_total")
    )
