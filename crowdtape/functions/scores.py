"""Label, polarity, bucket and vote expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class number of each mood word; any other word counts as neutral.
MOODS = {"negative": 0.0, "neutral": 1.0, "positive": 2.0}
NEUTRAL = 1.0

# A sum below LOW is negative, a sum above HIGH is positive.
LOW = -3
HIGH = 1

# Fixed values: (low, middle, high) result of each bucket form.
FORMS = {"signed": (-1.0, 0.0, 1.0), "class": (0.0, 1.0, 2.0)}


def mood_label(mood: Column) -> Column:
    """Class number of a mood word; unknown words and NULL are neutral."""
    label = F.lit(NEUTRAL)
    for word, number in MOODS.items():
        label = F.when(mood == word, F.lit(number)).otherwise(label)
    return label


def direction_label(price: Column, next_price: Column) -> Column:
    """1.0 when the price rises, else 0.0 (a tie is 0.0), NULL when either is NULL."""
    known = price.isNotNull() & next_price.isNotNull()
    return F.when(known, F.when(next_price - price > 0, 1.0).otherwise(0.0))


def class_polarity(sentence_class: Column) -> Column:
    """Sentence class 0..4 as polarity -2..2; any other class stops the job."""
    return F.when(sentence_class.between(0, 4), sentence_class - 2).otherwise(
        F.raise_error(F.concat(F.lit("sentence class out of range: "), sentence_class)).cast("int")
    )


def bucket(total: Column, low: int = LOW, high: int = HIGH, form: str = "signed") -> Column:
    """Put a summed polarity into one of three buckets; NULL stays NULL."""
    below, middle, above = FORMS[form]
    return (
        F.when(total < low, F.lit(below))
        .when(total > high, F.lit(above))
        .when(total.isNotNull(), F.lit(middle))
    )


def majority_vote(first: Column, second: Column, third: Column) -> Column:
    """The value two of three votes agree on, neutral when all differ, NULL if one is NULL."""
    complete = first.isNotNull() & second.isNotNull() & third.isNotNull()
    return F.when(
        complete,
        F.when((first == second) | (first == third), first)
        .when(second == third, second)
        .otherwise(F.lit(NEUTRAL)),
    )
