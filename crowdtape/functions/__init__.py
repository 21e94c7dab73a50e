"""Column functions: each takes columns and returns one Catalyst expression."""

from crowdtape.functions.dates import is_trading_day, previous_trading_day
from crowdtape.functions.scores import (
    bucket,
    class_polarity,
    direction_label,
    majority_vote,
    mood_label,
)
from crowdtape.functions.text import (
    clean,
    non_empty,
    sentences,
    sentences_by_rules,
    strip_emoji,
    strip_handles,
    tokens,
    unquote,
    valid_id,
    word_tokens,
)

__all__ = [
    "bucket",
    "class_polarity",
    "clean",
    "direction_label",
    "is_trading_day",
    "majority_vote",
    "mood_label",
    "non_empty",
    "previous_trading_day",
    "sentences",
    "sentences_by_rules",
    "strip_emoji",
    "strip_handles",
    "tokens",
    "unquote",
    "valid_id",
    "word_tokens",
]
