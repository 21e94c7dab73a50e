"""Whole jobs put together from the operators."""

from crowdtape.plans.direction import assemble, cross_validate, forest
from crowdtape.plans.features import build_features, daily_sentiment
from crowdtape.plans.ingest import (
    load_posts,
    read_daily_activity,
    read_daily_states,
    read_posts,
    read_rejected,
    sync_posts,
)
from crowdtape.plans.jobs import direction_job, mood_job, report_job
from crowdtape.plans.mood import (
    fit_mood_models,
    fit_vectorizer,
    naive_bayes,
    perceptron,
    score_moods,
    word2vec_features,
)
from crowdtape.plans.reports import normalized_overlay, posts_per_day, price_per_day
from crowdtape.plans.word_vectors import (
    cooccurrences,
    fit_count_vectorizer,
    fit_word_vectors,
    mean_vectors,
    pair_information,
    positive_pmi,
)

__all__ = [
    "assemble",
    "build_features",
    "cooccurrences",
    "cross_validate",
    "daily_sentiment",
    "direction_job",
    "fit_count_vectorizer",
    "fit_mood_models",
    "fit_vectorizer",
    "fit_word_vectors",
    "forest",
    "load_posts",
    "mean_vectors",
    "mood_job",
    "naive_bayes",
    "normalized_overlay",
    "pair_information",
    "perceptron",
    "positive_pmi",
    "posts_per_day",
    "price_per_day",
    "read_daily_activity",
    "read_daily_states",
    "read_posts",
    "read_rejected",
    "report_job",
    "score_moods",
    "sync_posts",
    "word2vec_features",
]
