"""DataFrame operators: activity, labels, sampling, sentiment, scaling, folds, metrics."""

from crowdtape.operators.activity import daily_activity, trading_days
from crowdtape.operators.calendar import asof_join, session_labels
from crowdtape.operators.dedupe import dedupe, dedupe_against, filter_blocks, key_filter, may_be_stored, merge_filters
from crowdtape.operators.folds import fold_column
from crowdtape.operators.labels import next_day_label
from crowdtape.operators.metrics import accuracy, confusion, weighted_recall
from crowdtape.operators.normalize import zscore
from crowdtape.operators.quality import StepCounter, class_balance, step_counts
from crowdtape.operators.sampling import cap_per_group
from crowdtape.operators.sentiment import score, score_with
from crowdtape.operators.states import activity_of, daily_states, merge_states, moments_of, negated
from crowdtape.operators.terms import agreement, fit_term_bayes, learn_lexicon, predict_terms
from crowdtape.operators.votes import join_predictions, vote

__all__ = [
    "StepCounter",
    "accuracy",
    "activity_of",
    "agreement",
    "asof_join",
    "cap_per_group",
    "class_balance",
    "confusion",
    "daily_activity",
    "daily_states",
    "dedupe",
    "dedupe_against",
    "filter_blocks",
    "fit_term_bayes",
    "fold_column",
    "join_predictions",
    "key_filter",
    "learn_lexicon",
    "may_be_stored",
    "merge_filters",
    "merge_states",
    "moments_of",
    "negated",
    "next_day_label",
    "predict_terms",
    "score",
    "score_with",
    "session_labels",
    "step_counts",
    "trading_days",
    "vote",
    "weighted_recall",
    "zscore",
]
