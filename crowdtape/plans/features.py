"""The daily feature table: activity, price direction and sentiment."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtape.operators.activity import daily_activity, trading_days
from crowdtape.operators.calendar import session_labels
from crowdtape.operators.labels import next_day_label
from crowdtape.operators.quality import unwatched
from crowdtape.operators.sampling import cap_per_group
from crowdtape.operators.sentiment import Lexicon, score

# Sums of the post columns that become features.
POST_MEASURES = {"sum_shares": "retweets", "sum_likes": "favorites"}


def daily_sentiment(
    posts: DataFrame,
    scorer: Lexicon | Callable[[DataFrame], DataFrame],
    cap: int | None = None,
    seed: int = 0,
    by: Sequence[str] = (),
    weekdays_only: bool = True,
    watch: Callable[[DataFrame, str], DataFrame] = unwatched,
) -> DataFrame:
    """Sum of post sentiments per date, over all posts or at most ``cap`` random ones a day.

    ``scorer`` is a lexicon, or a function that adds ``sentiment`` to the posts
    (such as one built on ``score_with``). Posts may come without ``text`` when
    the scorer looks the texts up itself. Weekends are dropped first: they have
    no price, so they would be scored in vain. A sample is drawn from narrow
    rows, and texts only meet the ids that were drawn.
    """
    keys = [*by, "date"]
    text = ["text"] if "text" in posts.columns else []
    days = trading_days(posts) if weekdays_only else posts
    chosen = days.select(*keys, *text, "id")
    if cap is not None:
        drawn = cap_per_group(chosen.select(*keys, "id"), keys, "id", cap, seed)
        chosen = chosen.join(drawn, [*keys, "id"], "left_semi") if text else drawn
    scored = scorer(chosen) if callable(scorer) else score(chosen, scorer)
    scored = watch(scored, "scored posts")
    return scored.groupBy(*keys).agg(F.sum("sentiment").alias("total_sentiment"))


def build_features(
    posts: DataFrame,
    prices: DataFrame,
    scorer: Lexicon | Callable[[DataFrame], DataFrame] | None = None,
    measures: Mapping[str, str] | None = POST_MEASURES,
    price: str = "close",
    mode: str = "calendar",
    cap: int | None = None,
    seed: int = 0,
    by: Sequence[str] = (),
    sort: bool = True,
    watch: Callable[[DataFrame, str], DataFrame] = unwatched,
    sessions: DataFrame | None = None,
) -> DataFrame:
    """One row per trading day with posts, a price and a next price.

    Columns: ``by``, ``date``, ``post_count``, one sum per measure, ``price``,
    ``next_price``, ``label`` and, with a ``scorer``, ``total_sentiment``. The
    joins run on daily tables, never on posts, and sorting comes last. ``watch`` (a
    ``StepCounter``) gets each step with its name and returns it; leave ``sort`` off
    then, since Spark runs what it sorts a second time to find the ranges.

    With ``sessions(date)`` the days of the exchange replace weekdays and calendar
    days: posts and prices of other days are left out, and the next price is that of
    the next session with one.
    """
    keys = [*by, "date"]
    if sessions is None:
        days = trading_days(posts)
        labels = next_day_label(prices, mode, price=price, by=by)
    else:
        days = posts = posts.join(sessions.select("date").distinct(), "date", "left_semi")
        labels = session_labels(prices.select(*keys).distinct(), prices, sessions, price=price, by=by)
        labels = labels.filter(F.col("date") == F.col("price_date")).drop("price_date", "next_date")
        labels = labels.filter(F.col("next_price").isNotNull())
    activity = daily_activity(watch(days, "trading day posts"), measures, by=by)
    features = watch(activity, "active days").join(watch(labels, "labelled days"), keys)
    if scorer is not None:
        features = features.join(
            daily_sentiment(posts, scorer, cap, seed, by, weekdays_only=sessions is None, watch=watch), keys
        )
    features = watch(features, "feature days")
    return features.orderBy(*keys) if sort else features
