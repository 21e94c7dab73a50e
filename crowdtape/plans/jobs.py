"""The jobs a user runs, from files to results."""

from __future__ import annotations

from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.operators.quality import StepCounter, step_counts
from crowdtape.operators.sentiment import Lexicon
from crowdtape.plans.direction import FOLDS, TREES, assemble, cross_validate, forest
from crowdtape.plans.features import build_features
from crowdtape.plans.ingest import load_posts, read_posts
from crowdtape.plans.mood import fit_mood_models, score_moods
from crowdtape.plans.reports import normalized_overlay, posts_per_day, price_per_day
from crowdtape.session import counting_session
from crowdtape.sources.labeled import read_labeled_posts
from crowdtape.sources.manifest import content_hash
from crowdtape.sources.prices import read_prices
from crowdtape.sources.snapshot import load_or_build, remove, write_series


def direction_job(
    spark: SparkSession,
    raw_posts: str,
    prices: str,
    lexicon: Lexicon,
    work_dir: str,
    trees: int = TREES,
    folds: int = FOLDS,
    mode: str = "calendar",
    cap: int | None = None,
    seed: int = 0,
    lenient_time: bool = False,
    start: str | None = None,
    end: str | None = None,
) -> CrossValidatorModel:
    """Cross-validate the direction forest on raw posts and prices.

    The store of parsed posts and the daily features are kept below ``work_dir`` and
    follow the files and options they were made of; of the posts, the months from
    ``start`` to ``end`` alone are read. Days whose price or next price is unknown have
    no label and are left out. ``avgMetrics[0]`` is the mean weighted recall. The rows
    of each step go to ``work_dir``/step_counts, counted while the features are made.
    """
    posts, rejected = load_posts(spark, raw_posts, f"{work_dir}/posts", start, end, lenient_time=lenient_time)

    def build() -> DataFrame:
        watch, counting = StepCounter(), counting_session(spark)
        counted = read_posts(counting, f"{work_dir}/posts", start, end)
        features = build_features(
            counted, read_prices(counting, prices), lexicon, mode=mode, cap=cap, seed=seed, sort=False, watch=watch
        )
        features.write.mode("overwrite").parquet(f"{work_dir}/features.new")
        # Stored posts and rejects are counted from the footers of their files.
        stored = step_counts({"posts": posts, "rejected lines": rejected})
        counts = watch.counts(spark).unionByName(stored)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{work_dir}/step_counts")
        return spark.read.schema(features.schema).parquet(f"{work_dir}/features.new")

    options = {
        "lexicon": content_hash(lexicon),
        "mode": mode,
        "cap": cap,
        "seed": seed,
        "lenient_time": lenient_time,
        "start": start,
        "end": end,
    }
    features = load_or_build(
        spark, f"{work_dir}/features", build, inputs=[raw_posts, prices], options=options
    )
    remove(spark, f"{work_dir}/features.new")
    data = assemble(features.dropna(subset=["label"]), keep=["date", "label"])
    return cross_validate(data, forest(trees), k=folds)


def _description(value):
    """What an option says, of an estimator its parameters instead of its name in memory."""
    if hasattr(value, "extractParamMap"):
        return {p.name: str(v) for p, v in value.extractParamMap().items()} | {"kind": type(value).__name__}
    return [_description(v) for v in value] if isinstance(value, (list, tuple)) else value


def mood_job(
    spark: SparkSession,
    raw_posts: str,
    labeled_posts: str,
    work_dir: str,
    cap: int | None = None,
    seed: int = 0,
    lenient_time: bool = False,
    start: str | None = None,
    end: str | None = None,
    **fit_options,
) -> DataFrame:
    """Train the mood ensemble on labelled posts and write the moods of all raw posts.

    Returns the written predictions, kept as ``work_dir``/moods and made anew when a file
    or an option has changed.
    """
    posts, _ = load_posts(spark, raw_posts, f"{work_dir}/posts", start, end, lenient_time=lenient_time)

    def build() -> DataFrame:
        models = fit_mood_models(read_labeled_posts(spark, labeled_posts), **fit_options)
        return score_moods(posts, models, cap, seed)

    options = {"cap": cap, "seed": seed, "lenient_time": lenient_time, "start": start, "end": end}
    options |= {name: _description(value) for name, value in fit_options.items()}
    return load_or_build(
        spark, f"{work_dir}/moods", build, inputs=[raw_posts, labeled_posts], options=options
    )


def report_job(
    spark: SparkSession,
    raw_posts: str,
    prices: str,
    work_dir: str,
    output_dir: str,
    file_format: str = "csv",
    start: str | None = None,
    end: str | None = None,
) -> None:
    """Write the chart series: posts per day, price per day and their overlay."""
    posts, _ = load_posts(spark, raw_posts, f"{work_dir}/posts", start, end)
    daily = read_prices(spark, prices)
    if start is not None:
        daily = daily.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        daily = daily.filter(F.col("date") <= F.lit(end).cast("date"))
    write_series(posts_per_day(posts), f"{output_dir}/posts_per_day", file_format)
    write_series(price_per_day(daily), f"{output_dir}/price_per_day", file_format)
    write_series(normalized_overlay(posts, daily), f"{output_dir}/overlay", file_format)
