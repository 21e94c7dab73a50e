from __future__ import annotations

import datetime as dt
import random
from itertools import permutations, product

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowdtape import functions as fx
from crowdtape import operators as ops
from crowdtape.operators import sentiment as sentiment_module

relaxed = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


def one(spark, column, **values):
    """Value of an expression over one row of string or numeric literals."""
    df = spark.range(1).select(*(F.lit(v).alias(k) for k, v in values.items()))
    return df.select(column.alias("x")).first().x


def day(n: int) -> dt.date:
    return dt.date(2024, 1, n)


def physical_plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- dates and labels --------------------------------------------------------


def test_trading_days(spark):
    df = spark.createDataFrame([(day(n),) for n in range(5, 9)], "date date")
    assert [r.date for r in ops.trading_days(df).orderBy("date").collect()] == [day(5), day(8)]
    bounded = ops.trading_days(df, start="2024-01-06", end="2024-01-08")
    assert [r.date for r in bounded.collect()] == [day(8)]


def test_date_bounds_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(day(5), 1)], "date date, n int").write.parquet(str(tmp_path / "d"))
    df = ops.trading_days(spark.read.parquet(str(tmp_path / "d")), start="2024-01-02")
    assert "GreaterThanOrEqual(date" in physical_plan(df)


def test_previous_trading_day(spark):
    df = spark.createDataFrame([(day(n),) for n in range(5, 10)], "date date")
    got = [r[0] for r in df.orderBy("date").select(fx.previous_trading_day(F.col("date"))).collect()]
    assert got == [day(4), day(5), day(6), day(5), day(8)]


def prices(spark, *rows):
    return spark.createDataFrame(list(rows), "date date, close double")


def labels(df):
    return [(r.date.day, r.price, r.next_price, r.label) for r in df.orderBy("date").collect()]


def test_calendar_label_joins_friday_to_monday(spark):
    df = ops.next_day_label(prices(spark, (day(5), 10.0), (day(8), 11.0), (day(9), 11.0)))
    assert labels(df) == [(5, 10.0, 11.0, 1.0), (8, 11.0, 11.0, 0.0)]


def test_holiday_drops_out_of_calendar_but_not_of_next_row(spark):
    df = prices(spark, (day(5), 10.0), (day(9), 9.0))
    assert labels(ops.next_day_label(df)) == []
    assert labels(ops.next_day_label(df, mode="next_row")) == [(5, 10.0, 9.0, 0.0)]
    with pytest.raises(ValueError):
        ops.next_day_label(df, mode="other")


@pytest.mark.parametrize("mode", ["calendar", "next_row"])
def test_null_price_gives_null_label(spark, mode):
    df = prices(spark, (day(8), 10.0), (day(9), None), (day(10), 1.0))
    assert labels(ops.next_day_label(df, mode=mode)) == [
        (8, 10.0, None, None),
        (9, None, 1.0, None),
    ]


def test_weekend_prices_are_left_out(spark):
    df = ops.next_day_label(prices(spark, (day(5), 10.0), (day(6), 9.0), (day(8), 11.0)))
    assert labels(df) == [(5, 10.0, 11.0, 1.0)]


def test_two_prices_for_one_day_are_an_error(spark):
    df = ops.next_day_label(prices(spark, (day(8), 10.0), (day(8), 9.0), (day(9), 11.0)))
    with pytest.raises(Exception, match="two prices for 2024-01-08"):
        df.collect()


def test_labels_per_ticker(spark):
    rows = [("a", day(8), 1.0), ("a", day(9), 2.0), ("b", day(8), 2.0), ("b", day(9), 1.0)]
    df = spark.createDataFrame(rows, "ticker string, date date, close double")
    for mode in ("calendar", "next_row"):
        got = ops.next_day_label(df, mode=mode, by=["ticker"]).collect()
        assert {(r.ticker, r.label) for r in got} == {("a", 1.0), ("b", 0.0)}


def test_price_table_is_computed_once_for_both_sides(spark):
    df = spark.createDataFrame([(day(8), 1.0)] * 5, "date date, close double")
    daily = df.filter(fx.is_trading_day(F.col("date"))).groupBy("date").agg(F.max("close").alias("close"))
    labelled = ops.next_day_label(daily)
    labelled.collect()
    assert "ReusedExchange" in physical_plan(labelled)


# --- activity, dedupe, sample ------------------------------------------------


def test_daily_activity_sums_all_numeric_columns(spark):
    df = spark.createDataFrame(
        [(day(8), 1, 2.5, "x"), (day(8), 3, 0.5, "y"), (day(9), None, 1.0, "z")],
        "date date, a int, b double, c string",
    )
    got = ops.daily_activity(df)
    assert got.columns == ["date", "post_count", "sum_a", "sum_b"]
    assert [tuple(r) for r in got.orderBy("date").collect()] == [
        (day(8), 2, 4, 3.0),
        (day(9), 1, None, 1.0),
    ]
    named = ops.daily_activity(df, {"total": "a"}, by=["c"])
    assert named.columns == ["c", "date", "post_count", "total"] and named.count() == 3
    assert physical_plan(got).count("Exchange") == 1


def test_dedupe_keeps_the_earliest_on_every_partitioning(spark):
    rows = [("1", day(9), "b"), ("1", day(8), "z"), ("1", day(8), "a"), ("2", day(9), "c")]
    rows += [("hot", day(n % 28 + 1), f"{n:04d}") for n in range(500)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "id string, timestamp date, text string")
    expected = {("1", day(8), "a"), ("2", day(9), "c"), ("hot", day(1), "0000")}
    for n in (1, 7):
        assert {tuple(r) for r in ops.dedupe(df.repartition(n)).collect()} == expected
    assert physical_plan(ops.dedupe(df)).count("WindowGroupLimit") == 2


def sample(df, **options):
    return {tuple(r) for r in ops.cap_per_group(df, **options).collect()}


def test_cap_is_exact_and_independent_of_partitions_and_salts(spark):
    """One day holds most of the rows."""
    rows = [(day(8), str(n), f"t{n}") for n in range(3000)] + [(day(9), str(n), "u") for n in range(5)]
    df = spark.createDataFrame(rows, "date date, id string, text string")
    full = {tuple(r) for r in df.collect()}
    got = sample(df, cap=50, seed=3)
    assert got <= full
    assert sum(r[0] == day(8) for r in got) == 50 and sum(r[0] == day(9) for r in got) == 5
    for n, salts in product((1, 13), (1, 64)):
        assert sample(df.repartition(n), cap=50, seed=3, salts=salts) == got
    assert sample(df, cap=50, seed=4) != got


def test_cap_beyond_the_group_limit_of_spark(spark):
    df = spark.createDataFrame([(day(8), str(n)) for n in range(3000)], "date date, id string")
    assert len(sample(df.repartition(5), cap=2000)) == 2000
    assert len(sample(df.repartition(5), cap=5000)) == 3000


def test_cap_plan_limits_before_each_shuffle(spark):
    df = spark.createDataFrame([(day(8), "1", "t")], "date date, id string, text string")
    assert physical_plan(ops.cap_per_group(df)).count("WindowGroupLimit") == 4


@relaxed
@given(st.lists(st.tuples(st.integers(1, 4), st.integers(0, 60)), unique=True, max_size=80), st.integers(1, 6))
def test_cap_property(spark, pairs, cap):
    df = spark.createDataFrame([(day(d), str(i)) for d, i in pairs], "date date, id string")
    got = sample(df, cap=cap)
    for d in range(1, 5):
        size = sum(p[0] == d for p in pairs)
        assert sum(r[0] == day(d) for r in got) == min(size, cap)


# --- text --------------------------------------------------------------------


@pytest.mark.parametrize(
    "text, expected",
    [
        ("@joe|x hi ☀+1", " hi 1"),
        ("a|b @x_y|z w", "ab  w"),
        ("😀 ok️", " ok"),
        ("mail me@here", "mail me"),
        ("plain", "plain"),
        (None, None),
    ],
)
def test_clean(spark, text, expected):
    assert one(spark, fx.clean(F.col("t").cast("string")), t=text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        ("a  -- b1 \nc", ["a", "b1", "\nc"]),
        ("@joe hi", ["hi"]),
        ("☀ ☀a é ٣", ["☀a", "é", "٣"]),
        ("\U0001d400 \U0001d400x", ["\U0001d400x"]),
        ("", []),
    ],
)
def test_tokens(spark, text, expected):
    assert one(spark, fx.tokens(F.col("t")), t=text) == expected


def test_sentences(spark):
    got = one(spark, fx.sentences(F.col("t")), t="A b.  C d?! e\n\nf 3.5")
    assert got == ["A b", "C d", "e", "f 3", "5"]


@pytest.mark.parametrize(
    "value, expected",
    [("123", True), ("", True), ("12a", False), ("-1", False), ("1\n", False), ("٣", True), (None, False)],
)
def test_valid_id(spark, value, expected):
    assert one(spark, fx.valid_id(F.col("t").cast("string")), t=value) is expected


def test_unquote_and_non_empty(spark):
    assert one(spark, fx.unquote(F.col("t")), t='"12"3') == "123"
    for value, expected in (("x", True), (" ", True), ("", False), (None, False)):
        assert one(spark, fx.non_empty(F.col("t").cast("string")), t=value) is expected


# --- scores ------------------------------------------------------------------


@pytest.mark.parametrize(
    "mood, label",
    [("negative", 0.0), ("neutral", 1.0), ("positive", 2.0), ("other", 1.0), ("Positive", 1.0), (None, 1.0)],
)
def test_mood_label(spark, mood, label):
    assert one(spark, fx.mood_label(F.col("t").cast("string")), t=mood) == label


def test_bucket(spark):
    df = spark.createDataFrame([(n,) for n in (-4, -3, 0, 1, 2, None)], "n long")
    for form, expected in (
        ("signed", [-1.0, 0.0, 0.0, 0.0, 1.0, None]),
        ("class", [0.0, 1.0, 1.0, 1.0, 2.0, None]),
    ):
        assert [r[0] for r in df.select(fx.bucket(F.col("n"), form=form)).collect()] == expected
    assert df.select(fx.bucket(F.col("n"), low=0, high=0)).first()[0] == -1.0


def test_class_polarity(spark):
    df = spark.createDataFrame([(n,) for n in range(5)], "n int")
    assert [r[0] for r in df.select(fx.class_polarity(F.col("n"))).collect()] == [-2, -1, 0, 1, 2]
    with pytest.raises(Exception, match="out of range"):
        df.select(fx.class_polarity(F.col("n") + 1)).collect()


def test_majority_vote_is_symmetric(spark):
    def expected(votes):
        for v in votes:
            if votes.count(v) > 1:
                return v
        return 1.0

    cases = list(product((0.0, 1.0, 2.0), repeat=3))
    df = spark.createDataFrame(cases, "a double, b double, c double")
    for order in permutations("abc"):
        voted = ops.vote(df, order).collect()
        assert [r.prediction for r in voted] == [expected(list(c)) for c in cases]
    partial = spark.createDataFrame([(1.0, 1.0, None)], "a double, b double, c double")
    assert ops.vote(partial, "abc").first().prediction is None


def test_join_predictions(spark):
    keys = "date date, id string, text string"
    parts = [
        spark.createDataFrame([(day(8), "1", "t", v), (day(8), str(n), "t", 0.0)], f"{keys}, {c} double")
        for n, (c, v) in enumerate((("a", 0.0), ("b", 2.0), ("c", 2.0)), start=2)
    ]
    joined = ops.join_predictions(parts).collect()
    assert [tuple(r) for r in joined] == [(day(8), "1", "t", 0.0, 2.0, 2.0)]


# --- sentiment ---------------------------------------------------------------

LEXICON = {"good": 1, "great": 2, "bad": -1, "awful": -2}


def python_score(text, lexicon):
    """The same contract, word by word."""
    import re

    total = 0
    for sentence in filter(None, re.split(r"[.!?]+\s*|\n+", text)):
        words = [w for w in sentence.split(" ") if any(c.isalnum() for c in w)]
        polarity = sum(lexicon.get(w, 0) for w in words)
        total += len(words) * max(-2, min(2, polarity))
    return -1.0 if total < -3 else 1.0 if total > 1 else 0.0


def test_one_positive_sentence_of_two_tokens_is_high(spark):
    df = spark.createDataFrame([("1", "good day")], "id string, text string")
    assert ops.score(df, LEXICON).first().sentiment == 1.0


words = st.sampled_from([*LEXICON, "day", "--", "so", "3"])
texts = st.lists(st.tuples(words, st.sampled_from([" ", ". ", "! ", "\n", "  "])), max_size=20).map(
    lambda parts: "".join(w + s for w, s in parts)
)


@relaxed
@given(st.lists(texts, min_size=1, max_size=20))
def test_all_plans_agree_with_the_contract(spark, batch):
    rows = [(str(i), t) for i, t in enumerate(batch)]
    df = spark.createDataFrame(rows, "id string, text string")
    expected = {i: python_score(t, LEXICON) for i, t in rows}
    for options in ({}, {"inline_limit": 0}, {"inline_limit": 0, "broadcast_limit": 0, "salts": 3}):
        got = {r.id: r.sentiment for r in ops.score(df, LEXICON, **options).collect()}
        assert got == expected


def test_repeated_and_null_ids_change_no_score(spark):
    texts = ["up up", "down down.", "up up", "day", None, "down down."]
    rows = [(i, t) for i, t in zip(["a", "a", "a", None, None, None], texts, strict=True)]
    df = spark.createDataFrame(rows, "id string, text string")
    lexicon = {"up": 2, "down": -2}
    expected = sorted(
        (str(i), str(t), str(None if t is None else python_score(t, lexicon))) for i, t in rows
    )
    for options in ({}, {"inline_limit": 0}, {"inline_limit": 0, "broadcast_limit": 0}):
        scored = ops.score(df, lexicon, **options).collect()
        assert sorted((str(r.id), str(r.text), str(r.sentiment)) for r in scored) == expected


def test_thousands_of_polarities(spark):
    lexicon = {f"w{i}": i - 2500 for i in range(5000)}
    df = spark.createDataFrame([("1", "w4999 day"), ("2", "w0 day"), ("3", "x")], "id string, text string")
    got = {r.id: r.sentiment for r in ops.score(df, lexicon).collect()}
    assert got == {"1": 1.0, "2": -1.0, "3": 0.0}


def test_texts_cross_no_exchange_for_their_scores(spark):
    df = spark.range(5).selectExpr("cast(id as string) AS id", "concat('up ', id) AS text")
    scored = ops.score(df, LEXICON, inline_limit=0, broadcast_limit=0).select("id", "sentiment")
    for line in physical_plan(scored).splitlines():
        if "Exchange hash" in line:
            assert "text" not in line


def test_accuracy_counts_missing_predictions_as_misses(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, None), (0.0, None)], "label double, prediction double")
    assert ops.accuracy(df).first()[0] == pytest.approx(1 / 3)


def test_null_text_has_no_sentiment(spark):
    df = spark.createDataFrame([("1", None), ("2", "")], "id string, text string")
    for options in ({}, {"inline_limit": 0}):
        got = {r.id: r.sentiment for r in ops.score(df, LEXICON, **options).collect()}
        assert got == {"1": None, "2": 0.0}


def test_lexicon_table_adds_up_repeated_tokens(spark):
    lexicon = spark.createDataFrame([("up", 1), ("up", 1), (None, 2)], "token string, polarity int")
    df = spark.createDataFrame([("1", "up")], "id string, text string")
    for options in ({}, {"inline_limit": 1}):
        assert ops.score(df, lexicon, **options).first().sentiment == 1.0
    assert sentiment_module._inline_lexicon(lexicon, 1) is None


def test_many_tokens_are_looked_up_in_a_hash_set(spark):
    lexicon = {f"w{i}": 1 for i in range(3000)}
    df = spark.createDataFrame([("1", "w1 w2999"), ("2", "x")], "id string, text string")
    scored = ops.score(df, lexicon)
    assert "INSET" in physical_plan(scored)
    assert "Exchange" not in physical_plan(scored)
    assert {r.id: r.sentiment for r in scored.collect()} == {"1": 1.0, "2": 0.0}


def test_plugged_in_model(spark):
    def factory():
        import pandas as pd

        return lambda batch: pd.Series(
            [[{"tokens": len(t), "sentence_class": 4 if "up" in t else 0}] for t in batch]
        )

    df = spark.createDataFrame([("1", "up"), ("2", "down"), ("3", "@you")], "id string, text string")
    scored = ops.score_with(df, factory, form="class")
    assert {r.id: r.sentiment for r in scored.collect()} == {"1": 2.0, "2": 0.0, "3": 1.0}
    assert "ArrowEvalPython" in physical_plan(scored)


def test_plugged_in_model_with_an_unknown_class_stops(spark):
    def factory():
        import pandas as pd

        return lambda batch: pd.Series([[{"tokens": 1, "sentence_class": 7}] for _ in batch])

    df = spark.createDataFrame([("1", "x")], "id string, text string")
    with pytest.raises(Exception, match="out of range"):
        ops.score_with(df, factory).collect()


# --- scaling, folds, metrics, counts -----------------------------------------


def test_zscore(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (None,)], "x double")
    got = [r.z for r in ops.zscore(df, "x").orderBy("x").collect()]
    assert got == [None, -1.0, 0.0, 1.0]
    plan = physical_plan(ops.zscore(df, "x"))
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("values", [[5.0], [5.0, 5.0, 5.0]])
def test_zscore_without_spread_is_zero(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert {r.z for r in ops.zscore(df, "x").collect()} == {0.0}


def test_folds_cover_and_repeat(spark):
    df = spark.range(2000)
    folds = {r.id: r.fold for r in ops.fold_column(df, "id").collect()}
    assert set(folds.values()) == set(range(10))
    sizes = [list(folds.values()).count(k) for k in range(10)]
    assert min(sizes) > 120 and max(sizes) < 280
    again = {r.id: r.fold for r in ops.fold_column(df.repartition(5), "id").collect()}
    assert again == folds
    assert {r.id: r.fold for r in ops.fold_column(df, "id", seed=1).collect()} != folds


@relaxed
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 2)), min_size=1, max_size=50))
def test_weighted_recall_equals_accuracy(spark, pairs):
    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "label double, prediction double")
    hits = sum(a == b for a, b in pairs) / len(pairs)
    assert ops.accuracy(df).first()[0] == pytest.approx(hits)
    assert ops.weighted_recall(df).first()[0] == pytest.approx(hits)
    assert {(r.label, r.prediction): r.rows for r in ops.confusion(df).collect()} == {
        (float(a), float(b)): pairs.count((a, b)) for a, b in pairs
    }


def test_metrics_agree_with_the_evaluator(spark, sf_dir):
    from tapecheck import views
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator

    votes = ["forest_prediction", "perceptron_prediction", "bayes_prediction"]
    df = ops.vote(views.predictions(spark, sf_dir), votes)
    for name, own in (("weightedRecall", ops.weighted_recall), ("accuracy", ops.accuracy)):
        theirs = MulticlassClassificationEvaluator(metricName=name).evaluate(df)
        assert own(df).first()[0] == pytest.approx(theirs)


def test_counts(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.0,)], "label double")
    assert {r.label: r.rows for r in ops.class_balance(df).collect()} == {0.0: 1, 1.0: 2}
    steps = ops.step_counts({"all": df, "ones": df.filter("label = 1")})
    assert {r.step: r.rows for r in steps.collect()} == {"all": 3, "ones": 2}
