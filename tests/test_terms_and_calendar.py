"""As-of joins, labels by sessions, naive Bayes and the learned lexicon against plain Python."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter
from math import log, sqrt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowdtape import operators as ops
from crowdtape import plans
from crowdtape.operators.terms import agreement

DAY = dt.date(2023, 12, 20)
dates = st.integers(0, 100).map(lambda n: DAY + dt.timedelta(days=n))
keyed = st.tuples(st.sampled_from("ab"), dates)


@settings(max_examples=15, deadline=None)
@given(st.lists(keyed, max_size=12), st.lists(st.tuples(keyed, st.integers(0, 9)), max_size=12), st.booleans(), st.booleans())
def test_asof_join_is_the_nearest_row(spark, asked, given_rows, forward, strict):
    left = spark.createDataFrame([(k, d, n) for n, (k, d) in enumerate(asked)], "k string, date date, n int")
    right = spark.createDataFrame([(k, d, v) for (k, d), v in given_rows], "k string, date date, v int")
    got = ops.asof_join(left, right, ["v"], by=["k"], forward=forward, strict=strict)
    expected = []
    for n, (k, d) in enumerate(asked):
        fits = [
            (e, v)
            for (key, e), v in given_rows
            if key == k and ((e > d if strict else e >= d) if forward else (e < d if strict else e <= d))
        ]
        near = (min if forward else max)(e for e, _ in fits) if fits else None
        expected.append((k, d, n, max(v for e, v in fits if e == near) if fits else None))
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected))


def test_null_dates_and_repeated_days_keep_their_rows(spark):
    left = spark.createDataFrame([(DAY,), (DAY,), (None,)], "date date")
    right = spark.createDataFrame([(DAY, 1), (DAY, 3), (None, 9)], "date date, v int")
    assert sorted(str(r.v) for r in ops.asof_join(left, right, ["v"]).collect()) == ["3", "3", "None"]
    assert ops.asof_join(left, right.limit(0), ["v"]).filter("v IS NULL").count() == 3
    assert ops.asof_join(left.limit(0), right, ["v"]).count() == 0


def test_a_holiday_keeps_its_row_and_a_missing_session_is_passed_over(spark):
    d = lambda n: dt.date(2024, 7, n)
    sessions = spark.createDataFrame([(d(n),) for n in (2, 3, 5, 8)], "date date")  # the 4th is a holiday
    prices = spark.createDataFrame([(d(2), 1.0), (d(3), 2.0), (d(4), 99.0), (d(8), 1.5)], "date date, close double")
    days = spark.createDataFrame([(d(n),) for n in range(1, 10)], "date date")
    got = {r.date.day: tuple(r)[1:] for r in ops.session_labels(days, prices, sessions).collect()}
    assert got[1] == (None, None, 1.0, d(2), None)
    assert got[2] == (1.0, d(2), 2.0, d(3), 1.0)
    assert got[3] == got[4] == got[5] == got[6] == got[7] == (2.0, d(3), 1.5, d(8), 0.0)
    assert got[9] == (1.5, d(8), None, None, None)


def test_no_window_over_the_whole_series(spark):
    rows = [(DAY + dt.timedelta(days=n), float(n)) for n in range(400)]
    prices = spark.createDataFrame(rows, "date date, close double")
    df = ops.session_labels(prices.select("date"), prices, prices.select("date"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Windows over a series have its month as a key; those over months see one row of each.
    assert windows and all("_month" in line for line in windows)
    assert df.count() == 400 and df.filter("label = 1").count() == 399


def test_features_by_session(spark):
    d = lambda n: dt.date(2024, 7, n)
    posts = spark.createDataFrame([(d(n), 1, 1) for n in (3, 3, 4, 5)], "date date, retweets int, favorites int")
    prices = spark.createDataFrame([(d(3), 1.0), (d(5), 2.0), (d(8), 1.0)], "date date, close double")
    got = plans.build_features(posts, prices, sessions=prices.select("date")).collect()
    assert [(r.date.day, r.post_count, r.price, r.next_price, r.label) for r in got] == [
        (3, 2, 1.0, 2.0, 1.0),
        (5, 1, 2.0, 1.0, 0.0),
    ]


# --- terms ----------------------------------------------------------------------

LABELED = "label double, text string, id string"
words = st.lists(st.sampled_from(["good", "bad", "so", "x", "@h", "!"]), max_size=8).map(" ".join)
labeled_rows = st.lists(st.tuples(st.sampled_from([0.0, 1.0, 2.0]), words), min_size=1, max_size=12)


def terms_of(text):
    return [w for part in text.split("!") for w in part.split(" ") if w and not w.startswith("@")]


@settings(max_examples=12, deadline=None)
@given(labeled_rows, st.lists(words, max_size=6))
def test_bayes_is_that_of_plain_python(spark, rows, texts):
    labeled = spark.createDataFrame([(c, t, "1") for c, t in rows], LABELED)
    model = ops.fit_term_bayes(labeled)
    classes = Counter(c for c, _ in rows)
    counts = {c: Counter(w for d, t in rows if d == c for w in terms_of(t)) for c in classes}
    vocabulary = set().union(*counts.values())
    expected = []
    for text in texts:
        scores = {}
        for c in classes:
            scores[c] = log((classes[c] + 1) / (len(rows) + len(classes)))
            size = sum(counts[c].values()) + len(vocabulary)
            scores[c] += sum(log((counts[c][w] + 1) / size) for w in terms_of(text) if w in vocabulary)
        expected.append(min(scores, key=lambda c: (-round(scores[c], 6), c)))
    posts = spark.createDataFrame([(t, n) for n, t in enumerate(texts)], "text string, id int")
    got = {r.id: r.prediction for r in ops.predict_terms(posts, model).collect()}
    assert [got[n] for n in range(len(texts))] == expected


def planted(spark, shuffled=False):
    rng = random.Random(5)
    rows = []
    for n in range(600):
        label = float(n % 3)
        text = " ".join([*rng.choices("abcdefgh", k=6), ("awful", "plain", "lovely")[n % 3] if rng.random() < 0.8 else "a"])
        rows.append((float(rng.randint(0, 2)) if shuffled else label, text, str(n)))
    df = spark.createDataFrame(rows, LABELED)
    return df.filter("int(id) % 5 <> 0"), df.filter("int(id) % 5 = 0")


def test_a_planted_signal_is_found_and_a_shuffled_one_is_not(spark):
    shares = {}
    for shuffled in (False, True):
        training, unseen = planted(spark, shuffled)
        shares[shuffled] = agreement(ops.predict_terms(unseen, ops.fit_term_bayes(training))).first()
    assert shares[False].accuracy > 0.8 and abs(shares[False].majority - 1 / 3) < 0.01
    assert shares[True].accuracy < 0.5 and shares[True].rows == 120


def test_lexicon_has_the_words_that_differ(spark):
    training, unseen = planted(spark)
    found = {r.token: r.polarity for r in ops.learn_lexicon(training).collect()}
    assert found["lovely"] == 2 and found["awful"] == -2 and len(found) <= 4
    rows = [tuple(r) for r in training.select("label", "text").collect()]
    held = {c: Counter(w for lab, t in rows if c in (None, lab) for w in set(terms_of(t))) for c in (None, 2.0, 0.0)}
    total = {c: sum(held[c].values()) for c in held}

    def odds(word, c):
        own = held[c][word] + 100 * held[None][word] / total[None]
        return log(own / (total[c] + 100 - own)), own

    (one, p), (other, m) = odds("lovely", 2.0), odds("lovely", 0.0)
    z = {r.token: r.z for r in ops.learn_lexicon(training).collect()}["lovely"]
    assert z == pytest.approx((one - other) / sqrt(1 / p + 1 / m))
    scored = ops.score(unseen, ops.learn_lexicon(training), form="class", high=1)
    assert scored.filter("label = 2 AND sentiment = 2").count() > 25
    shuffled, _ = planted(spark, shuffled=True)
    assert ops.learn_lexicon(shuffled, cut=3.5).count() == 0


def test_awkward_terms(spark):
    none = spark.createDataFrame([], LABELED)
    posts = spark.createDataFrame([("a b", 1), (None, 2), ("", 3)], "text string, id int")
    assert {r.prediction for r in ops.predict_terms(posts, ops.fit_term_bayes(none)).collect()} == {1.0, None}
    odd = spark.createDataFrame([(None, "a", "1"), (2.0, None, "2"), (2.0, "a", "3"), (0.0, "", "4")], LABELED)
    got = {r.id: r.prediction for r in ops.predict_terms(posts, ops.fit_term_bayes(odd)).collect()}
    assert got == {1: 0.0, 2: None, 3: 0.0}  # one term of one class is as likely in the other: the smaller class
    assert ops.learn_lexicon(none).count() == ops.learn_lexicon(odd).count() == 0


def test_a_model_too_large_to_broadcast(spark, monkeypatch):
    training, unseen = planted(spark)
    model = ops.fit_term_bayes(training)
    small = sorted(map(str, ops.predict_terms(unseen, model).collect()))
    monkeypatch.setitem(ops.predict_terms.__globals__, "BROADCAST_TERMS", 0)
    assert sorted(map(str, ops.predict_terms(unseen, model).collect())) == small
    assert ops.predict_terms(unseen.select(F.lit("a").alias("text"), "label"), model).count() == unseen.count()


def test_texts_are_split_once_for_a_learned_lexicon(spark):
    rows = [(2.0 * (n % 2), f"{'good' if n % 2 else 'bad'} day. {n}") for n in range(40)]
    lexicon = ops.learn_lexicon(spark.createDataFrame(rows, "label double, text string"))
    # Counted terms are read; no text is split again by whoever sizes or broadcasts the lexicon.
    assert "split" not in lexicon._jdf.queryExecution().optimizedPlan().toString()


def test_joined_scores_send_no_single_tokens(spark):
    posts = spark.createDataFrame([("good good day. bad",), ("good good day. bad",), ("bad bad",), (None,)], "text string")
    lexicon = {"good": 2, "bad": -1}
    plain = sorted(str(r.sentiment) for r in ops.score(posts, lexicon).collect())
    for limits in ({"inline_limit": 0}, {"inline_limit": 0, "broadcast_limit": 0}):
        joined = ops.score(posts, lexicon, **limits)
        assert sorted(str(r.sentiment) for r in joined.collect()) == plain
        assert "_place" not in joined._jdf.queryExecution().optimizedPlan().toString()
