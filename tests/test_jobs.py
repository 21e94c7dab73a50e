"""Whole jobs on small files."""

from __future__ import annotations

import datetime as dt

import pytest

from crowdtape import plans, sources
from crowdtape.__main__ import main
from crowdtape.plans import mood
from crowdtape.sources.labeled import COLUMNS
from crowdtape.sources.raw_posts import HEADER


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    root = tmp_path_factory.mktemp("files")
    days = [dt.date(2024, 1, 1) + dt.timedelta(n) for n in range(70)]
    lines = [HEADER]
    number = 0
    for n, day in enumerate(days):
        for i in range(3 + n % 2):
            number += 1
            text = "a good day" if n % 2 else "a bad bad day"
            lines.append(f'u{i};{day:%Y/%m/%d} 10:0{i};{i};{n % 5};"{text} ";;;;"{number}";http://x')
    lines += ["broken", lines[1]]
    (root / "posts.txt").write_text("\n".join(lines))
    rows = [
        f"{d},1,1,1,{10 + (n % 2)},100,1" for n, d in enumerate(days) if d.weekday() < 5
    ]
    (root / "prices.csv").write_text("\n".join(["date,open,high,low,close,volume,adjClose", *rows]))
    (root / "lexicon.csv").write_text("token,polarity\ngood,2\nbad,-1\n")
    labeled = [",".join(COLUMNS)]
    for n in range(45):
        word = ("negative", "neutral", "positive")[n % 3]
        text = ("bad bad trip", "some trip", "good day")[n % 3]
        values = {"tweet_id": str(n), "airline_sentiment": word, "text": text}
        labeled.append(",".join(values.get(c, "") for c in COLUMNS))
    (root / "labeled.csv").write_text("\n".join(labeled))
    return root


def test_direction_job(spark, files, tmp_path):
    lexicon = sources.read_lexicon(spark, str(files / "lexicon.csv"))
    args = (spark, str(files / "posts.txt"), str(files / "prices.csv"), lexicon, str(tmp_path))
    result = plans.direction_job(*args, trees=3, folds=2)
    assert 0 <= result.avgMetrics[0] <= 1
    features = spark.read.parquet(str(tmp_path / "features"))
    assert features.count() == 49
    assert {r.label for r in features.select("label").collect()} == {0.0, 1.0}
    assert {r.total_sentiment for r in features.select("total_sentiment").collect()} == {4.0, -3.0}
    counts = {r.step: r.rows for r in spark.read.parquet(str(tmp_path / "step_counts")).collect()}
    assert counts == {
        "trading day posts": 175,
        "active days": 50,
        "labelled days": 49,
        "scored posts": 175,
        "feature days": 49,
        "posts": 245,
        "rejected lines": 1,
    }


def test_features_follow_files_and_options(spark, files, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.txt").write_text((files / "posts.txt").read_text())
    lexicon = {"good": 2, "bad": -1}
    work = str(tmp_path / "work")

    def days(words=lexicon, **options):
        args = (spark, str(raw), str(files / "prices.csv"), words, work)
        plans.direction_job(*args, trees=2, folds=2, **options)
        features = spark.read.parquet(f"{work}/features")
        return features.count(), features.agg({"total_sentiment": "sum"}).first()[0]

    first = days()
    assert first[0] == 49
    made_of = lambda: sorted(p.name for p in (tmp_path / "work" / "features" / "_made_of").iterdir())
    before = made_of()
    assert days() == first and made_of() == before  # nothing has changed, nothing is made
    assert days({"good": -2, "bad": 1})[1] != first[1] and made_of() != before
    (raw / "b.txt").write_text('u;2024/01/02 10:05;1;1;"a good day";;;;"9001";http://x')
    assert days()[1] == first[1] + 1
    assert days(start="2024-02-01", end="2024-02-20")[0] == 14


def test_mood_job(spark, files, tmp_path):
    moods = plans.mood_job(
        spark,
        str(files / "posts.txt"),
        str(files / "labeled.csv"),
        str(tmp_path),
        classifiers=(
            mood.mood_forest(num_trees=3),
            plans.perceptron(layers=(50, 5, 3), max_iterations=5),
            plans.naive_bayes(),
        ),
    )
    assert moods.count() == 245
    assert {r.prediction for r in moods.select("prediction").collect()} <= {0.0, 1.0, 2.0}


def test_report_from_the_command_line(spark, files, tmp_path):
    main(
        ["report", "--posts", str(files / "posts.txt"), "--prices", str(files / "prices.csv")]
        + ["--work-dir", str(tmp_path / "work"), "--output", str(tmp_path / "out")]
    )
    counts = spark.read.csv(str(tmp_path / "out" / "posts_per_day"), header=True)
    assert counts.columns == ["day", "posts_per_day"] and counts.count() == 70
    overlay = spark.read.csv(str(tmp_path / "out" / "overlay"), header=True)
    assert overlay.count() == 70 + 50
