from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowdtape import plans, schemas, sources
from crowdtape.sources.raw_posts import HEADER

GOOD = 'u;2016/03/04 09:05;1;2;"a;b";;;;"123";http://x'


def parse(spark, *lines, **options):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    return sources.parse_posts(df, **options).collect()


def test_good_line_keeps_quotes_in_text(spark):
    (row,) = parse(spark, GOOD)
    assert row.reject_reason is None and row.raw is None
    assert row.timestamp == dt.datetime(2016, 3, 4, 9, 5)
    assert row.date == dt.date(2016, 3, 4)
    assert (row.username, row.retweets, row.favorites) == ("u", 1, 2)
    assert (row.text, row.id, row.permalink) == ('"a;b"', "123", "http://x")
    assert (row.geo, row.mentions, row.hashtags) == ("", "", "")


def test_unquote_text(spark):
    line = 'u;2016/03/04 09:05;1;2;"say ""a;b""";;;;"123";http://x'
    (row,) = parse(spark, line, unquote_text=True)
    assert row.text == 'say "a;b"'


def test_header_is_dropped(spark):
    assert len(parse(spark, HEADER, GOOD, HEADER)) == 1


@pytest.mark.parametrize(
    "line, reason",
    [
        (GOOD.replace("2016/03/04 09:05", "2016/13/40 25:61"), "bad time"),
        (GOOD.replace("2016/03/04 09:05", "March"), "bad time"),
        (GOOD.replace(";1;", ";1x;"), "bad retweets"),
        (GOOD.replace(";1;", ";1.5;"), "bad retweets"),
        (GOOD.replace(";1;", "; 1;"), "bad retweets"),
        (GOOD.replace(";2;", ";99999999999;"), "bad favorites"),
        (GOOD.replace('"123"', '"12a"'), "bad id"),
        (GOOD.replace("http://x", ""), "missing fields"),
        ("a;b;c", "missing fields"),
        ("", "missing fields"),
        (None, "no line"),
        (GOOD.replace("a;b", "a\nb"), "line break"),
    ],
)
def test_rejects(spark, line, reason):
    (row,) = parse(spark, line)
    assert row.reject_reason == reason
    assert row.raw == line


def test_quirks_that_are_kept(spark):
    rows = parse(
        spark,
        GOOD.replace('"123"', '""'),
        GOOD.replace(";1;", ";-1;"),
        GOOD.replace(";1;", ";+7;"),
        GOOD.replace("2016/03/04 09:05", "2016/3/4 9:5"),
        GOOD + ";more;fields",
        GOOD.replace("http://x", "") + ";tail",
    )
    assert [r.reject_reason for r in rows] == [None] * 6
    assert rows[0].id == ""
    assert rows[1].retweets == -1 and rows[2].retweets == 7
    assert rows[3].timestamp == dt.datetime(2016, 3, 4, 9, 5)
    assert rows[5].permalink == ""


def test_permalink_may_be_optional(spark):
    line = GOOD.replace("http://x", "")
    (row,) = parse(spark, line, require_permalink=False)
    assert row.reject_reason is None and row.permalink == ""


def test_lenient_time_rolls_over_and_ignores_the_rest(spark):
    times = ["2016/13/40 25:61", "2016/3/4 9:05:33 pm", "2016/2/30 00:00", "x2016/1/1 0:0"]
    rows = parse(
        spark, *(GOOD.replace("2016/03/04 09:05", t) for t in times), lenient_time=True
    )
    assert [r.timestamp for r in rows] == [
        dt.datetime(2017, 2, 10, 2, 1),
        dt.datetime(2016, 3, 4, 9, 5),
        dt.datetime(2016, 3, 1),
        None,
    ]
    assert rows[3].reject_reason == "bad time"


def split_by_rule(line: str) -> list[str]:
    """A separator counts when an even number of quotes follows it."""
    fields, start = [], 0
    for i, c in enumerate(line):
        if c == ";" and line.count('"', i) % 2 == 0:
            fields.append(line[start:i])
            start = i + 1
    return [*fields, line[start:]]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet='a;"é ', max_size=30), min_size=1, max_size=40))
def test_split_follows_the_quote_rule(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    rows = (
        df.select("value", F.split("value", '"').alias("pieces"))
        .select("value", sources.split_fields(F.col("pieces")).alias("fields"))
        .collect()
    )
    assert [r.fields for r in rows] == [split_by_rule(line) for line in lines]


def test_long_line_is_parsed_whole(spark):
    text = '"' + 'word;""x"" ' * 20_000 + '"'
    (row,) = parse(spark, GOOD.replace('"a;b"', text))
    assert row.reject_reason is None and row.text == text


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.sampled_from([GOOD, HEADER, "junk", "", GOOD.replace("1;2", "1;z")]), min_size=1))
def test_every_line_has_one_fate(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    parsed = sources.parse_posts(df)
    good, bad = sources.accepted_posts(parsed).count(), sources.rejected_lines(parsed).count()
    assert good == lines.count(GOOD)
    assert good + bad + lines.count(HEADER) == len(lines)


def test_parse_stays_in_the_jvm_and_splits_once(spark):
    df = spark.createDataFrame([(GOOD,)], "value string")
    plan = sources.accepted_posts(sources.parse_posts(df))._jdf.queryExecution().toString()
    physical = plan[plan.index("== Physical Plan ==") :]
    assert "Python" not in physical and "Exchange" not in physical
    assert physical.count("array_join(transform(") == 1


def test_raw_files_become_a_snapshot(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("\n".join([HEADER, GOOD, GOOD.replace("09:05", "08:00"), "junk"]))
    (raw / "b.csv").write_text("\n".join([HEADER, GOOD.replace("123", "124")]))
    path = str(tmp_path / "posts")
    posts, rejected = plans.load_posts(spark, f"{raw}/*", path)
    assert posts.schema == schemas.POST
    assert {(r.id, r.timestamp.hour) for r in posts.collect()} == {("123", 8), ("124", 9)}
    assert [tuple(r) for r in rejected.collect()] == [("junk", "missing fields")]
    # The second call reads the snapshot: the raw files are no longer looked at.
    again, _ = plans.load_posts(spark, str(tmp_path / "missing"), path)
    assert again.count() == 2


def test_load_or_build(spark, tmp_path):
    path = str(tmp_path / "snap")
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    assert sources.load_or_build(spark, path, build).count() == 3
    assert sources.load_or_build(spark, path, build).count() == 3
    assert len(calls) == 1
    # Part files without the success marker are an unfinished snapshot.
    (tmp_path / "snap" / "_SUCCESS").unlink()
    assert not sources.is_complete(spark, path)
    sources.load_or_build(spark, path, build)
    assert len(calls) == 2


def test_load_or_build_does_not_hide_errors(spark, tmp_path):
    path = tmp_path / "snap"
    path.mkdir()
    (path / "_SUCCESS").touch()
    (path / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        sources.load_or_build(spark, str(path), lambda: spark.range(1)).count()


def test_read_prices_by_name(spark, tmp_path):
    path = tmp_path / "prices.csv"
    path.write_text(
        "volume,date,open,high,low,close,adjClose,extra\n"
        "10,2016-03-04,1.5,2,1,1.75,1.75,x\n"
        "n/a,2016-03-07,1,1,1,oops,1,y\n"
    )
    df = sources.read_prices(spark, str(path))
    assert df.schema == schemas.PRICE
    first, second = df.orderBy("date").collect()
    assert tuple(first) == (dt.date(2016, 3, 4), 1.5, 2.0, 1.0, 1.75, 10, 1.75)
    assert second.volume is None and second.close is None and second.open == 1.0


def test_read_labeled_posts(spark, tmp_path):
    from crowdtape.sources.labeled import COLUMNS

    def record(post_id, mood, text):
        values = dict.fromkeys(COLUMNS, "")
        values |= {"tweet_id": post_id, "airline_sentiment": mood, "text": text}
        return ",".join(values[c] for c in COLUMNS)

    lines = [
        ",".join(COLUMNS),
        record("1", "negative", "bad"),
        record("2", "neutral", "so"),
        record("3", "positive", "good"),
        record("4", "odd", "what"),
        record("5", "", "no mood"),
        record("6", "negative", ""),
        record("7a", "negative", "bad id"),
        record("8", "positive", '"two\nlines"'),
        record("9", "positive", '"say ""hi"", ok"'),
    ]
    path = tmp_path / "labeled.csv"
    path.write_text("\n".join(lines) + "\n")
    df = sources.read_labeled_posts(spark, str(path))
    assert df.schema.simpleString() == "struct<label:double,text:string,id:string>"
    got = {r.id: (r.label, r.text) for r in df.collect()}
    expected = {
        "1": (0.0, "bad"),
        "2": (1.0, "so"),
        "3": (2.0, "good"),
        "4": (1.0, "what"),
        "5": (1.0, "no mood"),
    }
    assert got == expected | {"8": (2.0, "two\nlines"), "9": (2.0, 'say "hi", ok')}


def test_conform(spark):
    df = spark.createDataFrame([("1", "x", 5)], "polarity string, token string, more int")
    got = schemas.conform(df, schemas.LEXICON)
    assert got.schema == schemas.LEXICON and tuple(got.first()) == ("x", 1)
    with pytest.raises(ValueError, match="polarity"):
        schemas.conform(df.drop("polarity"), schemas.LEXICON)
    bad = spark.createDataFrame([("x", "one")], "token string, polarity string")
    assert schemas.conform(bad, schemas.LEXICON).first().polarity is None
    with pytest.raises(Exception):
        schemas.conform(bad, schemas.LEXICON, strict=True).collect()


@pytest.mark.parametrize("file_format", ["parquet", "csv"])
def test_write_series(spark, tmp_path, file_format):
    df = spark.createDataFrame([("posts", "2016-03-04", 1.0)], "series string, day string, z double")
    path = str(tmp_path / "series")
    sources.write_series(df, path, file_format)
    back = spark.read.format(file_format).option("header", True).load(path)
    assert back.columns == df.columns and back.count() == 1


def test_streams_of_lines_can_be_parsed_and_scored(spark, tmp_path):
    """Parsing and scoring are plain projections, so they run on a stream as well."""
    from crowdtape import operators as ops

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("\n".join([HEADER, GOOD, "junk"]))
    lines = spark.readStream.text(str(tmp_path / "in"))
    scored = ops.score(sources.accepted_posts(sources.parse_posts(lines)), {'"a;b"': 2})
    query = (
        scored.writeStream.format("memory").queryName("scored").trigger(availableNow=True).start()
    )
    query.awaitTermination(60)
    assert [(r.id, r.sentiment) for r in spark.table("scored").collect()] == [("123", 1.0)]
