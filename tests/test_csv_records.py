"""Records of CSV files against the reader that takes a file whole."""

from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowdtape import sources

SCHEMA = "a string, b string, c string"


@pytest.fixture
def tiny_splits(spark):
    before = {n: spark.conf.get(n, None) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for name in before:
        spark.conf.set(name, "7")
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def parsed(spark, path):
    records = sources.read_records(spark, path).filter("number > 0")
    return records.select(F.from_csv("record", F.lit(SCHEMA), {"escape": '"'}).alias("f")).select("f.*")


def whole(spark, path):
    return spark.read.csv(path, schema=SCHEMA, header=True, multiLine=True, escape='"')


def rows(df):
    return sorted(map(str, df.collect()))


quoted = st.lists(st.sampled_from(['""', ",", "\n", "x", "é", " ", "\n\n"]), max_size=6).map(lambda t: '"' + "".join(t) + '"')
plain = st.sampled_from(["", "x", 'y"z', 'w""', 'q"', "a b", '\'', "漢字"])
fields = st.one_of(quoted, plain, quoted.map(lambda t: t + " tail"), quoted.map(lambda t: t + 't"ail'))
records = st.lists(st.lists(fields, min_size=1, max_size=3).map(",".join) | st.just(""), max_size=12)


@settings(max_examples=25, deadline=None)
@given(records)
def test_records_are_those_of_the_whole_file(spark, tmp_path_factory, tiny_splits_once, lines):
    path = tmp_path_factory.mktemp("csv") / "x.csv"
    path.write_text("\n".join(["a,b,c", *lines, ""]))
    assert rows(parsed(spark, str(path))) == rows(whole(spark, str(path)))


@pytest.fixture(scope="module")
def tiny_splits_once(spark):
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.set(name, "7")
    yield
    for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"):
        spark.conf.unset(name)


def test_one_record_over_many_splits_and_files(spark, tmp_path, tiny_splits):
    long = "\n".join(f'line {n} ""quoted"", and more' for n in range(60))
    for name, first in (("a", "1"), ("b", "2")):
        (tmp_path / f"{name}.csv").write_text(f'a,b,c\n{first},"{long}",z\n\n4,,\n"{long}","{long}",6')
    found = sources.read_records(spark, str(tmp_path))
    assert found.groupBy("file").agg(F.max("number").alias("n")).filter("n = 3").count() == 2
    assert rows(parsed(spark, str(tmp_path))) == rows(whole(spark, str(tmp_path)))
    assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 20


def test_windows_line_ends_and_empty_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'a,b,c\r\n1,"x\r\ny",2\r\n3,4,5\r\n')
    (tmp_path / "b.csv").write_bytes(b"")
    (tmp_path / "c.csv").write_bytes(b"a,b,c")
    assert rows(parsed(spark, str(tmp_path))) == rows(whole(spark, str(tmp_path)))


def test_no_python_and_one_text_shuffle(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b,c\n1,2,3")
    df = sources.read_records(spark, str(tmp_path))
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ReusedExchange" in plan
