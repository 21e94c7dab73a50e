"""The post store that follows its files, and the operators it is made of."""

from __future__ import annotations

import datetime as dt
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowdtape import operators as ops
from crowdtape import plans, schemas, sources
from crowdtape.operators.dedupe import dedupe_against
from crowdtape.sources.raw_posts import HEADER


def line(number, day, hour=9, user="u", text="t"):
    quoted = f'"{number}"' if number is not None else '""'
    return f"{user};{day:%Y/%m/%d} {hour}:05;{hour};2;{text};;;;{quoted};http://x"


def write(path, lines):
    path.write_text("\n".join([HEADER, *lines]))


def whole(spark, raw):
    """What a full parse and dedupe of all files gives."""
    parsed = sources.parse_posts(sources.read_raw_posts(spark, f"{raw}/*"))
    posts = sources.accepted_posts(parsed)
    loose = posts.filter("id = ''")
    return ops.dedupe(posts.filter("id <> ''")).unionByName(loose), sources.rejected_lines(parsed)


def rows(df):
    return sorted(map(str, df.collect()))


def parsed_files(spark, path):
    """Rows that each batch has parsed."""
    root = plans.ingest._root(spark, path)
    return sorted(r["count"] for r in spark.read.parquet(f"{root}/parsed").groupBy("batch").count().collect())


@pytest.fixture
def raw(tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    return folder


DAYS = [dt.date(2023, 12, 30) + dt.timedelta(days=17 * n) for n in range(8)]


def test_store_follows_its_files(spark, raw, tmp_path):
    path = str(tmp_path / "posts")
    rng = random.Random(3)

    def some(count):
        pick = lambda: line(rng.choice([*range(40), None]), rng.choice(DAYS), rng.randint(1, 12), f"u{rng.randint(0, 3)}")
        return [pick() for _ in range(count)] + ["junk"]

    def check(outcome):
        assert plans.sync_posts(spark, f"{raw}/*", path) == outcome
        posts, rejected = whole(spark, raw)
        stored = plans.read_posts(spark, path)
        assert stored.schema == schemas.POST
        assert rows(stored) == rows(posts)
        assert rows(plans.read_rejected(spark, path)) == rows(rejected)
        daily = ops.daily_activity(posts, plans.ingest.ACTIVITY)
        assert rows(plans.read_daily_activity(spark, path)) == rows(daily)

    write(raw / "a.csv", some(30))
    check("built")
    check("same")
    first = parsed_files(spark, path)
    for n in range(3):
        write(raw / f"b{n}.csv", some(12))
        if n == 2:  # much older than the others
            os.utime(raw / "b2.csv", (1_000_000_000, 1_000_000_000))
        check("grown")
    assert parsed_files(spark, path) == sorted([*first, 13, 13, 13])  # each file was parsed once
    write(raw / "b1.csv", some(20))
    check("built")
    (raw / "a.csv").unlink()
    check("built")
    assert {n for n in os.listdir(path) if n.startswith("generation-")} == {plans.ingest._root(spark, path).split("/")[-1]}
    # Other options read the same lines in another way.
    plans.sync_posts(spark, f"{raw}/*", path, lenient_time=True)
    assert plans.sync_posts(spark, f"{raw}/*", path, lenient_time=True) == "same"
    check("built")


def test_a_delta_rewrites_the_months_it_touches(spark, raw, tmp_path):
    path = str(tmp_path / "posts")
    write(raw / "a.csv", [line(n, DAYS[n % 8]) for n in range(40)])
    plans.sync_posts(spark, f"{raw}/*", path)
    root = plans.ingest._root(spark, path)

    def files():
        return {
            name: sorted(f for f in os.listdir(f"{root}/posts/{name}") if f.endswith(".parquet"))
            for name in os.listdir(f"{root}/posts")
            if name.startswith("month=")
        }

    before = files()
    # A new post in one month, and an earlier copy of a post stored in another.
    write(raw / "b.csv", [line(100, dt.date(2024, 2, 20)), line(7, dt.date(2023, 12, 1), 1)])
    assert plans.sync_posts(spark, f"{raw}/*", path) == "grown"
    after = files()
    changed = {name for name in after if after[name] != before.get(name)}
    month_of_seven = f"month={DAYS[7]:%Y-%m}"
    assert changed == {"month=2024-02", "month=2023-12", month_of_seven} and len(after) > len(changed)
    assert rows(plans.read_posts(spark, path)) == rows(whole(spark, raw)[0])


def test_months_that_only_get_posts_keep_their_files(spark, raw, tmp_path):
    path = str(tmp_path / "posts")
    write(raw / "a.csv", [line(n, DAYS[n % 8]) for n in range(40)])
    plans.sync_posts(spark, f"{raw}/*", path)
    month = f"{plans.ingest._root(spark, path)}/posts/month={DAYS[0]:%Y-%m}"
    before = {f for f in os.listdir(month) if f.endswith(".parquet")}
    write(raw / "b.csv", [line(100, DAYS[0])])
    assert plans.sync_posts(spark, f"{raw}/*", path) == "grown"
    assert before < set(os.listdir(month))
    assert rows(plans.read_posts(spark, path)) == rows(whole(spark, raw)[0])


def test_days_prune_months(spark, raw, tmp_path):
    path = str(tmp_path / "posts")
    write(raw / "a.csv", [line(n, DAYS[n % 8]) for n in range(40)])
    posts, _ = plans.load_posts(spark, f"{raw}/*", path, start="2024-01-10", end="2024-02-28")
    assert {r.date for r in posts.collect()} == {d for d in DAYS if dt.date(2024, 1, 10) <= d <= dt.date(2024, 2, 28)}
    plan = posts._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("PartitionFilters") :]
    assert "month" in scan[: scan.index("PushedFilters")] and "2024-01" in scan and "date" in scan[scan.index("PushedFilters") :]


def test_a_broken_merge_and_a_lost_batch(spark, raw, tmp_path, monkeypatch):
    path = str(tmp_path / "posts")
    write(raw / "a.csv", [line(n, DAYS[n % 8]) for n in range(20)] + [line(None, DAYS[0])])
    plans.sync_posts(spark, f"{raw}/*", path)
    write(raw / "b.csv", [line(n, DAYS[n % 8], 3) for n in range(15, 25)] + [line(None, DAYS[1])])

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(plans.ingest, "_write_filter", fail)
        with pytest.raises(Exception, match="lost"):
            plans.sync_posts(spark, f"{raw}/*", path)
    assert plans.sync_posts(spark, f"{raw}/*", path) == "built"
    assert rows(plans.read_posts(spark, path)) == rows(whole(spark, raw)[0])
    write(raw / "c.csv", [line(30, DAYS[3]), line(None, DAYS[2])])
    with monkeypatch.context() as patch:  # merged, but the stream does not get to know
        real = plans.ingest._take_batch

        def take(*args):
            real(*args)
            fail()

        patch.setattr(plans.ingest, "_take_batch", take)
        with pytest.raises(Exception, match="lost"):
            plans.sync_posts(spark, f"{raw}/*", path)
    assert plans.sync_posts(spark, f"{raw}/*", path) == "grown"
    assert rows(plans.read_posts(spark, path)) == rows(whole(spark, raw)[0])


def test_several_paths_one_empty_and_none_left(spark, raw, tmp_path):
    path = str(tmp_path / "posts")
    write(raw / "a.csv", [line(1, DAYS[0])])
    write(raw / "b.csv", [line(2, DAYS[1])])
    paths = [str(raw / "a.csv"), str(raw / "b.csv"), f"{tmp_path}/nothing/*"]
    assert plans.sync_posts(spark, paths, path) == "built" and plans.read_posts(spark, path).count() == 2
    assert plans.sync_posts(spark, paths, path) == "same"
    for name in ("a.csv", "b.csv"):
        (raw / name).unlink()
    assert plans.sync_posts(spark, paths, path) == "same" and plans.read_posts(spark, path).count() == 2
    nothing = str(tmp_path / "none")
    assert plans.sync_posts(spark, f"{tmp_path}/nothing/*", nothing) == "built"
    assert plans.read_posts(spark, nothing).count() == plans.read_daily_activity(spark, nothing).count() == 0


def test_snapshot_knows_its_inputs(spark, tmp_path):
    data, path, calls = tmp_path / "in", str(tmp_path / "snap"), []
    data.mkdir()
    (data / "a.txt").write_text("1")

    def build():
        calls.append(1)
        return spark.range(len(calls))

    def load(**options):
        return sources.load_or_build(spark, path, build, inputs=f"{data}/*", options=options).count()

    assert [load(x=1), load(x=1)] == [1, 1]
    assert load(x=2) == 2
    (data / "b.txt").write_text("2")
    assert [load(x=2), load(x=2)] == [3, 3]
    (data / "b.txt").write_text("22")
    assert load(x=2) == 4
    (data / "a.txt").unlink()
    assert load(x=2) == 5
    (data / "b.txt").unlink()
    assert load(x=2) == 5 and len(os.listdir(f"{path}.manifests")) == 1
    assert sources.load_or_build(spark, path, build, options={"x": 3}).count() == 6


# --- dedupe against stored rows ----------------------------------------------

ROW = "id string, timestamp int, x int"
posts = st.lists(st.tuples(st.sampled_from("abcdefghij"), st.integers(0, 3), st.integers(0, 2)), max_size=15)


@settings(max_examples=8, deadline=None)
@given(posts, posts)
def test_dedupe_against_is_dedupe_of_both(spark, tmp_path_factory, old, new):
    folder = tmp_path_factory.mktemp("scratch")

    def keep(df, name):
        df.write.mode("overwrite").parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    stored = ops.dedupe(spark.createDataFrame(old, ROW))
    delta = ops.dedupe(spark.createDataFrame(new, ROW))
    filters = ops.key_filter(stored, "id", 2)
    fresh, superseded = ops.dedupe_against(delta, stored, filters, 2, keep)
    left = set(map(tuple, stored.collect())) - set(map(tuple, superseded.collect()))
    got = sorted([*left, *map(tuple, fresh.collect())])
    assert got == sorted(map(tuple, ops.dedupe(spark.createDataFrame([*old, *new], ROW)).collect()))


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    blocks = ops.filter_blocks(20_000)
    ids = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("id"))
    one, two = ids.filter("hash(id) % 2 = 0"), ids.filter("hash(id) % 2 <> 0")
    filters = ops.merge_filters(ops.key_filter(one, "id", blocks), ops.key_filter(two, "id", blocks))
    whole_filter = ops.key_filter(ids, "id", blocks)
    assert rows(filters) == rows(whole_filter)
    asked = spark.range(40_000).select(F.concat(F.lit("k"), "id").alias("id"), (F.col("id") < 20_000).alias("known"))
    found = ops.may_be_stored(asked, filters, "id", blocks).groupBy("known").agg(
        F.avg(F.col("may_be_stored").cast("int")).alias("share")
    )
    shares = {r.known: r.share for r in found.collect()}
    assert shares[True] == 1.0 and shares[False] < 0.01


def shuffled_rows(spark, work):
    """Rows that ``work()`` writes to shuffles, by the counts of its stages."""
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = lambda: store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    known = {(s.stageId(), s.attemptId()) for s in (stages().apply(i) for i in range(stages().size()))}
    work()
    found = stages()
    new = [found.apply(i) for i in range(found.size())]
    return sum(s.shuffleWriteRecords() for s in new if (s.stageId(), s.attemptId()) not in known)


def test_a_small_delta_shuffles_little(spark, tmp_path):
    def keep(df, name):
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")

    make = lambda low, high: spark.range(low, high).selectExpr("string(id) id", "int(id % 7) timestamp", "int(id) x")
    stored = keep(make(0, 100_000), "stored")
    blocks = ops.filter_blocks(400_000)
    filters = keep(ops.key_filter(stored, "id", blocks), "filters")
    delta = keep(make(99_500, 100_500), "delta")
    out = []

    def work():
        fresh, superseded = ops.dedupe_against(delta, stored, filters, blocks, keep)
        out.extend([keep(fresh, "fresh").count(), superseded.count()])

    moved = shuffled_rows(spark, work)
    assert out == [500, 0] and moved <= 4_000  # 1 % of the stored rows, seen a few times


def test_many_repeats_need_no_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(dedupe_against.__globals__, "BROADCAST_ROWS", 0)

    def keep(df, name):
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{tmp_path}/{name}")

    stored = keep(spark.createDataFrame([("a", 2, 1), ("b", 1, 1)], ROW), "stored")
    delta = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("c", 1, 1)], ROW)
    fresh, superseded = ops.dedupe_against(delta, stored, ops.key_filter(stored, "id", 1), 1, keep)
    assert sorted(map(tuple, fresh.collect())) == [("a", 1, 1), ("c", 1, 1)]
    assert list(map(tuple, superseded.collect())) == [("a", 2, 1)]


# --- daily states --------------------------------------------------------------


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-5, 5) | st.none(), st.integers(0, 2)), min_size=1, max_size=20))
def test_states_add_up(spark, values):
    df = spark.createDataFrame([(d, v, p) for d, v, p in values], "date int, v int, part int")
    measures = {"m": "v"}
    parts = [ops.daily_states(df.filter(f"part = {p}"), measures) for p in range(3)]
    merged = ops.merge_states(parts[0].unionByName(parts[1]).unionByName(parts[2]))
    assert rows(merged) == rows(ops.daily_states(df, measures))
    assert rows(ops.activity_of(merged, ["m"])) == rows(ops.daily_activity(df, measures))
    exact = df.groupBy("date").agg(F.avg("v").alias("mean"), F.stddev_samp("v").alias("sd"))
    close = exact.join(ops.moments_of(merged, ["m"]), "date").filter(
        "NOT (m_mean <=> mean) AND abs(m_mean - mean) > 1e-9 OR NOT (m_sd <=> sd) AND NOT abs(m_sd - sd) < 1e-9"
    )
    assert close.count() == 0
    gone = ops.merge_states(merged.unionByName(ops.negated(parts[0])))
    assert rows(gone) == rows(ops.daily_states(df.filter("part <> 0"), measures))
