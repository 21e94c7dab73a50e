"""Periodic runs against the definition."""

from __future__ import annotations

import hashlib
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crowdtape.llm import runs

DOC = "doc_id bigint, text string, runs string, collapsed string, row map<string,int>"


def brute_runs(words):
    """Every stretch with its smallest period, found period by period."""
    found = {}
    for period in range(1, len(words) // 4 + 1):
        at = 0
        while at + period < len(words):
            start = at
            while at + period < len(words) and words[at] == words[at + period]:
                at += 1
            length = at - start + period
            if at > start and length >= max(6, 4 * period):
                found.setdefault((start, length), period)
            at += at == start
    return sorted((start, length, period) for (start, length), period in found.items())


def brute_collapsed(words, found):
    gone = {at for start, length, period in found for at in range(start + period, start + length)}
    return " ".join(word for at, word in enumerate(words) if at not in gone)


repeats = st.tuples(st.lists(st.sampled_from("abc"), min_size=1, max_size=6), st.integers(1, 7), st.integers(0, 3))
texts = st.lists(repeats, max_size=6).map(
    lambda parts: [w for unit, times, cut in parts for w in (unit * times)[: len(unit) * times - cut]]
)


@settings(max_examples=400, deadline=None)
@given(texts)
def test_runs_are_those_of_the_definition(words):
    words = [word.encode() for word in words]
    found = runs.find_runs(words)
    assert found == brute_runs(words)
    kept = b" ".join(runs.kept_words(words, found)).decode()
    assert kept == brute_collapsed([w.decode() for w in words], found)


def test_one_word_a_hundred_thousand_times_and_many_left_words():
    assert runs.find_runs([b"a"] * 100_000) == [(0, 100_000, 1)]
    spread = [w for n in range(20_000) for w in (b"x%d" % n, b"a", b"b", b"c", b"d", b"e")]
    assert runs.find_runs(spread) == []


def test_query_is_that_of_brute_force(spark, sf_dir):
    got = {r.doc_id: tuple(r)[1:] for r in runs.op11_periodic_runs(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    seen = 0
    for doc in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", doc.text or "")
        h, n = zlib.crc32(str(doc.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute_runs(words)
        seen += len(found)
        top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
        listed = "".join(f"{s},{length},{p}\n" for s, length, p in found)
        digests = [hashlib.sha256(t.encode()).hexdigest() for t in (listed, brute_collapsed(words, found))]
        milli = 1000 * top[1] // top[2] if found else None
        assert got[doc.doc_id] == (len(found), *top, milli, *digests)
    assert seen and len(got) == len(docs)


def test_awkward_rows(spark):
    rows = [
        (1, "a b " * 5, "x", "y", {"a": 1}),
        (1, "a b " * 5, "x", "y", {"a": 1}),
        (None, None, None, None, None),
        (2, "", None, None, None),
        (3, " \t\r\n\x0b\x0c", None, None, None),
        (4, "w\x1c 漢 " * 40_000, None, None, None),
        (None, "ü " * 6, None, None, None),
    ]
    docs = spark.createDataFrame(rows, DOC).repartition(3)
    got = runs.collapse_runs(docs, ["doc_id", "row"]).select("row.doc_id", "runs", "collapsed").collect()
    found = sorted((str(r.doc_id), [tuple(x) for x in r.runs], r.collapsed) for r in got)
    assert found == sorted(
        [
            ("1", [(0, 10, 2)], "a b"),
            ("1", [(0, 10, 2)], "a b"),
            ("None", [], ""),
            ("2", [], ""),
            ("3", [], ""),
            ("4", [(0, 40_000, 1)], "w\x1c 漢"),
            ("None", [(0, 6, 1)], "ü"),
        ]
    )
    assert runs.collapse_runs(docs.limit(0), ["doc_id"]).count() == 0
    planted = docs.select(runs.with_planted_period(F.col("doc_id"), F.col("text")).alias("text"))
    assert planted.count() == len(rows)
