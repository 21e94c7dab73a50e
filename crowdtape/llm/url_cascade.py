"""URL filters: rules by host and path, and a Bloom filter cascade for a list of keys.

A Bloom filter of the listed keys also lets some others pass. The next level is a
Bloom filter of exactly those false positives, found over all keys that the corpus
has; the level after it holds the listed keys that pass that one by mistake, and so
on until a level makes no mistake. A key's membership is then told by the first
level that rejects it: exact for every key of the corpus, with no join. Keys are
dealt into shards of bounded size, so no task builds or holds more than one shard
at a time, and the filters of all shards are sent to tasks only below a size limit.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.llm.common import stored, table

#: Keys in a shard on average.
SHARD_KEYS = 200_000
#: Share of others that a level lets pass: the first, and all after it.
FIRST_RATE = 0.05
RATE = 0.5
#: A level more than this keeps the few keys that are left as they are.
LEVELS = 24
#: Filters larger than this are not broadcast but read by the tasks of their shard.
BROADCAST_BYTES = 64 << 20

#: Fixed values of the contract: host, path, verdict.
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)

#: Hosts with one of these words as a part of their name are listed by default.
LISTED_WORDS = ("adult", "ads", "bets", "casino", "pills", "spam")
LISTED_HOST = rf"(^|[.-])({'|'.join(LISTED_WORDS)})([.-]|$)"


# --- addresses and rules ------------------------------------------------------


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end; A-Z lower-cased."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(rest, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """``struct(rule, verdict)`` of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        inside = (host == rule_host) | host.endswith("." + rule_host)
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(inside & path.startswith(rule_path), value).otherwise(found)
    return found


# --- the cascade of one shard --------------------------------------------------


def _places(first, second, bits: int, hashes: int):
    """Bit numbers of each key, a column per hash."""
    steps = np.arange(hashes, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return (first[:, None] + steps * (second[:, None] | np.uint64(1))) % np.uint64(bits)


def _passes(level: tuple, first, second):
    bits, hashes, salt, data = level
    if not len(first):
        return np.zeros(0, bool)
    places = _places(first ^ np.uint64(salt), second, bits, hashes)
    return ((data[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8)) & 1).astype(bool).all(1)


def _level(first, second, number: int, rate: float) -> tuple:
    hashes = max(1, round(-np.log2(rate)))
    bits = max(64, int(np.ceil(-len(first) * np.log(rate) / np.log(2) ** 2)))
    salt = (0x9E3779B97F4A7C15 * (number + 1)) & (2**64 - 1)
    data = np.zeros(-(-bits // 8), np.uint8)
    places = _places(first ^ np.uint64(salt), second, bits, hashes).ravel()
    np.bitwise_or.at(data, (places >> np.uint64(3)).astype(np.int64), np.uint8(1) << (places & np.uint64(7)).astype(np.uint8))
    return bits, hashes, salt, data


def build_cascade(first, second, listed) -> tuple[list[tuple], set]:
    """Levels, and the listed keys (as pairs of hashes) that no level can tell apart from the others."""
    inside, outside = np.flatnonzero(listed), np.flatnonzero(~listed)
    levels: list[tuple] = []
    while len(inside):
        if len(levels) >= LEVELS:
            # ``inside`` passed all levels so far, as others in ``outside`` did: keep its listed side.
            rest = inside if listed[inside].all() else outside
            return levels, {(int(first[i]), int(second[i])) for i in rest}
        level = _level(first[inside], second[inside], len(levels), RATE if levels else FIRST_RATE)
        levels.append(level)
        wrong = outside[_passes(level, first[outside], second[outside])]
        inside, outside = wrong, inside
    return levels, set()


def is_listed(cascade: tuple[list[tuple], set], first, second):
    """Membership of keys that were there when the cascade was built."""
    levels, rest = cascade
    answer = np.zeros(len(first), bool)
    open_ = np.arange(len(first))
    for number, level in enumerate(levels):
        passed = _passes(level, first[open_], second[open_])
        # Level 0 holds listed keys: what it rejects is not listed; level 1 the reverse; and so on.
        answer[open_[~passed]] = number % 2 == 1
        open_ = open_[passed]
    if len(levels) >= LEVELS:
        answer[open_] = [(int(a), int(b)) in rest for a, b in zip(first[open_], second[open_], strict=True)]
    else:
        answer[open_] = len(levels) % 2 == 1
    return answer


# --- on Spark -----------------------------------------------------------------


def _hashed(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(key, F.lit("second")).alias("h2")]


def _shard(shards: int) -> Column:
    return F.pmod(F.col("h2"), F.lit(shards)).alias("shard")


def cascade_table(keys: DataFrame, shards: int) -> DataFrame:
    """``shard, cascade`` from ``keys(key, listed)``, all keys of the corpus, each once."""

    def build(part):
        import pickle

        first, second = (part[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        cascade = build_cascade(first, second, part["listed"].to_numpy(bool))
        return part.head(1)[["shard"]].assign(cascade=pickle.dumps(cascade))

    hashed = keys.select(*_hashed(F.col("key")), "listed").select("*", _shard(shards))
    return hashed.groupBy("shard").applyInPandas(build, "shard bigint, cascade binary")


def judge_keys(rows: DataFrame, key: Column, listed: DataFrame) -> DataFrame:
    """``rows`` as ``row``, with ``listed``: whether their ``key`` is among those of ``listed(key)``.

    Null keys count as not listed. A list may name keys that no row has, repeat keys
    and hold nulls; an empty one lists nothing. Repeated rows are judged alike.
    """
    import pickle

    spark = rows.sparkSession
    keyed = rows.select(F.struct(*rows.columns).alias("row"), key.alias("key"))
    universe = keyed.where("key IS NOT NULL").select("key").distinct()
    marked = universe.withColumn("listed", F.lit(False)).unionByName(
        listed.where("key IS NOT NULL").select("key").distinct().withColumn("listed", F.lit(True))
    )
    keys = marked.groupBy("key").agg(F.max("listed").alias("listed"))
    keys = stored(keys, "url-keys")
    shards = max(1, -(-keys.count() // SHARD_KEYS))
    filters = stored(cascade_table(keys, shards), "cascades")
    size = filters.agg(F.sum(F.octet_length("cascade"))).first()[0] or 0
    probe = keyed.select("row", "key", *_hashed(F.col("key"))).select("*", _shard(shards))

    if size <= BROADCAST_BYTES:
        shared = spark.sparkContext.broadcast({r["shard"]: bytes(r["cascade"]) for r in filters.collect()})

        def tell(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
            cascades = {shard: pickle.loads(data) for shard, data in shared.value.items()}
            for first, second, shard in batches:
                answer = np.zeros(len(first), bool)
                for s in shard.unique():
                    own = (shard == s).to_numpy()
                    pair = (c[own].to_numpy(np.int64).view(np.uint64) for c in (first, second))
                    answer[own] = is_listed(cascades[s], *pair) if s in cascades else False
                yield pd.Series(answer)

        found = F.pandas_udf(tell, "boolean")("h1", "h2", "shard")
        return probe.select("row", "key", (found & F.col("key").isNotNull()).alias("listed"))

    # Larger: ask each shard's filter about that shard's keys, once each, then tell the rows.
    def ask(key_part, filter_part):
        first, second = (key_part[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        cascade = pickle.loads(filter_part["cascade"].iloc[0])
        return key_part[["key"]].assign(listed=is_listed(cascade, first, second))

    asked = universe.select("key", *_hashed(F.col("key"))).select("*", _shard(shards)).groupBy("shard")
    answers = asked.cogroup(filters.groupBy("shard")).applyInPandas(ask, "key string, listed boolean")
    joined = keyed.join(answers, "key", "left")
    return joined.select("row", "key", F.coalesce("listed", F.lit(False)).alias("listed"))


def judge_urls(pages: DataFrame, listed: DataFrame | None = None, rules=RULES) -> DataFrame:
    """``row, host, path, rule, verdict, listed`` for every row of ``pages`` with a ``url``.

    The longest rule decides. Where none fits, hosts in ``listed(key)`` are blocked
    and all others allowed; without a list, it is the pages' hosts with one of
    ``LISTED_WORDS`` in their name. Null urls and those without ``://`` have an empty
    host and path, which is not listed by default. Repeated rows are judged alike;
    columns of any name stay inside ``row``.
    """
    row = F.struct(*pages.columns).alias("row")
    parts = pages.select(
        row, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    ruled = parts.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules))
    if listed is None:
        listed = ruled.where(F.col("host").rlike(LISTED_HOST)).select(F.col("host").alias("key"))
    told = judge_keys(ruled, F.col("host"), listed)
    by_list = F.when(F.col("listed"), "block").otherwise("allow")
    return told.select(
        "row.row",
        "row.host",
        "row.path",
        F.col("row.fit.rule").alias("rule"),
        F.coalesce("row.fit.verdict", by_list).alias("verdict"),
        "listed",
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = judge_urls(pages)
    return judged.select("row.page_id", "host", "path", "rule", "verdict", "listed")
