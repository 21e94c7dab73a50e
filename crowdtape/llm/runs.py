"""Periodic runs of words, by maximal pairs of a text's LCP-interval tree.

Two places of a text form a maximal pair if the words from them on agree for some
length, but neither the words before nor those behind the agreement do. A pair that
agrees for ``length`` words at a distance of ``period`` is a stretch of ``length +
period`` words with that period which no neighbour extends; so where the length is
at least ``EXPONENT - 1`` times the distance the pair *is* a run.

The tree of intervals is walked from the leaves up. A node holds the places of its
suffixes, as one class list for each left word; joining two children looks for
partners in the classes of other left words alone. Places of one node that lie
closer than half its length form a chain at the distance of the smallest period. So
the partner of the smallest period is the next place of the node to either side,
and farther ones would only repeat the run at a multiple.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.llm.common import SPACE, WORD, table

#: A run repeats its period so often at least, and has so many words at least.
EXPONENT = 4
LEAST_WORDS = 6
#: A pair whose distance is 1 agrees for so many words, any other one for more: nodes above need no tree.
LEAST_PAIR = LEAST_WORDS - 1
#: Rows of one batch that go back to Spark.
BATCH = 256

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def word_numbers(words: list[bytes]):
    """A number for each word, equal where the words are."""
    import numpy as np

    numbers: dict[bytes, int] = {}
    return np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, len(words))


def repeats_anywhere(ids) -> bool:
    """Whether ``LEAST_PAIR`` words in a row may occur twice: no if their hashes are all different."""
    import numpy as np

    count = len(ids) - LEAST_PAIR + 1
    if count < 2:
        return False
    mixed = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    hashes = np.zeros(count, np.uint64)
    for at in range(LEAST_PAIR):
        hashes = hashes * np.uint64(0xBF58476D1CE4E5B9) + mixed[at : at + count]
    hashes.sort()
    return bool((hashes[1:] == hashes[:-1]).any())


def suffix_order(ids):
    """Places in the order of their suffixes, by doubling; only suffixes still tied are sorted again."""
    import numpy as np

    n = len(ids)
    order = np.argsort(ids, kind="stable")
    rank = np.empty(n, np.int64)
    tied, keys, known = np.arange(n), ids[order], 0
    while True:
        # Slots of one key share the rank of the first of them.
        first = np.concatenate(([True], keys[1:] != keys[:-1]))
        sizes = np.diff(np.append(np.flatnonzero(first), len(keys)))
        rank[order[tied]] = np.repeat(tied[first], sizes)
        tied = tied[np.repeat(sizes, sizes) > 1]
        if not len(tied):
            return order
        known = max(1, 2 * known)
        places = order[tied]
        behind = places + known
        keys = rank[places] * (n + 2)
        inside = behind < n
        keys[inside] += rank[behind[inside]] + 1
        resort = np.argsort(keys, kind="stable")
        order[tied], keys = places[resort], keys[resort]


def common_lengths(ids: list[int], order: list[int]) -> list[int]:
    """Words that each suffix shares with the one before it in ``order`` (0 for the first)."""
    n = len(ids)
    before, slot = [-1] * n, [0] * n
    for at in range(1, n):
        before[order[at]] = order[at - 1]
    for at, place in enumerate(order):
        slot[place] = at
    shared, length = [0] * n, 0
    for place in range(n):
        other = before[place]
        if other < 0:
            length = 0
            continue
        most = n - max(place, other)
        while length < most and ids[place + length] == ids[other + length]:
            length += 1
        shared[slot[place]] = length
        if length:
            length -= 1
    return shared


def find_runs(words: list[bytes]) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start and period."""
    ids = word_numbers(words)
    if not repeats_anywhere(ids):
        return []
    order = suffix_order(ids).tolist()
    ids = ids.tolist()
    lengths = common_lengths(ids, order)
    left = [-1, *ids[:-1]]
    found: dict[tuple[int, int], int] = {}

    def meet(one: int, other: int, length: int) -> None:
        """Record the pair if its distance satisfies the constraints on the length."""
        start, period = (one, other - one) if one < other else (other, one - other)
        if length >= (EXPONENT - 1) * period and length + period >= LEAST_WORDS:
            stretch = (start, length + period)
            found[stretch] = min(period, found.get(stretch, period))

    def join(one: tuple, other: tuple, length: int) -> tuple:
        """Places and class lists of both children, after the pairs between them have been met."""
        (small, small_classes), (large, large_classes) = (one, other) if len(one[0]) < len(other[0]) else (other, one)
        for word, members in small_classes.items():
            if len(large_classes) == (word in large_classes):
                continue  # no class with another left word
            for place in members:
                at = bisect_left(large, place)
                if at and left[large[at - 1]] != word:
                    meet(large[at - 1], place, length)
                if at < len(large) and left[large[at]] != word:
                    meet(place, large[at], length)
        for word, members in small_classes.items():
            large_classes.setdefault(word, []).extend(members)
        if 8 * len(small) < len(large):
            for place in small:
                insort(large, place)
        else:
            large += small
            large.sort()
        return large, large_classes

    waiting: list[tuple[int, tuple]] = []  # nodes to the left, each with its length in common with what follows
    node = None
    for place, length in zip(order, lengths, strict=True):
        while waiting and waiting[-1][0] >= length:
            depth, sibling = waiting.pop()
            node = join(sibling, node, depth)
        if length >= LEAST_PAIR:
            waiting.append((length, node))
        node = ([place], {left[place]: [place]})
    while waiting:
        depth, sibling = waiting.pop()
        node = join(sibling, node, depth)
    return sorted((start, length, period) for (start, length), period in found.items())


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words but those that a run contains behind its first period."""
    if not runs:
        return words
    dropped = bytearray(len(words))
    end = 0
    for start, length, period in sorted(runs, key=lambda run: run[0] + run[2]):
        first = max(start + period, end)
        if start + length > first:
            dropped[first : start + length] = b"\x01" * (start + length - first)
            end = start + length
    return [word for word, gone in zip(words, dropped, strict=True) if not gone]


def collapse_runs(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row`` (columns ``keep`` of ``docs``), ``runs`` and ``collapsed`` for every row.

    ``runs`` are structs of ``start`` (word number from 0), ``length`` and smallest
    ``period``, in order of start and period; ``collapsed`` is the text without what
    runs repeat, its words joined by one space. Words end at the six ASCII white space
    characters. A null or empty text has no words, no runs and an empty ``collapsed``.
    Repeated rows get equal results; other columns, also those named like an output,
    are not looked at. Every text is taken whole, and by itself: there is no shuffle.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
            schema = pa.schema([batch.schema.field(1), pa.field("runs", kind), pa.field("collapsed", pa.string())])
            for at in range(0, batch.num_rows, BATCH):
                part = batch.slice(at, BATCH)
                runs, texts = [], []
                for text in part.column(0):
                    words = (text.as_py() or "").encode().split()  # at the six characters only
                    found = find_runs(words)
                    runs.append([{"start": s, "length": n, "period": p} for s, n, p in found])
                    texts.append(b" ".join(kept_words(words, found)).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), pa.array(runs, kind), pa.array(texts, pa.string())], schema=schema
                )

    narrow = docs.select(F.col("text").cast("string"), F.struct(*keep).alias("row"))
    kind = narrow.schema["row"].dataType.simpleString()
    return narrow.mapInArrow(run, f"row {kind}, runs {RUN}, collapsed string")


def with_planted_period(doc_id: Column, text: Column) -> Column:
    """The text of the contract: where crc32 of the id ends in 0, its words repeat from a place on."""
    h = F.crc32(doc_id.cast("string"))
    g = F.floor(h / 10)

    def changed(words: Column) -> Column:
        n = F.size(words)
        start = F.pmod(g, n).cast("int")
        period = (1 + F.floor((n - start) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        repeated = F.array_repeat(F.slice(words, start + 1, period), F.ceil((n - start) / period).cast("int"))
        behind = F.slice(F.flatten(repeated), F.lit(1), n - start)
        return F.concat_ws(" ", F.slice(words, F.lit(1), start), behind)

    # As the only entry of an array the words are made once, however often the expression names them.
    words = F.array(F.filter(F.split(text, f"{SPACE}+"), lambda word: word != ""))
    planted = (F.pmod(h, F.lit(10)) == 0) & text.rlike(WORD)
    return F.when(planted, F.transform(words, changed)[0]).otherwise(text)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", with_planted_period(F.col("doc_id"), F.col("text")).alias("text"))
    found = collapse_runs(docs, ["doc_id"])
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r.length.alias("n"), -r.start, -r.period)))
    listed = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    top = found.select(
        "row.doc_id", "collapsed", "runs", longest.alias("top"), F.concat_ws("\n", listed).alias("listed")
    )
    start, length, period = -F.col("top.col2"), F.col("top.n"), -F.col("top.col3")
    lines = F.when(F.size("runs") > 0, F.concat("listed", F.lit("\n"))).otherwise("")
    return top.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
