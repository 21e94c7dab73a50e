"""Benchmark decontamination: every training passage queries an index of test items.

The index is inverted (term, items with impacts) with BM25 impacts, each divided by
what its item would score against itself, so that one threshold fits items of any
length. Passages are overlapping windows of words. Per chunk of texts, two
vectorised bounds (a sum of term maxima, then one of block maxima) tell which
windows have a pivot at all; block-max WAND then finds the items of those windows
that reach the threshold, and shared five-word shingles of the item's question and
of its answer decide.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.llm.common import table

#: Share of an item's own score that a passage has to reach.
THRESHOLD = 0.6
#: Shingle size, and share of the question's and of the answer's shingles.
SHINGLE = 5
OVERLAP = 0.8
#: BM25 parameters.
K1, B = 1.2, 0.75
#: Items whose maxima are kept together, and bytes of item text in an index that is sent to all tasks.
BLOCK = 4
SHARD_BYTES = 8 << 20
#: Words that are searched at a time.
CHUNK_WORDS = 400_000

MATCHES = (
    "array<struct<item_id: bigint, start: bigint, score: double, "
    "question_overlap: double, answer_overlap: double>>"
)
WORDS = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words before the last sentence, and those of it; all words twice if there is one sentence."""
    sentences = [w for w in map(words_of, re.split(r"[.!?\n]+", text)) if w]
    if len(sentences) < 2:
        return words_of(text), words_of(text)
    return [w for s in sentences[:-1] for w in s], sentences[-1]


@dataclass
class Index:
    """Inverted index of a shard of items. Arrays hold one term's postings after the other."""

    terms: dict  # word to term
    item_ids: list
    parts: list  # of each item: term numbers of its question and of its answer
    starts: np.ndarray  # first posting of each term, and the end
    items: np.ndarray  # of each posting, ascending within a term
    impacts: np.ndarray
    ceilings: np.ndarray  # of each term: its greatest impact
    essential: np.ndarray  # terms without which no item reaches the threshold
    slack: np.ndarray  # of each block: what an item can score from other terms
    block_starts: np.ndarray  # as ``starts``, of each term's blocks
    blocks: np.ndarray
    block_ceilings: np.ndarray
    span: int  # words of the longest item
    lists: dict  # the arrays again, as lists for the walk over single postings


def build_index(items: list[tuple], frequency: dict, count: int, mean_length: float, threshold: float) -> Index | None:
    """Index of ``(item_id, text)``; ``frequency`` holds of how many of all ``count`` items a word is part."""
    items = [(i, text) for i, text in items if text and words_of(text)]
    if not items:
        return None
    terms: dict = {}
    postings: list[dict] = []
    for number, (_, text) in enumerate(items):
        words = words_of(text)
        tf: dict = {}
        for word in words:
            tf[word] = tf.get(word, 0) + 1
        norm = K1 * (1 - B + B * len(words) / mean_length)
        raw = {}
        for word, n in tf.items():
            idf = np.log1p((count - frequency[word] + 0.5) / (frequency[word] + 0.5))
            raw[word] = idf * n * (K1 + 1) / (n + norm)
        whole = sum(raw.values())
        for word, impact in raw.items():
            term = terms.setdefault(word, len(terms))
            if term == len(postings):
                postings.append({})
            postings[term][number] = impact / whole
    sizes = [len(p) for p in postings]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    numbers = np.array([n for p in postings for n in p], np.int64)
    impacts = np.array([x for p in postings for x in p.values()])
    ceilings = np.maximum.reduceat(impacts, starts[:-1])
    # The commonest terms are left out while no item can get half the threshold from them.
    n_blocks = -(-len(items) // BLOCK)
    rest = np.zeros(len(items))
    essential = np.ones(len(terms), bool)
    for term in sorted(range(len(terms)), key=lambda t: -sizes[t]):
        own = slice(starts[term], starts[term + 1])
        rest[numbers[own]] += impacts[own]
        if rest.max() > threshold / 2:
            rest[numbers[own]] -= impacts[own]
            break
        essential[term] = False
    slack = np.zeros(n_blocks)
    np.maximum.at(slack, np.arange(len(items)) // BLOCK, rest)
    block_starts, blocks, block_ceilings = [0], [], []
    for term in range(len(terms)):
        own = slice(starts[term], starts[term + 1])
        of, first = np.unique(numbers[own] // BLOCK, return_index=True)
        blocks.append(of)
        block_ceilings.append(np.maximum.reduceat(impacts[own], first))
        block_starts.append(block_starts[-1] + len(of))
    arrays = {
        "starts": starts,
        "items": numbers,
        "impacts": impacts,
        "ceilings": ceilings,
        "block_starts": np.array(block_starts),
        "blocks": np.concatenate(blocks),
        "block_ceilings": np.concatenate(block_ceilings),
    }
    return Index(
        **arrays,
        lists={name: array.tolist() for name, array in arrays.items()},
        terms=terms,
        item_ids=[i for i, _ in items],
        parts=[tuple([terms[w] for w in part] for part in question_and_answer(text)) for _, text in items],
        essential=essential,
        slack=slack,
        span=max(len(words_of(text)) for _, text in items),
    )


def windows_of(n_words: int, span: int) -> int:
    """Windows of ``2 * span`` words, ``span`` apart, so that any ``span`` words lie in one of them."""
    return max(1, -(-n_words // span) - 1)


def promising_windows(index: Index, ids, begins, ends, threshold: float):
    """Numbers of the windows for which some block of items may reach the threshold."""
    places = np.flatnonzero((ids >= 0) & index.essential[ids])
    terms = ids[places]
    mass = np.concatenate([[0.0], np.cumsum(index.ceilings[terms])])
    low, high = np.searchsorted(places, begins), np.searchsorted(places, ends)
    needed = threshold - index.slack.max() - 1e-9
    alive = np.flatnonzero(mass[high] - mass[low] >= needed)
    if not len(alive):
        return alive
    # Distinct terms of the windows left, then the blocks of these terms.
    counts = high[alive] - low[alive]
    at = np.repeat(low[alive] - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    pairs = np.unique(np.repeat(np.arange(len(alive)), counts) * len(index.ceilings) + terms[at])
    window, term = np.divmod(pairs, len(index.ceilings))
    first = index.block_starts[term]
    counts = index.block_starts[term + 1] - first
    at = np.repeat(first - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
    cell = np.repeat(window, counts) * len(index.slack) + index.blocks[at]
    bound = np.bincount(cell, index.block_ceilings[at], len(alive) * len(index.slack))
    bound = bound.reshape(len(alive), -1) + index.slack
    return alive[(bound >= threshold - 1e-9).any(1)]


def block_max_wand(index: Index, terms: list[int], threshold: float) -> list[tuple[int, float]]:
    """Items whose impacts on ``terms`` add up to the threshold, with the sum."""
    found = []
    starts, items, impacts = index.lists["starts"], index.lists["items"], index.lists["impacts"]
    block_starts, blocks = index.lists["block_starts"], index.lists["blocks"]
    ceilings, block_ceilings = index.lists["ceilings"], index.lists["block_ceilings"]
    last = len(index.item_ids)
    limit = threshold - 1e-9
    # A cursor: the item it stands at, its posting, its term.
    cursors = [(items[starts[t]], starts[t], t) for t in terms]

    def moved(cursor, item):
        _, at, term = cursor
        end = starts[term + 1]
        at = bisect_left(items, item, at, end)
        return (items[at] if at < end else last, at, term)

    while True:
        cursors.sort()
        bound, pivot = 0.0, -1
        for n, (item, _, term) in enumerate(cursors):
            if item == last:
                break
            bound += ceilings[term]
            if bound >= limit:
                pivot = n
                break
        if pivot < 0:
            return found
        target = cursors[pivot][0]
        while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == target:
            pivot += 1
        upto = pivot + 1
        after = cursors[upto][0] if upto < len(cursors) else last
        block = target // BLOCK
        shallow = 0.0
        for _, _, term in cursors[:upto]:
            at = bisect_left(blocks, block, block_starts[term], block_starts[term + 1])
            if at < block_starts[term + 1] and blocks[at] == block:
                shallow += block_ceilings[at]
        if shallow < limit:  # no item before the next block or cursor can do it with these terms
            target = max(target + 1, min((block + 1) * BLOCK, after))
            cursors[:upto] = [moved(c, target) if c[0] < target else c for c in cursors[:upto]]
        elif cursors[0][0] == target:
            score = sum(impacts[c[1]] for c in cursors[:upto])
            if score >= limit:
                found.append((target, score))
            cursors[:upto] = [moved(c, target + 1) for c in cursors[:upto]]
        else:
            cursors[:upto] = [moved(c, target) if c[0] < target else c for c in cursors[:upto]]


def overlap(part: list[int], passage: list[int], size: int = SHINGLE) -> float:
    """Share of the distinct shingles of ``part`` (all of it, if shorter) that the passage holds."""
    size = min(size, len(part))
    wanted = {tuple(part[i : i + size]) for i in range(len(part) - size + 1)}
    there = {tuple(passage[i : i + size]) for i in range(len(passage) - size + 1)}
    return len(wanted & there) / len(wanted)


def search_chunk(index: Index, texts: list[list[int]], threshold: float, least: float) -> list[dict]:
    """Of each text (as term numbers, -1 for other words): item number to its best match."""
    found: list[dict] = [{} for _ in texts]
    lengths = np.array([len(t) for t in texts], np.int64)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    ids = np.concatenate([np.asarray(t, np.int64) for t in texts])
    counts = np.array([windows_of(n, index.span) for n in lengths])
    owner = np.repeat(np.arange(len(texts)), counts)
    number = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begins = offsets[owner] + number * index.span
    ends = np.minimum(begins + 2 * index.span, offsets[owner + 1])
    for w in promising_windows(index, ids, begins, ends, threshold):
        passage = ids[begins[w] : ends[w]].tolist()
        terms = sorted(set(passage) - {-1})
        for item, score in block_max_wand(index, terms, threshold):
            question, answer = (overlap(part, passage) for part in index.parts[item])
            if question >= least and answer >= least:
                start = int(begins[w] - offsets[owner[w]])
                match = (score, -start, question, answer)
                best = found[owner[w]]
                best[item] = max(best.get(item, match), match)
    return found


def _shards(benchmark: DataFrame, threshold: float) -> Iterator[Index]:
    """Indexes of bounded size that together hold all items, with impacts from all of them."""
    items = benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL")
    words = items.mapInArrow(_distinct_words, "word string, n bigint")
    total = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    if not total[0]:
        return
    sizes = words.where("word IS NULL").agg(F.count("*"), F.sum("n")).first()
    count, mean_length = sizes[0], (sizes[1] or 0) / max(sizes[0], 1)
    frequency = words.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"))
    shards = -(-total[1] // SHARD_BYTES)
    for shard in range(shards):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard)
        own = part.mapInArrow(_distinct_words, "word string, n bigint").select("word").distinct()
        counts = {r["word"]: r["n"] for r in frequency.join(own, "word").collect()}
        rows = sorted(((r[0], r[1]) for r in part.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        index = build_index(rows, counts, count, mean_length, threshold)
        if index is not None:
            yield index


def _distinct_words(batches: Iterator) -> Iterator:
    """A row for each distinct word of a text, and one without a word for its length."""
    import pyarrow as pa

    for batch in batches:
        names, counts = [], []
        for text in batch.column(1):
            words = words_of(text.as_py())
            if words:
                distinct = set(words)
                names += [None, *distinct]
                counts += [len(words)] + [1] * len(distinct)
        yield pa.RecordBatch.from_arrays([pa.array(names, "string"), pa.array(counts, "int64")], ["word", "n"])


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, keep: list[str], threshold: float = THRESHOLD, least: float = OVERLAP
) -> DataFrame:
    """``row`` (columns ``keep`` of ``docs``) and ``matches``, for every row of ``docs``.

    ``matches`` lists the items of ``benchmark(item_id, text)`` that some passage of
    the text holds: BM25 at least ``threshold`` of the item's own score, and at least
    ``least`` of the shingles both of its question and of its answer. Each item comes
    once, with its best passage (the first of equals). Null texts and texts or items
    without a word match nothing; repeated rows and items are each kept; a null id
    stays null. Whole texts are searched once for each ``SHARD_BYTES`` of items.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("text").cast("string").alias("text"),
        F.struct(*keep).alias("row"),
        F.expr(f"CAST(array() AS {MATCHES})").alias("matches"),
    )
    schema = f"text string, row {rows.schema['row'].dataType.simpleString()}, matches {MATCHES}"
    for index in _shards(benchmark, threshold):
        rows = rows.mapInArrow(_searcher(spark.sparkContext.broadcast(vars(index)), threshold, least), schema)
    return rows.select("row", "matches")


def _searcher(shared, threshold: float, least: float):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        index = Index(**shared.value)
        get = index.terms.get
        for batch in batches:
            found, chunk, size = [], [], 0
            for text in batch.column(0):
                chunk.append([get(w, -1) for w in WORDS.findall((text.as_py() or "").lower())])
                size += len(chunk[-1])
                if size >= CHUNK_WORDS:
                    found += search_chunk(index, chunk, threshold, least)
                    chunk, size = [], 0
            if chunk:
                found += search_chunk(index, chunk, threshold, least)
            matches = [
                old + [
                    dict(item_id=index.item_ids[i], start=-m[1], score=m[0], question_overlap=m[2], answer_overlap=m[3])
                    for i, m in sorted(new.items())
                ]
                for old, new in zip(batch.column(2).to_pylist(), found, strict=True)
            ]
            column = pa.array(matches, batch.schema.field(2).type)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), column], schema=batch.schema)

    return run


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    found = find_leaks(docs, benchmark, ["doc_id"])
    matches = found.select("row.doc_id", F.inline("matches"))
    return matches.select(
        "doc_id",
        "item_id",
        F.col("start").alias("passage_start"),
        F.round("score", 6).alias("score"),
        F.round("question_overlap", 6).alias("question_overlap"),
        F.round("answer_overlap", 6).alias("answer_overlap"),
    )
