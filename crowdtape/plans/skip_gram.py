"""Skip-gram word vectors with hierarchical softmax, as ``Word2Vec`` of Spark, with the vocabulary in no single place.

Texts are dealt over tasks by a hash. A task gets the words of its own texts, each with the
place of its leaf in the Huffman tree of all words, and trains them in the order of
hashes; the vectors of a word are averaged over its tasks. Words of one count are leaves side
by side, so the tree is one of runs of equal nodes: the driver holds a few numbers for
each different count, and a task follows its own words from their leaves to the root.
Vectors follow the texts and the number of tasks alone.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crowdtape.functions.text import tokens
from crowdtape.plans.word_vectors import dealt, list_array, mean_vectors, packed, unpacked
from crowdtape.session import drop, stored

# Fixed values, those of Spark: neighbours on either side, learning rate and the least share of it,
# words of a sentence, and the sum beyond which a node learns nothing.
WINDOW = 5
RATE, LEAST_RATE = 0.025, 1e-4
SENTENCE = 1000
MOST = 6.0
#: Neighbouring places that are learned from at a time.
PLACES = 16
#: Rows of a batch of vectors.
ROWS = 1 << 13

#: Bits of the number that a row has within its partition, in ``monotonically_increasing_id``.
_OWN = 33


@dataclass(frozen=True)
class Tree:
    """A Huffman tree as runs of nodes of one weight; the first runs are the leaves.

    The first ``2 * pairs`` nodes of a run have the nodes of the run ``up`` as parents, two each;
    of the others, at most two, ``at`` is the number, ``over`` the parent (a run of one) and ``bit`` the side.
    ``base`` is the number of a run's first node among the inner ones.
    """

    up: np.ndarray
    pairs: np.ndarray
    base: np.ndarray
    at: np.ndarray
    over: np.ndarray
    bit: np.ndarray

    def paths(self, run: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``leaf, node, bit``: the inner nodes above each leaf and the sides on which it is below them."""
        leaf = np.arange(len(run))
        found: list[tuple[np.ndarray, ...]] = []
        while len(leaf):
            paired = place < 2 * self.pairs[run]
            up, over, bit = np.where(paired, self.up[run], -1), np.where(paired, place // 2, 0), place % 2
            for n in range(2):
                own = self.at[run, n] == place
                up, bit = np.where(own, self.over[run, n], up), np.where(own, self.bit[run, n], bit)
            below = up >= 0
            leaf, run, place, bit = leaf[below], up[below], over[below], bit[below]
            found.append((leaf, self.base[run] + place, bit))
        return tuple(np.concatenate(c) for c in zip(*found, strict=True)) if found else (leaf, leaf, leaf)


def huffman(weights: list[int], numbers: list[int]) -> Tree:
    """The tree of ``numbers[i]`` leaves of weight ``weights[i]`` each."""
    up, pairs, base = [-1] * len(weights), [0] * len(weights), [0] * len(weights)
    others: list[list[tuple[int, int, int]]] = [[] for _ in weights]
    inner = 0
    heap = [(w, run, n) for run, (w, n) in enumerate(zip(weights, numbers, strict=True))]
    heapq.heapify(heap)

    def add(weight: int, number: int) -> int:
        nonlocal inner
        up.append(-1), pairs.append(0), base.append(inner), others.append([])
        inner += number
        heapq.heappush(heap, (weight, len(up) - 1, number))
        return len(up) - 1

    while heap:
        weight, run, number = heapq.heappop(heap)
        if number > 1:
            up[run], pairs[run] = add(2 * weight, number // 2), number // 2
            if number % 2:
                heapq.heappush(heap, (weight, run, 1))
        elif heap:
            second, other, left = heapq.heappop(heap)
            parent = add(weight + second, 1)
            others[run].append((2 * pairs[run], parent, 0))
            others[other].append((2 * pairs[other] + left - 1, parent, 1))
            if left > 1:
                heapq.heappush(heap, (second, other, left - 1))
    rest = np.array([(o + [(-1, -1, 0)] * 2)[:2] for o in others], np.int64).reshape(-1, 2, 3)
    return Tree(*(np.array(c, np.int64) for c in (up, pairs, base)), rest[..., 0], rest[..., 1], rest[..., 2])


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64 of unsigned numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _start(ranks: np.ndarray, size: int, seed: int) -> np.ndarray:
    """First vectors of words by their ranks: between -0.5 and 0.5, by the number of entries."""
    steps = np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    keys = _mixed(ranks.astype(np.uint64) + np.uint64(seed))
    found = np.empty((len(ranks), size), np.float32)
    for at in range(0, len(ranks), ROWS):
        bits = _mixed(keys[at : at + ROWS, None] + steps) >> np.uint64(40)
        found[at : at + ROWS] = (bits.astype(np.float32) / np.float32(1 << 24) - np.float32(0.5)) / np.float32(size)
    return found


class _Learner:
    """Vectors of the words of one task and of the inner nodes above them."""

    def __init__(self, paths, vectors: np.ndarray):
        leaf, node, bit = paths
        order = np.argsort(leaf, kind="stable")
        nodes, self.node = np.unique(node[order], return_inverse=True)
        self.label = (1 - bit[order]).astype(np.float32)
        self.first = np.searchsorted(leaf[order], np.arange(len(vectors) + 1))
        self.words, self.nodes = vectors, np.zeros((len(nodes), vectors.shape[1]), np.float32)

    def learn(self, ids: np.ndarray, sentence: np.ndarray, window: np.ndarray, rate) -> None:
        """One pass over the places of some texts; ``rate`` gives that of a place.

        Of a few neighbouring places, all words, the words around them and the nodes
        above the former meet in products of small matrices.
        """
        for low in range(0, len(ids), PLACES):
            high = min(low + PLACES, len(ids))
            left, right = max(0, low - WINDOW), min(len(ids), high + WINDOW)
            around, own = ids[left:right], ids[low:high]
            apart = np.abs(np.arange(left, right)[:, None] - np.arange(low, high))
            near = (apart > 0) & (apart <= window[low:high]) & (sentence[left:right, None] == sentence[low:high])
            near = near.astype(np.float32)
            length = self.first[own + 1] - self.first[own]
            ends = np.cumsum(length)
            if not ends[-1]:
                continue
            flat = np.repeat(self.first[own] - ends + length, length) + np.arange(ends[-1])
            nodes, column = np.unique(self.node[flat], return_inverse=True)
            place = np.repeat(np.arange(high - low), length)
            above, label = np.zeros((2, high - low, len(nodes)), np.float32)
            above[place, column] = 1
            label[place, column] = self.label[flat]
            x, p = self.words[around], self.nodes[nodes]
            sums = x @ p.T
            meets, step = near @ above, np.float32(rate(low))
            gain = near @ label - meets / (1 + np.exp(-np.clip(sums, -MOST, MOST)))
            gain *= (np.abs(sums) < MOST) * step
            # What many pairs add to one row at a time is damped by the most they can bend the loss: one after the
            # other they would stop at its minimum, and together go beyond it.
            bend = step / 4
            self.nodes[nodes] = p + gain.T @ x / (1 + bend * (meets.T @ np.square(x).sum(1)))[:, None]
            np.add.at(self.words, around, gain @ p / (1 + bend * (meets @ np.square(p).sum(1)))[:, None])


def _batches(words, vectors: np.ndarray) -> Iterator:
    import pyarrow as pa

    for at in range(0, len(words), ROWS):
        arrays = [words[at : at + ROWS], packed(vectors[at : at + ROWS])]
        yield pa.RecordBatch.from_arrays(arrays, ["word", "vector"])


def _trainer(tree: Tree, firsts: np.ndarray, parts: np.ndarray, total: int, tasks: int, size: int, seed: int):
    """Trains the texts of one task, which come after its words.

    ``firsts`` are the ranks of the first words of each count, from the smallest count on, ``parts`` those of the
    first words of each partition.
    """

    def train(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc

        held, learner, words, done = [], None, None, 0
        for batch in batches:
            known = pc.is_valid(batch.column("word"))
            if (own := batch.filter(known)).num_rows:
                held.append(own)
            texts = batch.filter(pc.invert(known))
            if not texts.num_rows or not (held or learner):
                continue
            if learner is None:
                rows = pa.Table.from_batches(held)
                words = rows["word"].combine_chunks()
                at = rows["at"].to_numpy()
                ranks = parts[at >> _OWN] + (at & ((1 << _OWN) - 1))
                run = np.searchsorted(firsts, ranks, "right") - 1
                learner = _Learner(tree.paths(run, ranks - firsts[run]), _start(ranks, size, seed))
                held.clear()
            lists = texts.column("words")
            ids = pc.index_in(lists.flatten(), value_set=words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            text = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[ids >= 0]
            ids = ids[ids >= 0]
            begin = np.searchsorted(text, np.arange(len(lists)))
            sentence = text * (1 << 32) + (np.arange(len(ids)) - begin[text]) // SENTENCE
            task = np.uint64(texts.column("task")[0].as_py())
            drawn = _mixed(np.arange(done, done + len(ids), dtype=np.uint64) + (task << np.uint64(40)) + np.uint64(seed))
            window = WINDOW - (drawn % np.uint64(WINDOW)).astype(np.int64)
            learner.learn(ids, sentence, window, lambda at, done=done: RATE * max(LEAST_RATE, 1 - tasks * (done + at) / (total + 1)))
            done += len(ids)
        if learner is not None:
            yield from _batches(words, learner.words)

    return train


def _averaged(batches: Iterator) -> Iterator:
    """The mean of each run of rows with one word."""
    import pyarrow as pa
    import pyarrow.compute as pc

    held = None  # word, sum and number of rows of the last run, which the next batch may continue
    for batch in batches:
        if not batch.num_rows:
            continue
        words, rows = batch.column(0), unpacked(batch.column(1)).astype(np.float64)
        change = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
        starts = np.concatenate([[0], np.flatnonzero(change) + 1])
        sums, number = np.add.reduceat(rows, starts), np.diff(np.append(starts, len(rows)))
        names = words.take(pa.array(starts))
        if held and names[0].as_py() == held[0]:
            sums[0] += held[1]
            number[0] += held[2]
        elif held:
            yield from _batches(pa.array([held[0]]), (held[1] / held[2])[None])
        held = names[-1].as_py(), sums[-1], number[-1]
        yield from _batches(names[:-1], sums[:-1] / number[:-1, None])
    if held:
        yield from _batches(pa.array([held[0]]), (held[1] / held[2])[None])


@dataclass(frozen=True)
class SkipGrams:
    """Trained vectors: a stored table of ``word`` and ``vector``, the latter packed."""

    vectors: DataFrame
    size: int
    tasks: int

    def getNumPartitions(self) -> int:  # noqa: N802
        return self.tasks

    def getVectors(self) -> DataFrame:  # noqa: N802
        """``word`` and ``vector``, an array."""

        def arrays(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                if batch.num_rows:
                    rows = unpacked(batch.column(1)).astype(np.float32)
                    yield pa.RecordBatch.from_arrays([batch.column(0), list_array(rows)], ["word", "vector"])

        return self.vectors.mapInArrow(arrays, "word string, vector array<float>")

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``vector``, the mean vector of the words of ``text``; zeros for a text without any."""
        from pyspark.ml.functions import array_to_vector

        zeros = F.array(*(F.lit(0.0) for _ in range(self.size)))
        means = mean_vectors(df, self.vectors, self.size)
        return means.withColumn("vector", array_to_vector(F.coalesce("vector", zeros)))


def fit_skip_grams(texts: DataFrame, size: int, min_count: int, seed: int, tasks: int, text: str = "text") -> SkipGrams:
    """Vectors of all words that ``texts`` hold ``min_count`` times, learned in one pass by so many ``tasks``."""
    spark, counts, scratch = texts.sparkSession, [], []
    task = dealt(texts, tasks)
    known = texts.where(F.col(text).isNotNull())
    placed = known.select(task, F.explode(tokens(F.col(text))).alias("word"))
    own = stored(placed.groupBy("task", "word").agg(F.count("*").alias("times")), "task-words", counts)
    counted = own.groupBy("word").agg(F.sum("times").alias("n")).where(F.col("n") >= min_count)
    ordered = counted.orderBy("n", F.xxhash64("word"), "word").withColumn("at", F.monotonically_increasing_id())
    ranked = stored(ordered, "ranked-words", counts)
    # One row for each different count, and for each partition.
    classes = sorted((r.n, r.words) for r in ranked.groupBy("n").agg(F.count("*").alias("words")).collect())
    part = F.shiftright("at", _OWN).alias("part")
    parts = {r.part: r.words for r in ranked.groupBy(part).agg(F.count("*").alias("words")).collect()}
    offsets = np.cumsum([0, *(parts.get(n, 0) for n in range(max(parts, default=0)))])
    weights, numbers = ([c[n] for c in classes] for n in range(2))
    firsts = np.cumsum([0, *numbers])[:-1]
    total = sum(n * words for n, words in classes)
    words = stored(own.select("task", "word").join(ranked.select("word", "at"), "word"), "task-words", scratch)
    drop(spark, counts)
    rows = known.select(task, F.col(text).alias("_text"), F.xxhash64(text).alias("hash"))
    met = words.unionByName(rows, allowMissingColumns=True).repartitionById(tasks, "task")
    met = met.sortWithinPartitions(F.col("word").isNull(), "at", "hash")
    met = met.select("task", "word", "at", tokens(F.col("_text")).alias("words"))
    train = _trainer(huffman(weights, numbers), firsts, offsets, total, tasks, size, seed)
    kind = "word string, vector binary"
    # In the order of the tasks, so that sums are the same on every run.
    trained = met.mapInArrow(train, kind).withColumn("part", F.spark_partition_id())
    trained = trained.repartition("word").sortWithinPartitions("word", "part").select("word", "vector")
    vectors = stored(trained.mapInArrow(_averaged, kind), "word-vectors")
    drop(spark, scratch)
    return SkipGrams(vectors, size, tasks)
