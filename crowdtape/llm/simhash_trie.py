"""SimHash near-duplicates: a self-join of binary tries of the fingerprints.

The join walks pairs of trie nodes together from the root down, adds up the bits in
which the two differ, and drops a pair once that exceeds the error budget. So that
many tasks share the walk, the fingerprint is cut into one block more than the
budget has bits: two fingerprints within the budget agree in some block. For each
block there is a trie with that block rotated to the top, and the walk starts where
the tops agree, so each top is a task of its own. A top that holds very many
fingerprints is dealt into chunks that are joined pair by pair.

Only distinct fingerprints are joined, and each task reports a spanning forest of
the links it found rather than all of them, which has the same components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.llm.common import LOWER, stored, table

BITS = 64
BUDGET = 2
SHINGLE = 3
#: XXH64 seed of the shingles.
SEED = 42
#: Fingerprints under one top that one task joins; more are dealt into chunks.
CHUNK = 1 << 17
#: Shingles whose bits are counted at a time.
STEP = 1 << 15


# --- fingerprints --------------------------------------------------------------


def shingles(text: str, size: int = SHINGLE) -> tuple[bytes, np.ndarray]:
    """The words of a text in lower case, one blank between them, and the hashes of its shingles.

    A text with fewer than ``size`` words is one shingle, one without words has none.
    """
    import xxhash

    words = text.translate(LOWER).encode().split()
    if not words:
        return b"", np.zeros(0, np.uint64)
    count = max(1, len(words) - size + 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    data = b" ".join(words)
    starts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
    ends = (starts + lengths)[min(size, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    view = memoryview(data)
    pairs = zip(starts[:count].tolist(), ends, strict=True)
    return data, np.fromiter((digest(view[a:b], SEED) for a, b in pairs), np.uint64, count)


def majority(hashes) -> int:
    """Majority of the hashes' bits; 0 without any."""
    votes = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), STEP):
        part = hashes[at : at + STEP].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    set_bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprint(text: str, size: int = SHINGLE) -> int:
    """Majority of the shingles' hash bits; 0 for a text without words."""
    return majority(shingles(text, size)[1])


def fingerprints(docs: DataFrame, keep: list[str], size: int = SHINGLE) -> DataFrame:
    """``row`` (columns ``keep``) and ``fp``, the fingerprint as a signed long."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            values = np.array([fingerprint(t.as_py() or "", size) for t in batch.column(0)], np.uint64)
            fields = [batch.schema.field(1), pa.field("fp", pa.int64())]
            columns = [batch.column(1), pa.array(values.view(np.int64), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    narrow = docs.select(F.col("text").cast("string"), F.struct(*keep).alias("row"))
    return narrow.mapInArrow(run, f"row {narrow.schema['row'].dataType.simpleString()}, fp bigint")


# --- the trie join --------------------------------------------------------------


def rotated(fp, by: int):
    if by == 0:
        return fp
    return (fp << np.uint64(by)) | (fp >> np.uint64(BITS - by))


def tops(budget: int) -> list[tuple[int, int]]:
    """Start and width of each block."""
    edges = [BITS * n // (budget + 1) for n in range(budget + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


def join_tries(left, right, pairs, depth, budget: int):
    """Positions ``(i, j)`` of values within ``budget`` bits.

    ``left`` and ``right`` are sorted within each of the root ``pairs``
    (low and high of a node on either side), whose values agree in the top ``depth``
    bits. A trie node is a run of sorted values with a common prefix; all pairs of one
    depth are split at the same time. Pairs of single values are told at once.
    """
    a0, a1, b0, b1 = (np.asarray(c, np.int64) for c in pairs)
    spent = np.zeros(len(a0), np.int64)
    depth = np.asarray(depth, np.int64)
    out_i, out_j = [], []
    while len(a0):
        single = (a1 - a0 == 1) & (b1 - b0 == 1) | (depth >= BITS)
        if single.any():
            # A node of full depth is one value, as values are distinct on either side.
            i, j = a0[single], b0[single]
            near = np.bitwise_count(left[i] ^ right[j]) <= budget
            out_i.append(i[near])
            out_j.append(j[near])
            a0, a1, b0, b1, spent, depth = (c[~single] for c in (a0, a1, b0, b1, spent, depth))
            if not len(a0):
                break
        shift = (BITS - 1 - depth).astype(np.uint64)
        am, bm = _split(left, a0, a1, shift), _split(right, b0, b1, shift)
        parts = []
        for al, ah, bl, bh, cost in ((a0, am, b0, bm, 0), (am, a1, bm, b1, 0), (a0, am, bm, b1, 1), (am, a1, b0, bm, 1)):
            keep = (ah > al) & (bh > bl) & (spent + cost <= budget)
            if left is right:  # a pair and its mirror image are one
                keep &= (al <= bl) if cost == 0 else ((al < bl) | (a0 != b0))
            parts.append(tuple(c[keep] for c in (al, ah, bl, bh, spent + cost, depth + 1)))
        a0, a1, b0, b1, spent, depth = (np.concatenate(c) for c in zip(*parts, strict=True))
    if not out_i:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_i), np.concatenate(out_j)


def _split(values, low, high, shift):
    """First position of each run whose bit at ``shift`` is set, by binary search in all runs at once."""
    low, high = low.copy(), high.copy()
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high) // 2
        bit = np.zeros(len(low), bool)
        bit[open_] = (values[middle[open_]] >> shift[open_]) & np.uint64(1) == 1
        high = np.where(open_ & bit, middle, high)
        low = np.where(open_ & ~bit, middle + 1, low)


def spanning_forest(i, j, count: int):
    """Pairs ``(member, root)`` with the components of the links, without members that are roots."""
    root = np.arange(count)
    while len(i):
        a, b = root[i], root[j]
        differ = a != b
        if not differ.any():
            break
        i, j, a, b = i[differ], j[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root != root[root]).any():
            root = root[root]
    member = np.flatnonzero(root != np.arange(count))
    return member, root[member]


def _join_groups(values, groups, sides, depths, budget: int):
    """Spanning links of sorted rows: ``groups`` are numbered runs, ``sides`` 0, 1, or 2 for both."""
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    ends = np.append(starts[1:], len(values))
    middle = np.searchsorted(groups * 4 + sides, groups[starts] * 4 + 1)  # first row of side 1
    whole = sides[starts] == 2
    roots = np.where(whole, starts, starts), np.where(whole, ends, middle)
    others = np.where(whole, starts, middle), ends
    worth = np.where(whole, ends - starts > 1, (middle > starts) & (ends > middle))
    pairs = [c[worth] for c in (*roots, *others)]
    i, j = join_tries(values, values, pairs, depths[starts[worth]], budget)
    distinct = i != j
    return spanning_forest(i[distinct], j[distinct], len(values))


def links(distinct: DataFrame, budget: int = BUDGET, chunk: int = CHUNK) -> DataFrame:
    """``a, b``: links between the fingerprints of ``distinct(fp)`` with the same components as all links."""
    blocks = tops(budget)
    rotations = F.array(
        *(
            F.struct(
                F.lit(n).alias("block"),
                F.shiftrightunsigned(_rotated_column(start), BITS - width).alias("top"),
            )
            for n, (start, width) in enumerate(blocks)
        )
    )
    rows = distinct.select("fp", F.inline(rotations))
    return walk(stored(rows, "trie-rows"), blocks, budget, chunk)


def walk(rows: DataFrame, blocks: list[tuple[int, int]], budget: int, chunk: int) -> DataFrame:
    """``a, b``: spanning links of the fingerprints ``fp`` under each ``block, top`` of ``rows``.

    A block's start and width are its place in ``blocks``; fingerprints under one top
    are distinct and agree in that many bits.
    """
    crowded = rows.groupBy("block", "top").count().where(F.col("count") > chunk)
    chunks = crowded.select("block", "top", F.ceil(F.col("count") / chunk).cast("int").alias("chunks"))
    dealt = rows.join(chunks, ["block", "top"], "left").fillna(1, ["chunks"])
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = dealt.select("fp", "block", "top", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
    dealt = dealt.select(
        "fp",
        "block",
        "top",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        F.when(F.col("own") == F.col("other"), 2).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side"),
    )
    keys = ["block", "top", "low", "high"]
    sorted_rows = dealt.repartition(*keys).sortWithinPartitions(*keys, "side")
    return sorted_rows.mapInPandas(_walker(blocks, budget, keys), "a bigint, b bigint")


def _rotated_column(by: int):
    fp = F.col("fp")
    if by == 0:
        return fp
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by))


def _walker(blocks, budget: int, keys: list[str]):
    def join(frame: pd.DataFrame) -> pd.DataFrame:
        fp = frame["fp"].to_numpy(np.int64).view(np.uint64)
        block = frame["block"].to_numpy()
        value = fp.copy()
        for n, (start, _) in enumerate(blocks):
            value[block == n] = rotated(fp[block == n], start)
        depth = np.array([width for _, width in blocks])[block]
        change = (frame[keys].to_numpy()[1:] != frame[keys].to_numpy()[:-1]).any(1)
        group = np.concatenate([[0], np.cumsum(change)])
        side = frame["side"].to_numpy().astype(np.int64)
        order = np.lexsort((value, side, group))
        member, root = _join_groups(value[order], group[order], side[order], depth[order], budget)
        own = fp[order].view(np.int64)
        return pd.DataFrame({"a": own[member], "b": own[root]})

    def run(batches: Iterator) -> Iterator:
        held = None  # rows of the last group, which the next batch may continue
        for frame in batches:
            if not len(frame):
                continue
            held = frame if held is None else pd.concat([held, frame], ignore_index=True)
            last = (held[keys] == held[keys].iloc[-1]).all(axis=1).to_numpy()
            whole = int(np.argmax(last))
            if whole:
                yield join(held.iloc[:whole])
                held = held.iloc[whole:]
        if held is not None:
            yield join(held)

    return run


# --- components ------------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``node, root``: the smallest node of each node's component, for all nodes of ``edges(a, b)``.

    Alternates two steps until nothing moves: every node's greater neighbours are
    linked to its smallest neighbour, then its smaller ones. Each is an aggregate and
    a join, each round a written table; no task holds the neighbours of a node.
    """
    flat = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    state = stored(edges.where("a <> b").select(flat.alias("e")).select("e.*").distinct(), "edges")
    while True:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        moved = small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        kept = least.select("a", F.col("m").alias("b"))
        after = stored(kept.unionByName(moved).distinct(), "edges")
        # Stars: no root has a smaller neighbour any more.
        unsettled = after.alias("x").join(after.alias("y"), F.col("x.b") == F.col("y.a"), "left_semi")
        state = after
        if unsettled.isEmpty() and after.groupBy("a").count().where("count > 1").isEmpty():
            break
    roots = state.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return state.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def near_duplicates(docs: DataFrame, keep: list[str], size: int = SHINGLE, budget: int = BUDGET) -> DataFrame:
    """``row`` (columns ``keep``, with ``doc_id``), ``fp`` and ``component_id`` of every row.

    Rows link whose fingerprints differ in at most ``budget`` bits; ``component_id``
    is the smallest ``doc_id`` reachable by links. Null, empty and blank texts have
    fingerprint 0 and link like any other; a null ``doc_id`` gets its component's
    id, null only if no member has an id. Repeated rows are members of their own.
    """
    marked = stored(fingerprints(docs, keep, size), "fingerprints")
    each = marked.groupBy("fp").agg(F.min("row.doc_id").alias("doc_id"))
    each = stored(each, "distinct-fingerprints")
    found = stored(links(each.select("fp"), budget), "links")
    member = components(found)
    rooted = each.join(member, F.col("fp") == F.col("node"), "left").select(
        "fp", "doc_id", F.coalesce("root", "fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_fp = rooted.join(ids, "root").select("fp", "component_id")
    return marked.join(by_fp, "fp").select("row", "fp", "component_id")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), ["doc_id"])
    text = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.select("row.doc_id", text, "component_id")
