"""Best-fit packing of token sequences by a grouping genetic algorithm.

Pieces are dealt at random into groups of bounded size, each a bin packing problem
of its own. Several islands work on each group: an island breeds packings by a
crossover that injects whole well-filled bins of one parent into the other, removes
the bins that now hold duplicates, and puts the displaced pieces back by best fit.
Between epochs the best packings of an island migrate to its neighbour. Pieces of
loosely filled sequences are then dealt and packed once more, so that a group
leaves no half-empty sequence behind.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crowdtape.llm.common import stored, table

CAPACITY = 4096
#: Pieces in a group on average, islands for each group, epochs with a migration between them.
GROUP = 2048
ISLANDS = 3
EPOCHS = 2
#: Packings an island keeps, children it breeds in an epoch, packings it sends on.
POPULATION = 4
CHILDREN = 12
ELITES = 1
#: Sequences filled less than this share are packed again, together with those of other groups.
LOOSE = 0.97
#: Texts whose new words are encoded together.
TEXTS = 512
#: More than the sequences of a group.
BINS = 1 << 24

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# --- tokens -----------------------------------------------------------------


class WordIds(dict):
    """Numbers of words, and their ids, which are encoded together for many new words at a time.

    The tokenizer drops white space and never merges across it, so a text's ids are
    those of its words one after the other. Words of plain Latin letters, also
    before a full stop or comma, are merged by tiktoken with the merges of the same
    file, all in one call, which gives the same ids many times faster; all others go
    through ``tokenizers``. The words start anew when there are more than ``limit``.
    """

    #: Stands for the end of a word; no plain word has it.
    END = "\ue000"

    def __init__(self, path: str, limit: int = 1_000_000):
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.limit = limit
        with open(path, encoding="utf-8") as file:
            self._load_merges(json.load(file)["model"])
        self._forget()

    def _forget(self) -> None:
        import numpy as np

        self.clear()
        self.new: list[bytes] = []
        self.flat = np.zeros(1 << 16, "<u4")  # ids of all words, one after the other
        self.starts = np.zeros(1, np.int64)  # place of each word, and the end

    def _load_merges(self, model: dict) -> None:
        """The file's merges as ranks of bytes, after those that put the three bytes of ``END`` together."""
        import numpy as np
        import tiktoken

        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in printable]
        symbols = {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}
        byte_of = {symbol: b for b, symbol in symbols.items()}
        end = self.END.encode()

        def as_bytes(token: str) -> bytes:
            body = token.removesuffix("</w>")
            return bytes(byte_of[c] for c in body) + end * (body != token)

        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        later = [symbols[b] + "</w>" for b in range(256)] + ["".join(pair) for pair in pairs]
        tokens = [(as_bytes(symbol), symbol) for symbol in symbols.values()]
        tokens += [(end[:2], ""), (end, "")]
        tokens += [(as_bytes(token), token) for token in later]
        ranks: dict[bytes, int] = {}
        for data, _ in tokens:
            ranks.setdefault(data, len(ranks))
        self.ids, self.ends = np.zeros(len(ranks), "<u4"), np.zeros(len(ranks), bool)
        for data, token in reversed(tokens):
            self.ids[ranks[data]] = model["vocab"].get(token, 0)
            self.ends[ranks[data]] = data.endswith(end)
        self.merge = tiktoken.Encoding(
            "words", pat_str=r"[^ ]+", mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self.new.append(word)
        return number

    def numbers(self, text: str):
        """Numbers of a text's words; new ones have no ids before :meth:`encode_new`."""
        import numpy as np

        words = text.encode().split()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def encode_new(self) -> None:
        """Ids of the words met since the last call."""
        import numpy as np

        if not self.new:
            return
        pieces, counts, others = [], np.zeros(len(self.new), np.int64), []
        for at, word in enumerate(self.new):
            body = word.decode().lower()
            stem = body[:-1] if body[-1] in ".," else body
            if stem.isalpha() and max(stem) < "ɐ":
                pieces.append(stem)
                counts[at] = 1
                if stem is not body:
                    pieces.append(body[-1])
                    counts[at] = 2
            else:
                others.append(at)
        ranks = np.array(self.merge(f"{self.END} ".join([*pieces, ""])), np.int64)
        last = np.flatnonzero(self.ends[ranks]) + 1  # behind each piece
        behind = np.concatenate([[0], last])[np.cumsum(counts)]
        sizes = np.diff(behind, prepend=0)
        plain = self.ids[ranks]
        parts, done = [], 0
        rest = self.tokenizer.encode_batch([self.new[at].decode() for at in others], add_special_tokens=False)
        for at, encoding in zip(others, rest, strict=True):
            parts += [plain[done : behind[at]], np.array(encoding.ids, "<u4")]
            done = behind[at]
            sizes[at] = len(encoding.ids)
        parts.append(plain[done:])
        used, added = self.starts[-1], int(sizes.sum())
        if used + added > len(self.flat):
            self.flat = np.concatenate([self.flat[:used], np.zeros(max(len(self.flat), added), "<u4")])
        self.flat[used : used + added] = np.concatenate(parts)
        self.starts = np.concatenate([self.starts, used + np.cumsum(sizes)])
        self.new = []

    def ids_of(self, numbers):
        """Ids of the words with these numbers, one after the other."""
        import numpy as np

        starts = self.starts[numbers]
        sizes = self.starts[numbers + 1] - starts
        total = np.cumsum(sizes)
        count = int(total[-1]) if len(total) else 0
        return self.flat[np.arange(count) + np.repeat(starts - (total - sizes), sizes)]

    def encode_all(self, texts: list[str]) -> list:
        """Little-endian 32-bit ids of each text."""
        if len(self) > self.limit:
            self._forget()
        numbers = [self.numbers(text) for text in texts]
        self.encode_new()
        return [self.ids_of(some) for some in numbers]


def tokenized_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 1, capacity: int = CAPACITY
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32``: documents in ids, cut where longer than ``capacity``.

    A null or empty text is the end id alone. Repeated rows and null ids are kept
    row by row; other columns are ignored.
    """

    def cut(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        words = WordIds(tokenizer)
        end = np.array([end_id], "<u4")
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        for batch in batches:
            rows = []
            for at in range(0, batch.num_rows, TEXTS):
                texts = [text.as_py() or "" for text in batch.column(1).slice(at, TEXTS)]
                doc_ids = batch.column(0).slice(at, TEXTS).to_pylist()
                for doc_id, ids in zip(doc_ids, words.encode_all(texts), strict=True):
                    ids = np.concatenate([ids, end])
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        rows.append((doc_id, piece, start, len(part), zlib.crc32(part)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = ["int64", "int32", "int64", "int64", "int64"]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names)

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(cut, PIECES)


# --- the genetic algorithm on one group ---------------------------------------


class Packing:
    """Bins of item numbers and what each holds."""

    def __init__(self, bins: list[list[int]], fills: list[int]):
        self.bins, self.fills = bins, fills

    def key(self, capacity: int) -> tuple[int, float]:
        """Fewer bins first, then fuller ones (the sum of squared fills)."""
        return len(self.bins), -sum((f / capacity) ** 2 for f in self.fills)

    def best_fit(self, items: list[int], lengths: list[int], capacity: int) -> None:
        """Put ``items``, longest first, where the least room is left."""
        room = sorted((capacity - f, n) for n, f in enumerate(self.fills) if f < capacity)
        for item in sorted(items, key=lambda i: -lengths[i]):
            length = lengths[item]
            at = bisect_left(room, (length, -1))
            if at < len(room):
                left, n = room.pop(at)
                self.bins[n].append(item)
                self.fills[n] += length
            else:
                left, n = capacity, len(self.bins)
                self.bins.append([item])
                self.fills.append(length)
            if left > length:
                insort(room, (left - length, n))


def crossover(a: Packing, b: Packing, lengths: list[int], capacity: int, rng) -> Packing:
    """Inject well-filled bins of ``b`` into ``a``, drop bins with duplicates, best-fit the rest."""
    ranked = sorted(range(len(b.bins)), key=lambda n: -b.fills[n])
    well_filled = ranked[: max(1, len(ranked) // 2)]
    chosen = rng.sample(well_filled, max(1, len(well_filled) // 4))
    injected = {i for n in chosen for i in b.bins[n]}
    bins = [list(b.bins[n]) for n in chosen]
    fills = [b.fills[n] for n in chosen]
    displaced = []
    for items, fill in zip(a.bins, a.fills, strict=True):
        if injected.isdisjoint(items):
            bins.append(list(items))
            fills.append(fill)
        else:
            displaced += [i for i in items if i not in injected]
    child = Packing(bins, fills)
    child.best_fit(displaced, lengths, capacity)
    return child


def mutate(packing: Packing, lengths: list[int], capacity: int, rng) -> Packing:
    """Empty the loosest bin and a few others, and best-fit their items."""
    count = len(packing.bins)
    gone = {min(range(count), key=lambda n: packing.fills[n])}
    gone.update(rng.sample(range(count), min(count, 3)))
    kept = [n for n in range(count) if n not in gone]
    child = Packing([list(packing.bins[n]) for n in kept], [packing.fills[n] for n in kept])
    child.best_fit([i for n in gone for i in packing.bins[n]], lengths, capacity)
    return child


def first_packing(lengths: list[int], capacity: int, rng, shuffled: bool) -> Packing:
    packing = Packing([], [])
    items = list(range(len(lengths)))
    if shuffled:  # a random half first, so that the seeds of islands differ
        rng.shuffle(items)
        half = len(items) // 2
        packing.best_fit(items[:half], lengths, capacity)
        items = items[half:]
    packing.best_fit(items, lengths, capacity)
    return packing


def evolve(
    lengths: list[int], seeds: list[list[int]], capacity: int, seed: int, children: int = CHILDREN
) -> list[Packing]:
    """One epoch of one island; ``seeds`` are packings as bin numbers. Best packing first."""
    import random

    rng = random.Random(seed)
    least = -(-sum(lengths) // capacity)
    population = [_from_numbers(numbers, lengths) for numbers in seeds]
    while len(population) < POPULATION:
        population.append(first_packing(lengths, capacity, rng, shuffled=bool(population)))
        if len(population[-1].bins) == least:
            break
    population.sort(key=lambda p: p.key(capacity))
    for _ in range(children):
        if len(population[0].bins) == least:  # no packing has fewer
            break
        a, b = rng.sample(population, 2) if len(population) > 1 else population * 2
        child = mutate(crossover(a, b, lengths, capacity, rng), lengths, capacity, rng)
        if child.key(capacity) < population[-1].key(capacity):
            population[-1] = child
            population.sort(key=lambda p: p.key(capacity))
    return population


def _from_numbers(numbers: list[int], lengths: list[int]) -> Packing:
    bins: list[list[int]] = [[] for _ in range(max(numbers) + 1)]
    for item, n in enumerate(numbers):
        bins[n].append(item)
    return Packing(bins, [sum(lengths[i] for i in items) for items in bins])


def _numbers(packing: Packing, count: int) -> list[int]:
    numbers = [0] * count
    for n, items in enumerate(packing.bins):
        for item in items:
            numbers[item] = n
    return numbers


# --- islands on Spark ---------------------------------------------------------


def _islands(groups: DataFrame, capacity: int, islands: int, epochs: int) -> DataFrame:
    """Best packing of each group as bin numbers: ``group, numbers``."""
    schema = "group bigint, island int, n_bins int, elites array<array<int>>"

    def epoch(number: int) -> Callable[[Iterator], Iterator]:
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in batches:
                rows = []
                for row in batch.to_pylist():
                    lengths, seeds = row["lengths"], row["seeds"] or []
                    seed = (row["group"] * 1009 + row["island"]) * 31 + number
                    population = evolve(lengths, seeds, capacity, seed)
                    elites = [_numbers(p, len(lengths)) for p in population[: ELITES + 1]]
                    rows.append((row["group"], row["island"], len(population[0].bins), elites))
                columns = list(zip(*rows, strict=True)) or [[]] * 4
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.list_(pa.int32()))]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, ["group", "island", "n_bins", "elites"])

        return run

    lengths = groups.select("group", F.transform("members", lambda m: m["length"].cast("int")).alias("lengths"))
    each = lengths.withColumn("island", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))))
    no_seeds = each.withColumn("seeds", F.lit(None).cast("array<array<int>>"))
    dealt = no_seeds.repartition("group", "island")
    state = stored(dealt.mapInArrow(epoch(0), schema), "islands")
    for number in range(1, epochs):
        sent = state.select(
            "group",
            ((F.col("island") + 1) % islands).alias("island"),
            F.slice("elites", 1, ELITES).alias("guests"),
        )
        own = state.select("group", "island", "elites")
        seeds = own.join(sent, ["group", "island"]).select(
            "group", "island", F.concat("elites", "guests").alias("seeds")
        )
        dealt = each.join(seeds, ["group", "island"]).select("group", "lengths", "island", "seeds")
        state = stored(dealt.mapInArrow(epoch(number), schema), "islands")
    best = F.struct("n_bins", "island", F.element_at("elites", 1).alias("numbers"))
    return state.groupBy("group").agg(F.min(best)["numbers"].alias("numbers"))


def _pack_groups(
    pieces: DataFrame, capacity: int, group: int, islands: int, epochs: int, level: int
) -> DataFrame:
    """``row, length`` with ``sequence`` (a struct of level, group, bin), as many rows."""
    count = max(1, -(-pieces.count() // group))
    # The rows are read from files, so a repeated task numbers them alike.
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(count)))
    members = F.collect_list(F.struct("row", "length"))
    groups = stored(dealt.groupBy("group").agg(members.alias("members")), "groups")
    best = _islands(groups, capacity, islands, epochs)
    placed = groups.join(best, "group").select(
        "group", F.explode(F.arrays_zip("members", "numbers")).alias("one")
    )
    sequence = F.struct(F.lit(level).alias("level"), "group", F.col("one.numbers").alias("bin"))
    return placed.select("one.members.*", sequence.alias("sequence"))


def pack(
    pieces: DataFrame,
    capacity: int = CAPACITY,
    group: int = GROUP,
    islands: int = ISLANDS,
    epochs: int = EPOCHS,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to ``pieces``, which need a ``length``.

    Every row gets a place in a sequence of at most ``capacity`` ids, without gaps
    from 0. Full pieces are sequences of their own. A null, zero or too long
    ``length`` is an error; repeated rows are different pieces; an empty table
    stays empty. ``sequence_id`` is unique but not dense. Other columns pass
    through, but ``sequence_id`` and ``offset`` of the input are replaced.
    """
    kept = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    length = F.when(F.col("length").between(1, capacity), F.col("length").cast("long"))
    length = F.coalesce(length, F.raise_error(F.lit(f"length must be 1 to {capacity}")).cast("long"))
    rows = stored(pieces.select(F.struct(*kept).alias("row"), length.alias("length")), "pieces")
    parts = rows.where(F.col("length") < capacity)
    packed = stored(_pack_groups(parts, capacity, group, islands, epochs, 0), "packed")
    fills = packed.groupBy("sequence").agg(F.sum("length").alias("fill"))
    filled = stored(packed.join(fills, "sequence"), "filled")
    loose = F.col("fill") < LOOSE * capacity
    again = _pack_groups(filled.where(loose).select("row", "length"), capacity, group, islands, epochs, 1)
    placed = filled.where(~loose).select("row", "length", "sequence").unionByName(again)
    number = F.col("sequence.group") * BINS + F.col("sequence.bin")
    # At most ``capacity`` rows share a sequence.
    earlier = Window.partitionBy("sequence").orderBy("length").rowsBetween(Window.unboundedPreceding, -1)
    shared = placed.select(
        "row.*",
        (number * 2 + F.col("sequence.level")).alias("sequence_id"),
        F.coalesce(F.sum("length").over(earlier), F.lit(0).cast("long")).alias("offset"),
    )
    single = rows.where(F.col("length") == capacity).select(
        "row.*",
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return shared.unionByName(single)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from crowdtape.llm.separators import tokenizer_path

    docs = table(spark, sf_dir, "documents")
    return pack(tokenized_pieces(docs, tokenizer_path("word_bpe_49k.json")))
