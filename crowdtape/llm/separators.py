"""Token counts of flat token files: find the separators, then stitch the blocks.

A flat token file is a run of fixed-width little-endian ids; each document ends
with a separator id and no index says where. ``scan_token_files`` cuts the files
into blocks of equal size, searches each block with one vectorised comparison,
and turns block-local finds into documents with an exclusive prefix scan over two
small numbers per block: how many separators it holds and where the last one is.
Both combine associatively (sum and maximum), so the scan runs in two levels and
no task sees more than ``CHUNK`` blocks of a file, however long the file is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crowdtape.llm.common import new_name, open_folder, stored
from crowdtape.session import shared_dir

#: Ids in a block (8 MB of two-byte ids), and blocks in a chunk of the prefix scan.
BLOCK = 1 << 22
CHUNK = 1 << 10
#: Token files are closed once they hold this many bytes.
FILE_BYTES = 256 << 20

WRITTEN = "file string, ordinal bigint, doc_id bigint, n_bytes bigint"


def byte_bpe(path: str) -> Callable[[str], list[int]]:
    """Encoder of a tiktoken rank file."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding(
        "flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    return encoding.encode_ordinary


def write_token_files(
    docs: DataFrame, tokenizer: str, separator: int, dtype: str = "<u2", file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write ``docs(doc_id, text)`` as flat token files; say what went where.

    Each task appends the ids of its documents and ``separator`` to files of its
    own, named anew by each attempt, and returns a row per document (file, ordinal
    in the file, doc_id) and a row per closed file (ordinal -1, its bytes). These
    rows are written as a table, so files of failed attempts are never read.

    A null text has no ids, only the separator. Null and repeated ``doc_id`` are
    kept row by row; other columns are ignored; an empty table gives no file.
    """
    spark = docs.sparkSession
    folder = shared_dir(spark, "tokens")

    def write(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        encode = byte_bpe(tokenizer)
        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)
        name, out, ordinal, size = None, None, 0, 0
        end = np.array([separator], dtype).tobytes()

        def rows(names, ordinals, ids, sizes):
            columns = [pa.array(names, "string"), pa.array(ordinals, "int64")]
            columns += [pa.array(ids, "int64"), pa.array(sizes, "int64")]
            return pa.RecordBatch.from_arrays(columns, ["file", "ordinal", "doc_id", "n_bytes"])

        for batch in batches:
            names, ordinals, ids = [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if out is None:
                    name, ordinal, size = new_name(".tokens"), 0, 0
                    out = files.open_output_stream(f"{root}/{name}")
                data = np.array(encode(text.as_py() or ""), dtype).tobytes() + end
                out.write(data)
                names.append(f"{folder}/{name}")
                ordinals.append(ordinal)
                ids.append(doc_id)
                ordinal, size = ordinal + 1, size + len(data)
                if size >= file_bytes:
                    out.close()
                    out = None
                    yield rows([f"{folder}/{name}"], [-1], [None], [size])
            yield rows(names, ordinals, ids, [None] * len(names))
        if out is not None:
            out.close()
            yield rows([f"{folder}/{name}"], [-1], [None], [size])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(narrow.mapInArrow(write, WRITTEN), "token-rows")


def _blocks(files: DataFrame, separator: int, dtype: str, block: int) -> DataFrame:
    """A row per block: its separators as positions in the file."""
    import numpy as np

    width = np.dtype(dtype).itemsize
    step = block * width
    last = F.greatest(F.ceil(F.col("n_bytes") / step).cast("long") - 1, F.lit(0).cast("long"))
    ranges = files.where("n_bytes > 0").select(
        "file", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block")
    )

    def search(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for file, n_bytes, number in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if n_bytes % width:
                    raise ValueError(f"{file}: {n_bytes} bytes are no whole number of ids")
                system, path = open_folder(file)
                with system.open_input_file(path) as source:
                    data = source.read_at(min(step, n_bytes - number * step), number * step)
                found = np.flatnonzero(np.frombuffer(data, dtype) == separator) + number * block
                rows = {
                    "file": [file],
                    "block": [number],
                    "chunk": [number // CHUNK],
                    "n_ids": [len(data) // width],
                    "n_found": [len(found)],
                    "last": [int(found[-1]) if len(found) else -1],
                    "found": [found.astype("int64")],
                }
                yield pa.RecordBatch.from_pydict(rows)

    schema = (
        "file string, block bigint, chunk bigint, n_ids bigint, n_found bigint, last bigint, "
        "found array<bigint>"
    )
    dealt = ranges.repartition(F.col("file"), F.col("block"))
    return dealt.mapInArrow(search, schema)


def _before(column: str, kind: Callable[[str], Column], keys: list[str], order: str, empty: int) -> Column:
    """Exclusive prefix scan."""
    rows = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(kind(column).over(rows), F.lit(empty).cast("long"))


def scan_token_files(
    files: DataFrame, separator: int, dtype: str = "<u2", block: int = BLOCK
) -> DataFrame:
    """Documents of flat token files: ``file, ordinal, start, n_tokens, terminated``.

    ``files(file, n_bytes)`` names the files. ``start`` is the place of the first
    id, ``n_tokens`` leaves out the separator. Two separators in a row hold an
    empty document between them. Ids after the last separator are one more
    document with ``terminated`` false. An empty file has no document; a file that
    is no whole number of ids long is an error; a null ``n_bytes`` is no file.
    """
    blocks = stored(_blocks(files, separator, dtype, block), "token-blocks")
    narrow = blocks.select("file", "chunk", "block", "n_ids", "n_found", "last")
    chunks = narrow.groupBy("file", "chunk").agg(
        F.sum("n_found").alias("n_found"), F.max("last").alias("last")
    )
    base = chunks.select(
        "file",
        "chunk",
        _before("n_found", F.sum, ["file"], "chunk", 0).alias("chunk_count"),
        _before("last", F.max, ["file"], "chunk", -1).alias("chunk_last"),
    )
    within = narrow.select(
        "file",
        "chunk",
        "block",
        _before("n_found", F.sum, ["file", "chunk"], "block", 0).alias("count"),
        _before("last", F.max, ["file", "chunk"], "block", -1).alias("carry"),
    )
    prefix = within.join(base, ["file", "chunk"]).select(
        "file",
        "block",
        (F.col("count") + F.col("chunk_count")).alias("count"),
        F.greatest("carry", "chunk_last").alias("carry"),
    )
    ends = blocks.where("n_found > 0").select("file", "block", "found").join(prefix, ["file", "block"])
    firsts = F.concat(F.array("carry"), F.expr("slice(found, 1, size(found) - 1)"))
    complete = ends.select(
        "file", "count", F.posexplode(F.arrays_zip(F.col("found").alias("end"), firsts.alias("begin")))
    ).select(
        "file",
        (F.col("count") + F.col("pos")).alias("ordinal"),
        (F.col("col.begin") + 1).alias("start"),
        (F.col("col.end") - F.col("col.begin") - 1).alias("n_tokens"),
        F.lit(True).alias("terminated"),
    )
    totals = narrow.groupBy("file").agg(
        F.sum("n_ids").alias("n_ids"), F.sum("n_found").alias("ordinal"), F.max("last").alias("last")
    )
    rest = totals.where("last < n_ids - 1").select(
        "file",
        "ordinal",
        (F.col("last") + 1).alias("start"),
        (F.col("n_ids") - F.col("last") - 1).alias("n_tokens"),
        F.lit(False).alias("terminated"),
    )
    return complete.unionByName(rest)


def token_counts(docs: DataFrame, tokenizer: str, separator: int) -> DataFrame:
    """``doc_id, n_tokens`` of every row, counted in the flat files written for it."""
    written = write_token_files(docs, tokenizer, separator)
    files = written.where("ordinal < 0").select("file", "n_bytes")
    places = written.where("ordinal >= 0").select("file", "ordinal", "doc_id")
    found = scan_token_files(files, separator).select("file", "ordinal", "n_tokens")
    return places.join(found, ["file", "ordinal"]).select("doc_id", "n_tokens")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # Id 50256 is free in this vocabulary.
    return token_counts(docs, tokenizer_path("byte_bpe_multi_50k.tiktoken"), separator=50256)
