"""WARC archives with a Zstandard dictionary of their own.

Each archive starts with a skippable frame that holds a dictionary built from the
archive's records; every record after it is a frame of its own, so a record can be
read alone with the dictionary. Pages with a payload seen before become revisit
records that name the first page with it.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crowdtape.llm.common import new_name, open_folder, stored, table
from crowdtape.session import shared_dir

#: Frame that carries a dictionary (a fixed value of the format).
DICTIONARY_FRAME = 0x184D2A5D
DICTIONARY_BYTES = 64 << 10
#: An archive is closed once it holds so many bytes before compression.
ARCHIVE_BYTES = 16 << 20
LEVEL = 3
#: Payloads below this size are never revisits.
LEAST_REVISIT = 0
DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FOUND = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, "
    "url string, payload binary"
)


# --- records ---------------------------------------------------------------------


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _page_urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page_of(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, revisit: bool, first: int | None) -> bytes:
    """One record: a response with its payload, or a revisit that names the first page with it."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _page_urn(page_id)),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{digest_of(payload)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
        ("X-Payload-Length", str(len(payload))),
    ]
    if url is not None:  # as base64, since urls may hold line breaks or be no valid URI
        fields.append(("X-Target-URI-Base64", base64.b64encode(url.encode()).decode()))
    if revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", _page_urn(first))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields)
    return b"WARC/1.1\r\n" + head.encode() + b"\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple:
    """Columns of ``FOUND``. The payload of a response is checked against its digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if version != "WARC/1.1":
        raise ValueError(f"no record: {version[:40]!r}")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    kind = fields["WARC-Type"]
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(fields["X-Payload-Length"])
    payload, refers_to = None, None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != size or digest_of(payload) != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    else:
        refers_to = _page_of(fields["WARC-Refers-To"])
    url = fields.get("X-Target-URI-Base64")
    url = None if url is None else base64.b64decode(url).decode()
    return _page_of(fields["WARC-Record-ID"]), size, digest, kind, refers_to, url, payload


def archive(records: list[bytes]) -> bytes:
    """A dictionary built from ``records`` in a skippable frame, then a frame per record."""
    import zstandard

    try:
        # ``k`` and ``d`` fixed: one pass over all records instead of a search for the best pair.
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, records, k=200, d=8, level=LEVEL)
    except zstandard.ZstdError:  # too few or too small records to build one from
        trained = None
    content = trained.as_bytes() if trained else b""
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained) if trained else zstandard.ZstdCompressor(level=LEVEL)
    packed = zstandard.ZstdCompressor(level=LEVEL).compress(content) if content else b""
    frames = [struct.pack("<II", DICTIONARY_FRAME, len(packed)), packed]
    return b"".join(frames + [compressor.compress(r) for r in records])


def read_archive(data: bytes) -> Iterator[bytes]:
    """Records of one archive."""
    import zstandard

    magic, size = struct.unpack("<II", data[:8])
    if magic != DICTIONARY_FRAME:
        raise ValueError("no dictionary frame at the start")
    content = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size]) if size else b""
    dictionary = zstandard.ZstdCompressionDict(content) if content else None
    reader = zstandard.ZstdDecompressor(dict_data=dictionary) if dictionary else zstandard.ZstdDecompressor()
    rest = memoryview(data)[8 + size :]
    while len(rest):
        step = reader.decompressobj()
        yield step.decompress(rest)
        rest = rest[len(rest) - len(step.unused_data) :]


# --- on Spark ----------------------------------------------------------------------


def _payload(name: str) -> Column:
    return F.coalesce(F.encode(F.col(name).cast("string"), "UTF-8"), F.lit(b""))


def write_archives(pages: DataFrame, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages(page_id, url, html)`` as archives; ``file, records, n_bytes`` of each.

    Of rows with equal payloads the smallest ``page_id`` is the response (all rows
    that repeat it too), the others revisit it. A null html is an empty payload, a
    null ``page_id`` comes before all others, a null url is left out. The table of
    files is written by the same job, so files of failed attempts are never read.
    """
    spark = pages.sparkSession
    folder = shared_dir(spark, "archives")
    rows = pages.select(
        F.col("page_id").cast("long"), F.col("url").cast("string"), _payload("html").alias("payload")
    ).withColumn("digest", F.sha1("payload"))
    # Whether there is a page without id, then the smallest id: nulls come first.
    firsts = rows.select("page_id", "digest").groupBy("digest").agg(
        F.min(F.struct(F.col("page_id").isNotNull().alias("known"), "page_id")).alias("first")
    )
    large = F.octet_length("payload") >= LEAST_REVISIT
    typed = rows.join(firsts, "digest").select(
        "page_id",
        "url",
        (large & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))).alias("revisit"),
        F.col("first.page_id").alias("first"),
        "payload",
    )

    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        files, root = open_folder(folder)
        files.create_dir(root, recursive=True)

        def close(records):
            name, data = new_name(".warc.zst"), archive(records)
            with files.open_output_stream(f"{root}/{name}") as out:
                out.write(data)
            columns = [pa.array([f"{folder}/{name}"]), pa.array([len(records)]), pa.array([len(data)])]
            return pa.RecordBatch.from_arrays(columns, ["file", "records", "n_bytes"])

        held, size = [], 0
        for batch in batches:
            for row in zip(*batch.columns, strict=True):
                page_id, url, revisit, first, payload = (v.as_py() for v in row)
                held.append(record(page_id, url, payload, revisit, first))
                size += len(held[-1])
                if size >= archive_bytes:
                    yield close(held)
                    held, size = [], 0
        if held:
            yield close(held)

    return stored(typed.mapInArrow(write, "file string, records bigint, n_bytes bigint"), "archive-files")


def read_archives(files: DataFrame, payloads: bool = True) -> DataFrame:
    """Records of the archives named in ``files(file)``: the columns of ``FOUND``.

    ``payload`` is null for revisits, and for all with ``payloads`` false.
    """

    def read(batches: Iterator) -> Iterator:
        import pyarrow as pa

        names = [part.split(" ")[0] for part in FOUND.split(", ")]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        for batch in batches:
            for file in batch.column(0).to_pylist():
                system, path = open_folder(file)
                with system.open_input_stream(path) as source:
                    data = source.read()
                rows = []
                for one in read_archive(data):
                    found = parse_record(one)
                    rows.append(found if payloads else (*found[:-1], None))
                columns = list(zip(*rows, strict=True)) or [[]] * len(names)
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    return files.select("file").repartition("file").mapInArrow(read, FOUND)


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    found = read_archives(files, payloads=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
