"""WARC archives with a Zstandard dictionary: a writer, a reader, and deduplication by payload digest.

A file begins with a skippable frame (magic 0x184D2A5D) that holds the dictionary; then each record is a
frame of its own, so a record can be read alone. The dictionary is trained on about SAMPLE_ROWS
records drawn from the whole table, the first SAMPLE_CHARS of each payload and SAMPLE_BYTES in all (which
bounds what is learned from, not what is written); where they are too few or too alike to train on, the
file has no dictionary frame. Of records with equal payloads the one with the smallest page_id is the response, the
others are revisits that refer to it and repeat its HTTP header with the full length, without payload.

Tasks write files to a folder all executors share, under names of their own that are never reused, and
hand on the paths; a task that ran twice leaves a file that no path refers to. Archives roll over at
FILE_BYTES. The reader gets paths and streams each file.

Cases: a null html is an empty payload, archived like any other; a null url is an empty target; a null
page_id loses against any other; rows with equal payload and page_id (repeated rows) are all responses;
an empty table writes no archive and gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import io
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimweave.llm.common import shared_folder, stored

SKIPPABLE = 0x184D2A5D
FILE_BYTES = 32 << 20
DICT_BYTES = 64 << 10
SAMPLE_ROWS = 2_000
SAMPLE_BYTES = 16 << 20
SAMPLE_CHARS = 16 << 10
#: Bytes of archives that a task reads back.
READ_BYTES = 256 << 20
#: Names that Spark's file systems have for schemes of pyarrow's.
SCHEMES = {"s3a": "s3", "s3n": "s3"}
#: Fixed value: the date of records, so that archives don't depend on the clock.
DATE = "2024-01-01T00:00:00Z"
#: Payloads written more than once are broadcast up to this number of them, at about 100 bytes each.
BROADCAST_DIGESTS = 100_000
SALTS = 16


def with_originals(pages: DataFrame) -> DataFrame:
    """page_id, url, payload and `original`: the smallest page_id with that payload."""
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    shared = (
        pages.select("page_id", F.sha1(payload).alias("h"))
        .groupBy("h")
        .agg(F.min("page_id").alias("original"), F.count("*").alias("n"))
        .where("n > 1")
        .select("h", "original")
    )
    shared = stored(shared, "warc-copies")
    if shared.count() <= BROADCAST_DIGESTS:
        joined = rows.join(F.broadcast(shared), F.col("sha1") == F.col("h"), "left")
    else:  # a hot payload's rows are spread over SALTS tasks
        salted = shared.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS))
        joined = rows.join(salted, (F.col("sha1") == F.col("h")) & (salt == F.col("s")), "left")
    return joined.select("page_id", "url", "payload", F.coalesce("original", "page_id").alias("original"))


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _name(page) -> str:
    return "null" if page is None else f"id:{quote(str(page), safe='')}"


def record(page, url: str | None, payload: bytes, original) -> bytes:
    """One WARC record, a response if `original` is the page itself."""
    revisit = original != page
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if revisit else payload)
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{_name(page)}>",
        f"WARC-Target-URI: {quote(url or '', safe=':/?#[]@!$&()*+,;=%~')}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
    ]
    if revisit:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{_name(original)}>",
        ]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(pages: DataFrame, size: int = DICT_BYTES) -> bytes:
    """A dictionary from a bounded sample of the pages, equal payloads once; empty if none can be made of them.

    Every row is drawn at the same rate, so nothing is shuffled; the driver gets the drawn rows, their payloads cut.
    """
    share = min(1.0, SAMPLE_ROWS / max(1, pages.count()))
    drawn = pages.sample(share, seed=9).select("page_id", "url", F.substring("html", 1, SAMPLE_CHARS).alias("html"))
    total = 0
    samples, seen = [], set()
    for r in drawn.collect():
        if total >= SAMPLE_BYTES:
            break
        html = r["html"] or ""
        if html not in seen:
            seen.add(html)
            samples.append(record(r["page_id"], r["url"], html.encode(), r["page_id"]))
            total += len(samples[-1])
    try:
        # A dictionary wants several times its size of samples.
        return zstandard.train_dictionary(min(size, total // 8), samples).as_bytes() if len(samples) >= 8 else b""
    except zstandard.ZstdError:
        return b""


def _open(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    scheme, _, rest = folder.partition(":")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def write_archives(rows: DataFrame, folder: str, dictionary: bytes, level: int = 3) -> DataFrame:
    """Write the records of `with_originals`; a row for each archive: path, records, bytes.

    Running the result writes; store it before using it twice.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
        packer = zstandard.ZstdCompressor(level=level, **options)
        head = struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary if dictionary else b""
        files, _ = _open(folder)
        out, path, size, n = None, "", 0, 0

        def closed():
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "records": [n], "bytes": [size]})

        for batch in batches:
            columns = [batch.column(i) for i in range(4)]
            for i in range(batch.num_rows):
                if out is None:
                    path, size, n = f"{folder}/{uuid.uuid4().hex}.warc.zst", len(head), 0
                    out = files.open_output_stream(_open(path)[1], compression=None)
                    out.write(head)
                page, url, payload, original = (c[i].as_py() for c in columns)
                frame = packer.compress(record(page, url, payload, original))
                out.write(frame)
                size, n = size + len(frame), n + 1
                if size >= FILE_BYTES:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    ordered = rows.select("page_id", "url", "payload", "original")
    return ordered.mapInArrow(run, "path string, records long, bytes long")


def frames(data: io.BufferedIOBase, chunk: int = 1 << 16) -> Iterator[bytes]:
    """The records of an archive, one after another; the stream is read in chunks."""
    head = data.read(8)
    dictionary = b""
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIPPABLE:
        dictionary = data.read(struct.unpack("<I", head[4:])[0])
        head = b""
    options = {"dict_data": zstandard.ZstdCompressionDict(dictionary)} if dictionary else {}
    unpacker = zstandard.ZstdDecompressor(**options)
    rest = head
    while rest or (rest := data.read(chunk)):
        frame = unpacker.decompressobj()
        out = []
        while True:
            out.append(frame.decompress(rest))
            if frame.eof:
                rest = frame.unused_data
                break
            rest = data.read(chunk)
            if not rest:
                raise ValueError("the archive ends inside a record")
        yield b"".join(out)


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; its block digest is checked."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields["WARC-Block-Digest"] != f"sha1:{digest(block)}":
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    return fields, block


def _page(urn: str | None) -> str | None:
    name = urn and urn.removeprefix("<urn:page:").removesuffix(">")
    return unquote(name[3:]) if name and name != "null" else None


def read_archives(archives: DataFrame, with_payload: bool = True) -> DataFrame:
    """The records of archives (a column path): page_id and refers_to as text, url, type, digest, length, payload.

    The payload of a revisit is null; its length is that of its HTTP header.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                files, local = _open(path)
                rows: list[tuple] = []
                size = 0
                with files.open_input_stream(local, compression=None) as stream:
                    for raw in frames(stream):
                        fields, block = parse(raw)
                        http, _, payload = block.partition(b"\r\n\r\n")
                        length = int(http.rpartition(b"Content-Length: ")[2])
                        revisit = fields["WARC-Type"] == "revisit"
                        found = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if not revisit and (len(payload) != length or digest(payload) != found):
                            raise ValueError(f"damaged payload of {fields['WARC-Record-ID']}")
                        rows.append(
                            (
                                _page(fields["WARC-Record-ID"]),
                                unquote(fields["WARC-Target-URI"]),
                                fields["WARC-Type"],
                                found,
                                length,
                                _page(fields.get("WARC-Refers-To")),
                                None if revisit or not with_payload else payload,
                            )
                        )
                        size += len(raw) if with_payload else 0
                        if len(rows) >= 2_000 or size > 1 << 24:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    schema = (
        "page_id string, url string, record_type string, payload_digest string, payload_bytes long, "
        "refers_to string, payload binary"
    )
    return archives.select("path").mapInArrow(run, schema)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string()] * 4 + [pa.int64(), pa.string(), pa.binary()]
    names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names
    )


def archive_pages(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Write the pages to archives in a shared folder and give the table of archives."""
    spark: SparkSession = pages.sparkSession
    folder = (folder or f"{shared_folder(spark)}/llm/warc-{uuid.uuid4().hex}").rstrip("/")
    files, local = _open(folder)
    files.create_dir(local, recursive=True)
    rows = with_originals(pages)
    return stored(write_archives(rows, folder, train(pages)), "warc-index")


def archived(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to, as read back from the archives."""
    kind = pages.schema["page_id"].dataType
    index = archive_pages(pages)
    # A task for each core where archives are few, else one for READ_BYTES of them.
    sizes = index.agg(F.count("*").alias("n"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    tasks = max(pages.sparkSession.sparkContext.defaultParallelism, sizes["bytes"] // READ_BYTES)
    read = read_archives(index.repartition(max(1, min(sizes["n"], tasks))), with_payload=False)
    return read.select(
        F.col("page_id").cast(kind).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        F.col("refers_to").cast(kind).alias("refers_to"),
        "url",
    )
