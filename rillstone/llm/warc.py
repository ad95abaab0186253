"""WARC archives in seekable Zstandard bundles (operator 6).

Each task groups its records into frames that decompress alone, appends the frames to bundle files, and ends a file
with the seek table of the seekable format (a skippable frame), so that any reader finds frame k by the last bytes. The
index maps a record to bundle, frame and offset in the frame: one ranged read and one decompression give it back.

Records of equal payloads of at least ``least`` bytes: that of the smallest page id is the response, the others are
revisits that refer to it and hold no payload.

Recovery: a bundle's name has the task attempt in it, it is moved into place once complete, and only bundles that the
written index names belong to the archive: a repeated task leaves nothing double.

Results: one record per row. A null payload is empty. Rows of equal page id and payload are all responses if the id is
the smallest. A null page id never is the response of others; it is kept as null. A null address is left out of the
headers. Empty tables give an archive without bundles.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from hashlib import sha256
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillstone.llm.common import bound_batches, materialize

FRAME_BYTES, BUNDLE_BYTES = 1 << 18, 1 << 24
#: Repeated digests that may be broadcast (about 100 bytes each); more are joined by a shuffle.
BROADCAST_DIGESTS = 100_000
#: Fixed values of the seekable format: magic numbers of the table's skippable frame and of its footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id {kind}, bundle string, frame int, offset long, length long"


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The table of frames (compressed, decompressed bytes) as the file's last, skippable frame."""
    entries = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(entries)) + entries


def read_seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """Start, compressed and decompressed bytes of every frame."""
    size = file.size()
    n, flags, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE or flags & 0x7F:
        raise ValueError("the file has no seek table of the known kind")
    width = 12 if flags & 0x80 else 8
    table, out, at = file.read_at(n * width, size - 9 - n * width), [], 0
    for k in range(n):
        packed, whole = struct.unpack_from("<II", table, k * width)
        out.append((at, packed, whole))
        at += packed
    return out


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One WARC record with its trailing blank lines."""
    name = "<urn:page:{}>".format
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name('none' if page_id is None else page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: {name(refers_to)}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, bytes, int]:
    """Headers, HTTP head and payload of the record at ``at``, and where the next begins."""
    end = data.index(b"\r\n\r\n", at)
    first, *lines = data[at:end].decode().split("\r\n")
    head = dict(line.split(": ", 1) for line in lines)
    if not first.startswith("WARC/") or "Content-Length" not in head:
        raise ValueError("no WARC record stands here")
    stop = end + 4 + int(head["Content-Length"])
    block = data[end + 4 : stop]
    body = block.index(b"\r\n\r\n") + 4
    return head, block[:body], block[body:], stop + 4


def _number(name: str) -> int | None:
    text = name.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "none" else int(text)


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


class _Bundles:
    """Writer of one task's bundles."""

    def __init__(self, path: str, frame_bytes: int, bundle_bytes: int) -> None:
        self.fs, self.dir = _open(path)
        self.fs.create_dir(self.dir, recursive=True)
        context = TaskContext.get()
        self.stem = f"part-{context.partitionId():05d}-{context.taskAttemptId()}"
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.pack = zstandard.ZstdCompressor(level=3).compress
        self.count, self.file = 0, None
        self.held: list[bytes] = []
        self.size = 0

    def add(self, data: bytes) -> tuple[str, int, int]:
        """Bundle, frame and offset of a record."""
        if self.file is None:
            self.name = f"{self.stem}-{self.count:04d}.warc.zst"
            self.file, self.frames = self.fs.open_output_stream(f"{self.dir}/.{self.name}", compression=None), []
        place = (self.name, len(self.frames), self.size)
        self.held.append(data)
        self.size += len(data)
        if self.size >= self.frame_bytes:
            self._frame()
            if self.file.tell() >= self.bundle_bytes:
                self.close()
        return place

    def _frame(self) -> None:
        packed = self.pack(b"".join(self.held))
        self.frames.append((len(packed), self.size))
        self.file.write(packed)
        self.held, self.size = [], 0

    def close(self) -> None:
        if self.file is not None:
            if self.held:
                self._frame()
            self.file.write(seek_table(self.frames))
            self.file.close()
            self.fs.move(f"{self.dir}/.{self.name}", f"{self.dir}/{self.name}")
            self.file, self.count = None, self.count + 1


def write_archive(pages: DataFrame, path: str, least: int = 100, date: str = "2024-01-01T00:00:00Z", frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write one record per row below ``path`` (bundles/ and index/) and return the index.

    Only ids and digests are grouped. Repeats join the pages by broadcast while they are few, else by a shuffle that
    adaptive execution may split where one payload has many rows.
    """
    spark = pages.sparkSession
    bound_batches(spark)
    body = F.coalesce(F.col(payload_col), F.lit(""))
    slim = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), body.cast("binary").alias("payload"), F.sha2(body.cast("binary"), 256).alias("digest"))
    repeated = slim.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    repeated = materialize(repeated, "repeated-payloads")
    few = repeated.count() <= BROADCAST_DIGESTS
    marked = slim.join(F.broadcast(repeated) if few else repeated, "digest", "left")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") > F.col("first")), F.col("first"))
    marked = marked.select("page_id", "url", F.when(refers.isNull(), F.col("payload")).alias("payload"), F.octet_length("payload").alias("n"), "digest", refers.alias("refers_to"))
    kind = slim.schema["page_id"].dataType.simpleString()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Bundles(f"{path}/bundles", frame_bytes, bundle_bytes)
        for batch in batches:
            rows = []
            for page, url, payload, n, digest, refers_to in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "n", "digest", "refers_to")), strict=True):
                refers_to, body = refers_to.as_py(), payload.as_py()
                data = record(page.as_py(), url.as_py(), body, digest.as_py(), None, date) if refers_to is None else _revisit(page.as_py(), url.as_py(), n.as_py(), digest.as_py(), refers_to, date)
                rows.append((*out.add(data), len(data)))
            bundle, frame, offset, length = zip(*rows, strict=True) if rows else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), pa.array(bundle, pa.string()), pa.array(frame, pa.int32()), pa.array(offset, pa.int64()), pa.array(length, pa.int64())], names=["page_id", "bundle", "frame", "offset", "length"])
        out.close()

    marked.mapInArrow(write, INDEX.format(kind=kind)).write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def _revisit(page_id: int | None, url: str | None, n: int, digest: str, refers_to: int, date: str) -> bytes:
    """A revisit record; its HTTP head keeps the length of the payload it leaves out."""
    data = record(page_id, url, b"", digest, refers_to, date)
    zero, real = b"Content-Length: 0\r\n\r\n", b"Content-Length: %d\r\n\r\n" % n
    head, block = data.split(b"\r\n\r\n", 1)
    block = block.replace(zero, real, 1)
    lines = head.rsplit(b"\r\n", 1)[0]
    return lines + b"\r\nContent-Length: %d\r\n\r\n" % (len(block) - 4) + block


def _rows(data: bytes, at: int, with_payload: bool, stop: int | None = None) -> Iterator[tuple]:
    while at < (len(data) if stop is None else stop):
        head, http, payload, at = parse(data, at)
        response = head["WARC-Type"] == "response"
        n = int(http.rsplit(b"Content-Length: ", 1)[1].split(b"\r\n", 1)[0])
        digest = head["WARC-Payload-Digest"].removeprefix("sha256:")
        if response and (len(payload) != n or sha256(payload).hexdigest() != digest):
            raise ValueError(f"the payload of {head['WARC-Record-ID']} is damaged")
        refers = None if response else _number(head["WARC-Refers-To"])
        yield _number(head["WARC-Record-ID"]), head["WARC-Type"], refers, digest, n, payload if response and with_payload else None


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    types = {"page_id": kind, "record_type": pa.string(), "refers_to": kind, "payload_digest": pa.string(), "payload_bytes": pa.int64(), "payload": pa.binary()}
    columns = zip(*rows, strict=True) if rows else [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types.values(), strict=True)], names=list(types))


def _schema(index: DataFrame) -> tuple[str, pa.DataType]:
    kind = index.schema["page_id"].dataType.simpleString()
    return f"page_id {kind}, record_type string, refers_to {kind}, payload_digest string, payload_bytes long, payload binary", pa.int32() if kind == "int" else pa.int64()


def read_archive(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records, a bundle at a time and a frame at a time; each response's payload is checked against its digest."""
    index = spark.read.parquet(f"{path}/index")
    schema, kind = _schema(index)
    names = index.select("bundle").distinct()
    n = names.count()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = _open(f"{path}/bundles")
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for name in batch.column("bundle").to_pylist():
                with fs.open_input_file(f"{where}/{name}") as file:
                    for at, packed, whole in read_seek_table(file):
                        yield _batch(list(_rows(unpack.decompress(file.read_at(packed, at), max_output_size=whole), 0, with_payload)), kind)

    return names.repartition(max(1, min(n, 10_000))).mapInArrow(read, schema)


def lookup(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records of the ``page_id``s in ``wanted``: only their frames are read and decompressed."""
    index = spark.read.parquet(f"{path}/index")
    schema, kind = _schema(index)
    found = index.join(wanted.select("page_id").distinct(), "page_id", "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, where = _open(f"{path}/bundles")
        unpack = zstandard.ZstdDecompressor()
        name, table, file, last = None, [], None, None
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                if r["bundle"] != name:
                    name, last = r["bundle"], None
                    file = fs.open_input_file(f"{where}/{name}")
                    table = read_seek_table(file)
                if r["frame"] != last:
                    last = r["frame"]
                    at, packed, whole = table[last]
                    data = unpack.decompress(file.read_at(packed, at), max_output_size=whole)
                rows += _rows(data, r["offset"], True, r["offset"] + r["length"])
            yield _batch(rows, kind)

    return found.repartition("bundle").sortWithinPartitions("bundle", "frame", "offset").mapInArrow(read, schema)
