"""WARC records in seekable Zstandard bundles, and an index from record to frame and offset.

A bundle is one file: independent Zstandard frames, each of whole records up to about FRAME_BYTES, then the seek table
of Zstandard's seekable format in a skippable frame. Any Zstandard reader decodes a bundle from start to end; a reader
that knows the seek table decodes one frame. Executors write bundles through Spark's text writer, one value a file:
its line separator is the four bytes of the seek table's magic number, which end the file as the format asks. So
bundles go wherever Spark can write, under its commit protocol, and a lost executor leaves no half file.

Of records with equal payloads of at least `least_bytes` bytes, the one with the smallest id is a response and the
others are revisit records that refer to it.

Defined results: a null payload is empty; a null id is larger than any other; rows that repeat the response's id with
its payload are responses too; a null address has no target; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from helixframe.llm.common import lookup, scratch, slices, written

FRAME_BYTES, BUNDLE_BYTES, LEVEL = 256 << 10, 4 << 20, 3
DATE = "1970-01-01T00:00:00Z"
#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
SEPARATOR, ENCODING = struct.pack("<I", SEEKABLE).decode("latin-1"), "ISO-8859-1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CRLF = b"\r\n"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def uri(record_id: int | None) -> str:
    return f"<urn:x-page:{'null' if record_id is None else record_id}>"


def from_uri(value: str) -> int | None:
    name = value.removeprefix("<urn:x-page:").rstrip(">")
    return None if name == "null" else int(name)


def record(kind: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), *fields, ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + CRLF + block + CRLF + CRLF


def page_record(page_id: int | None, url: str | None, payload: bytes, first: int | None) -> bytes:
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    fields = [("WARC-Record-ID", uri(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", quote(url, safe="/:?#[]@!$&'()*+,;=%~")))
    fields += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{base32_sha1(payload)}")]
    if first is None or first == page_id:
        return record("response", fields, http + payload)
    fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", uri(first)), ("WARC-Truncated", "length"), ("X-Payload-Length", str(len(payload)))]
    return record("revisit", fields, http)


class Bundle:
    """Frames so far, and the seek table's entries."""

    def __init__(self, name: str, level: int) -> None:
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frames: list[bytes] = []
        self.entries: list[tuple[int, int, int]] = []
        self.open: list[bytes] = [record("warcinfo", [("WARC-Record-ID", f"<urn:x-bundle:{name}>"), ("WARC-Date", DATE), ("WARC-Filename", f"{name}.warc.zst"), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")]
        self.size = self.packed = 0

    def add(self, data: bytes, most: int) -> None:
        if self.open and self.size + len(data) > most:
            self.flush()
        self.open.append(data)
        self.size += len(data)

    def flush(self) -> None:
        if data := b"".join(self.open):
            frame = self.packer.compress(data)
            self.frames.append(frame)
            self.entries.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
            self.packed += len(frame)
        self.open, self.size = [], 0

    def close(self) -> bytes:
        """The whole file but for the last four bytes, which the writer adds."""
        self.flush()
        body = b"".join(struct.pack("<III", *e) for e in self.entries) + struct.pack("<IB", len(self.entries), CHECKSUMS)
        return b"".join(self.frames) + struct.pack("<II", SKIPPABLE, len(body) + 4) + body


def seek_table(bundle: bytes) -> list[tuple[int, int, int, int]]:
    """(offset, compressed size, size, checksum) of each frame, from the end of the file."""
    if len(bundle) < 17 or struct.unpack("<I", bundle[-4:])[0] != SEEKABLE:
        raise ValueError("no seek table")
    n, kind = struct.unpack("<IB", bundle[-9:-4])
    width = 12 if kind & CHECKSUMS else 8
    at = len(bundle) - 9 - n * width
    if at < 8 or struct.unpack("<II", bundle[at - 8 : at]) != (SKIPPABLE, n * width + 9):
        raise ValueError("broken seek table")
    out, offset = [], 0
    for k in range(n):
        packed, size, *check = struct.unpack("<III" if width == 12 else "<II", bundle[at + k * width : at + (k + 1) * width])
        out.append((offset, packed, size, check[0] if check else -1))
        offset += packed
    return out


def frame(bundle: bytes, entry: tuple[int, int, int, int]) -> bytes:
    offset, packed, size, check = entry
    data = zstandard.ZstdDecompressor().decompress(bundle[offset : offset + packed], max_output_size=size)
    if len(data) != size or check >= 0 and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
        raise ValueError("broken frame")
    return data


def records(data: bytes) -> Iterator[tuple[int, int, dict[str, str], bytes]]:
    """(offset, length, fields, block) of each record in a frame's bytes."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if not first.startswith("WARC/"):
            raise ValueError("no record")
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        yield at, end + 8 + size - at, fields, data[end + 4 : end + 4 + size]
        at = end + 8 + size


def write_bundles(pages: DataFrame, path: str, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least_bytes: int = 0, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES, level: int = LEVEL) -> None:
    """Writes every row of pages as a record into bundles below path."""
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1("payload")))
    found = rows.filter(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    rows = lookup(rows, written(found, "warc-repeated"), "digest", "n").select("id", "url", "payload", "first")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, k = TaskContext.get().partitionId(), 0
        bundle = None
        for part in slices(batches, "payload"):
            for row in zip(*(part.column(c).to_pylist() for c in ("id", "url", "payload", "first")), strict=True):
                bundle = bundle or Bundle(f"bundle-{task:06d}-{k:06d}", level)
                bundle.add(page_record(*row), frame_bytes)
                if bundle.packed >= bundle_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([bundle.close()], pa.binary())], names=["value"])
                    bundle, k = None, k + 1
        if bundle:
            yield pa.RecordBatch.from_arrays([pa.array([bundle.close()], pa.binary())], names=["value"])

    files = rows.mapInArrow(step, "value binary").select(F.col("value").cast("string").alias("value"))
    files.write.option("maxRecordsPerFile", 1).option("encoding", ENCODING).option("lineSep", SEPARATOR).text(path)


INDEX = "id long, record_type string, payload_bytes long, payload_digest string, refers_to long, url string, bundle string, frame long, frame_start long, frame_bytes long, record_start long, record_bytes long"


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """One row for each page record below path, read from the bundles: what it is, and where it is.

    frame_start is the frame's offset in the file `bundle`; record_start is the record's offset in the frame's bytes.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
                data = data.as_py()
                for number, entry in enumerate(seek_table(data)):
                    rows = []
                    for start, size, fields, block in records(frame(data, entry)):
                        kind = fields["WARC-Type"]
                        if kind not in ("response", "revisit"):
                            continue
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        if kind == "response":
                            payload = block[block.index(b"\r\n\r\n") + 4 :]
                            if base32_sha1(payload) != digest:
                                raise ValueError("broken payload")
                            length, refers = len(payload), None
                        else:
                            length, refers = int(fields["X-Payload-Length"]), from_uri(fields["WARC-Refers-To"])
                        rows.append({"id": from_uri(fields["WARC-Record-ID"]), "record_type": kind, "payload_bytes": length, "payload_digest": digest, "refers_to": refers, "url": fields.get("WARC-Target-URI"), "bundle": name.rpartition("/")[2], "frame": number, "frame_start": entry[0], "frame_bytes": entry[1], "record_start": start, "record_bytes": size})
                    if rows:
                        yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    return bundles(spark, path).mapInArrow(step, INDEX)


SCHEMA = pa.schema([(x.split()[0], pa.string() if x.endswith("string") else pa.int64()) for x in INDEX.split(", ")])


def bundles(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("path", "content")


def fetch(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """id and payload of the responses in `wanted`, rows of the index: only their frames are decoded."""
    keys = wanted.filter("record_type = 'response'").groupBy("bundle").agg(F.collect_list(F.struct("frame", "record_start", "id")).alias("at"))
    files = bundles(spark, path).withColumn("bundle", F.element_at(F.split("path", "/"), -1))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, at in zip(batch.column("content"), batch.column("at").to_pylist(), strict=True):
                data = data.as_py()
                table = seek_table(data)
                for number in sorted({x["frame"] for x in at}):
                    ids = {x["record_start"] for x in at if x["frame"] == number}
                    rows = [(from_uri(f["WARC-Record-ID"]), b[b.index(b"\r\n\r\n") + 4 :]) for start, _, f, b in records(frame(data, table[number])) if start in ids]
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["id", "payload"])

    return files.join(keys, "bundle").select("content", "at").mapInArrow(step, "id long, payload binary")


def archived(pages: DataFrame, **options) -> DataFrame:
    """The index of pages, written into bundles in the shared folder and read back."""
    path = scratch(pages.sparkSession, "warc")
    write_bundles(pages, path, **options)
    return read_index(pages.sparkSession, path)
