"""WARC bundles (operator 3): seekable Zstandard archives of page records.

Records are grouped into frames of about FRAME bytes that decompress independently. A bundle is a file of
such frames followed by the seekable format's footer: one skippable frame that holds the compressed and
decompressed size of every frame. The index maps each record identifier to its bundle, its frame and its
offset within the frame's decompressed bytes, so one record costs reading one frame.

Payloads are html in UTF-8. Of equal payloads of at least min_bytes bytes, the page with the smallest id is
a response and the others revisit it; equality is decided by SHA-256 and length. Each writing task names its
files by its own attempt; only files named in the committed index count, so a repeated task does no harm.

Bundles go through pyarrow's file systems, so the folder's URI may be of any of them (file, hdfs, s3).

Defined cases. Null html: an empty payload. Equal empty payloads revisit each other too where min_bytes is 0.
Null url: the record has no target. Null page_id: always a response, and nothing to
refer to; its record has an identifier of its own, made of its bundle and place. Repeated rows (one id, one payload): each
is written; the copies are responses. A block that does not have the length and digest of its headers: an error. Empty table: no
bundles, no rows. Further columns are ignored. Payloads are never cut.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm.scratch import bounded_batches, new_path

FRAME, BUNDLE = 1 << 20, 64 << 20
#: Fixed values of the seekable format.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "record_id string, page_id long, bundle string, frame int, frame_at long, frame_size long, raw_size long, offset int, length int"
READ = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, place: str | None = None) -> str:
    """The identifier of a page's record, or of a record without a page at a place."""
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page_id}" if page_id is not None else f"none:{place}")
    return f"urn:uuid:{name}"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, name: str | None = None) -> bytes:
    """One WARC/1.1 record; a revisit has no block and names the response that has it."""
    revisit = refers_to is not None
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{name or record_id(page_id, url)}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha1:{base32_sha1(payload)}",
        f"X-Payload-Length: {len(payload)}",
        *([f"X-Page-ID: {page_id}"] if page_id is not None else []),
        *([f"WARC-Target-URI: {url.encode('unicode_escape').decode()}"] if url is not None else []),
        *([f"WARC-Refers-To: <{record_id(refers_to)}>", f"X-Refers-To-Page: {refers_to}", f"WARC-Profile: {PROFILE}"] if revisit else ["Content-Type: text/html; charset=utf-8"]),
        f"Content-Length: {0 if revisit else len(payload)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + (b"" if revisit else payload) + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and block of the record that data begins with."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC/1.1 record")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    return fields, rest[: int(fields["Content-Length"])]


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """The footer: (compressed, decompressed) sizes of all frames, without checksums."""
    body = b"".join(struct.pack("<II", *x) for x in sizes) + struct.pack("<IBI", len(sizes), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(tail: bytes) -> list[tuple[int, int]]:
    """Sizes from the end of a bundle."""
    n, flags, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    width = 12 if flags & 0x80 else 8
    start = len(tail) - 9 - n * width
    return [struct.unpack_from("<II", tail, start + i * width) for i in range(n)]


class Bundle:
    """Writes one bundle: frames as they fill, the seek table at the end."""

    def __init__(self, fs: pafs.FileSystem, path: str, uri: str) -> None:
        self.fs, self.path, self.uri = fs, path, uri
        self.out = fs.open_output_stream(f"{path}.part")
        self.press = zstandard.ZstdCompressor(level=3)
        self.sizes: list[tuple[int, int]] = []
        self.at = self.filled = 0
        self.parts: list[bytes] = []
        self.entries: list[tuple] = []

    def add(self, page_id: int | None, name: str, data: bytes) -> list[tuple]:
        self.entries.append((name, page_id, self.filled, len(data)))
        self.parts.append(data)
        self.filled += len(data)
        return self.flush() if self.filled >= FRAME else []

    def flush(self) -> list[tuple]:
        """Ends the frame; the index rows of its records."""
        if not self.parts:
            return []
        packed = self.press.compress(b"".join(self.parts))
        rows = [(name, page, self.uri, len(self.sizes), self.at, len(packed), self.filled, offset, length) for name, page, offset, length in self.entries]
        self.out.write(packed)
        self.sizes.append((len(packed), self.filled))
        self.at += len(packed)
        self.filled, self.parts, self.entries = 0, [], []
        return rows

    def close(self) -> list[tuple]:
        rows = self.flush()
        self.out.write(seek_table(self.sizes))
        self.out.close()
        self.fs.move(f"{self.path}.part", self.path)
        return rows


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [x.split()[0] for x in INDEX.split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32()}
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[x.split()[1]]) for i, x in enumerate(INDEX.split(", "))], names)


def referred(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, refers_to: the smallest page_id with the same payload, where it is another page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").alias("url"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("size", F.length("payload")).withColumn("same", F.sha2("payload", 256))
    first = rows.where((F.col("size") >= min_bytes) & F.col("page_id").isNotNull()).groupBy("same", "size").agg(F.min("page_id").alias("least"), F.count("*").alias("times"))
    others = first.where("times > 1").select(F.col("same").alias("k"), F.col("size").alias("s"), "least")
    # copies of one payload are dealt by page, not by payload: the few that have copies are found by a join of ids and digests only
    keys = rows.select("page_id", "same", "size").join(others, (F.col("same") == F.col("k")) & (F.col("size") == F.col("s")))
    links = keys.where("page_id > least").select(F.col("page_id").alias("p"), F.col("same").alias("k"), "least").distinct()
    return rows.join(links, (F.col("page_id") == F.col("p")) & (F.col("same") == F.col("k")), "left").select("page_id", "url", "payload", F.col("least").alias("refers_to"))


def write(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Writes bundles of all pages into folder (a URI) and an index table beside them; returns the index."""
    spark = pages.sparkSession
    bounded_batches(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pafs.FileSystem.from_uri(folder)
        fs.create_dir(path, recursive=True)
        task, bundle, serial = TaskContext.get(), None, 0
        for batch in batches:
            rows: list[tuple] = []
            for page, url, payload, to in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to")), strict=True):
                page, url, to = page.as_py(), url.as_py(), to.as_py()
                if bundle is None:
                    name = f"pages-{task.partitionId():05d}-{task.taskAttemptId()}-{serial}.warc.zst"
                    bundle, serial = Bundle(fs, f"{path}/{name}", f"{folder}/{name}"), serial + 1
                own = record_id(page, f"{bundle.uri}:{len(bundle.sizes)}:{bundle.filled}")
                rows += bundle.add(page, own, record(page, url, payload.as_py(), to, own))
                if bundle.at >= BUNDLE:
                    rows += bundle.close()
                    bundle = None
            if rows:
                yield _index_batch(rows)
        if bundle is not None:
            yield _index_batch(bundle.close())

    index = f"{folder}/index"
    referred(pages, min_bytes).mapInArrow(run, INDEX).write.parquet(index)
    return spark.read.schema(INDEX).parquet(index)


def _range(fs: pafs.FileSystem, path: str, at: int, size: int) -> bytes:
    with fs.open_input_file(path) as f:
        f.seek(at)
        return f.read(size)


def read(index: DataFrame) -> DataFrame:
    """READ rows of every indexed record, frame by frame. A response's size and digest are those of the block that was read,
    which must be those of its headers; a revisit has no block, its payload is null and its headers tell of the full payload."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        un = zstandard.ZstdDecompressor()
        for batch in batches:
            for uri, at, size, raw, places in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame_at", "frame_size", "raw_size", "places")), strict=True):
                fs, path = pafs.FileSystem.from_uri(uri)
                data = un.decompress(_range(fs, path, at, size), max_output_size=raw)
                rows = []
                for place in places:
                    f, block = parse(data[place["offset"] : place["offset"] + place["length"]])
                    revisit = f["WARC-Type"] == "revisit"
                    page, to, url = f.get("X-Page-ID"), f.get("X-Refers-To-Page"), f.get("WARC-Target-URI")
                    size, digest = int(f["X-Payload-Length"]), f["WARC-Payload-Digest"].removeprefix("sha1:")
                    if not revisit:
                        told, size, digest = (size, digest), len(block), base32_sha1(block)
                        if told != (size, digest):
                            raise ValueError(f"{f['WARC-Record-ID']}: the block is not what its headers say")
                    rows.append((page and int(page), size, digest, f["WARC-Type"], to and int(to), url and url.encode().decode("unicode_escape"), None if revisit else block))
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], [x.split()[0] for x in READ.split(", ")])

    frames = index.groupBy("bundle", "frame", "frame_at", "frame_size", "raw_size").agg(F.collect_list(F.struct("offset", "length")).alias("places"))  # a frame's records: bounded by FRAME
    return frames.mapInArrow(run, READ)


def seek(index: DataFrame, name: str) -> tuple[dict[str, str], bytes] | None:
    """One record by its identifier: one index row, one frame."""
    found = index.where(F.col("record_id") == name).take(1)
    if not found:
        return None
    x = found[0]
    fs, path = pafs.FileSystem.from_uri(x["bundle"])
    data = zstandard.ZstdDecompressor().decompress(_range(fs, path, x["frame_at"], x["frame_size"]), max_output_size=x["raw_size"])
    return parse(data[x["offset"] : x["offset"] + x["length"]])


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = write(spark.read.parquet(f"{sf_dir}/pages.parquet"), new_path(spark, "warc"))
    return read(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP3_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS hex FROM pages),
bits AS (SELECT page_id, h, hex, array_to_string(list_transform(range(0, 40), lambda i: ('0000000100100011010001010110011110001001101010111100110111101111')[4 * ('0x' || hex[i + 1])::INT + 1 : 4 * ('0x' || hex[i + 1])::INT + 4]), '') AS b FROM p),
named AS (SELECT page_id, h, array_to_string(list_transform(range(0, 32), lambda i: ('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567')[
  1 + 16 * b[5 * i + 1]::INT + 8 * b[5 * i + 2]::INT + 4 * b[5 * i + 3]::INT + 2 * b[5 * i + 4]::INT + b[5 * i + 5]::INT]), '') AS d,
  min(page_id) OVER (PARTITION BY h) AS least FROM bits)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, d AS payload_digest, CASE WHEN page_id = least THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = least THEN NULL ELSE least END AS refers_to FROM named
"""
