"""Substring dedup (operator 8): repeated windows of WINDOW words are removed.

Every window of WINDOW consecutive words of every text gets two Rabin-Karp hashes, of 64 and of 32 bits; windows are the
same if both agree. Texts are dealt by hash into chunks of bounded size (their number follows the input), each chunk packs
its window hashes by their leading bits, Spark brings the packs of one range together, and what occurs twice or more is
reported back to its chunk as one bit for each distinct hash. The chunk then merges its repeated windows into maximal
removal intervals. A hash that a chunk holds several times travels once, with a flag: a passage that stands
in a third of all texts costs one entry per chunk, and no range gathers the copies. A range of which a chunk holds nothing
costs nothing, so the work follows the number of windows however many ranges there are.

The two passes over a chunk read one shuffle of the texts, which are compressed before it.

Defined cases. Null and empty texts: no words, nothing removed, the digest of the empty string. Texts
shorter than a window lose nothing. Repeated rows are copies of each other: each window of either repeats.
Empty table: no rows. Further columns of the input are ignored. Texts are never cut; a text is handled whole
within its chunk. Two different windows with one pair of hashes would both go; among 10^13 windows fewer than one in a
thousand such pairs is expected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import arrays
from tidelog.llm.scratch import bounded_batches

WINDOW = 35
#: Bytes of text in a chunk, and window hashes in one range, on average.
CHUNK_BYTES, RANGE_HASHES = 12 << 20, 1 << 21
PACKED = "chunk int, doc_id long, packed binary"
SENT = "part int, chunk int, hashes binary, checks binary, many binary"
BITS = "chunk int, part int, bits binary"
RESULT = "doc_id long, n_words long, n_removed long, kept_sha256 string, intervals array<struct<start:int,end:int>>"


def _words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    for first, _, data, offsets in arrays.slices(texts):
        starts, ends, doc = arrays.runs(~arrays.SPACE[data], offsets)
        yield first, data, starts, ends, doc, arrays.hash_runs(data, starts, ends)


_SECOND = np.uint64(0xC2B2AE3D27D4EB4F)


def _window_hashes(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Both hashes of all windows of the texts, in order of text and place."""
    found, checks = [], []
    for _, _, _, _, doc, h in _words(pa.array(texts, pa.binary()).cast(pa.large_binary()).cast(pa.large_string())):
        inside = arrays.whole(doc, k)
        found.append(arrays.windows(h, k)[inside])
        checks.append((arrays.windows(arrays.mix(h ^ _SECOND), k)[inside] >> np.uint64(32)).astype(np.uint32))
    return (np.concatenate(found), np.concatenate(checks)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.uint32))


def _distinct(hashes: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of (hash, check), where each distinct pair begins in it, and the distinct pair of every place."""
    order = np.argsort(hashes, kind="stable")
    if (same := np.flatnonzero(hashes[order[1:]] == hashes[order[:-1]])).size and (checks[order[same]] != checks[order[same + 1]]).any():
        order = np.lexsort((checks, hashes))  # windows that share the first hash only
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (checks[order[1:]] != checks[order[:-1]])
    place = np.empty(len(hashes), np.int64)
    place[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), place


def unpacked(table: pa.Table) -> tuple[list[int | None], list[bytes]]:
    un = zstandard.ZstdDecompressor()
    table = table.sort_by([("doc_id", "ascending"), ("packed", "ascending")])
    return table["doc_id"].to_pylist(), [un.decompress(x) if x else b"" for x in table["packed"].to_pylist()]


def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3, write_checksum=False)
    for batch in batches:
        texts = batch.column("text").cast(pa.large_string()).cast(pa.large_binary())
        packed = pa.array([press.compress(x.as_buffer()) if x.is_valid else b"" for x in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("chunk"), batch.column("doc_id"), packed], ["chunk", "doc_id", "packed"])


def send(k: int, bits: int):
    """The distinct window hashes of one chunk, by range, ascending, with a bit for those it has more than once."""

    def one(key: tuple, table: pa.Table) -> pa.Table:
        hashes, checks = _window_hashes(unpacked(table)[1], k)
        order, first, _ = _distinct(hashes, checks)
        counts = np.diff(np.append(first, len(hashes)))
        hashes, checks = hashes[order[first]], checks[order[first]]
        parts, starts, ends = ranges_of(hashes, 64 - bits)
        rows = list(zip(starts.tolist(), ends.tolist(), strict=True))
        return pa.table(
            {
                "part": pa.array(parts, pa.int32()),
                "chunk": pa.array(np.full(len(rows), key[0].as_py(), np.int32)),
                "hashes": pa.array([deltas(hashes[a:b]) for a, b in rows], pa.binary()),
                "checks": pa.array([checks[a:b].tobytes() for a, b in rows], pa.binary()),
                "many": pa.array([np.packbits(counts[a:b] > 1).tobytes() for a, b in rows], pa.binary()),
            }
        )

    return one


def ranges_of(ascending: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(range, start, end) of each range of ascending hashes that holds one; a range is what is left of a hash after the shift."""
    lead = ascending >> np.uint64(shift)
    starts = np.flatnonzero(np.concatenate([[True], lead[1:] != lead[:-1]])) if len(lead) else np.zeros(0, np.int64)
    return lead[starts].astype(np.int64), starts, np.append(starts[1:], len(lead)) if len(lead) else starts


def range_bits(hashes: int) -> int:
    """How many leading bits tell ranges of about RANGE_HASHES of so many hashes apart."""
    return min(30, max(3, (-(-hashes // RANGE_HASHES) - 1).bit_length()))


def deltas(ascending: np.ndarray) -> bytes:
    """Gaps of ascending hashes, cut to the bytes that the widest gap needs, after a byte that tells how many."""
    gaps = np.empty_like(ascending)
    gaps[0] = ascending[0]
    np.subtract(ascending[1:], ascending[:-1], out=gaps[1:])
    head, rest = gaps[:1].tobytes(), gaps[1:]
    width = (int(rest.max()).bit_length() + 7) // 8 if len(rest) else 0
    return bytes([width]) + head + rest.view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def undeltas(data: bytes) -> np.ndarray:
    width, body = data[0], np.frombuffer(data, np.uint8, offset=9)
    n = len(body) // width if width else 0
    gaps = np.zeros((n + 1, 8), np.uint8)
    gaps[0] = np.frombuffer(data, np.uint8, 8, 1)
    gaps[1:, :width] = body.reshape(n, width)
    return np.cumsum(gaps.view(np.uint64).ravel(), dtype=np.uint64)


def judge(key: tuple, table: pa.Table) -> pa.Table:
    """For one range: which entries of each chunk repeat, there or in another chunk."""
    chunks, packs, sums, many = (table[c].to_pylist() for c in ("chunk", "hashes", "checks", "many"))
    lists = [undeltas(x) for x in packs]
    flat, checks = np.concatenate(lists), np.concatenate([np.frombuffer(x, np.uint32) for x in sums])
    _, first, place = _distinct(flat, checks)
    repeated = np.bincount(place, minlength=len(first))[place] > 1
    bits, at = [], 0
    for h, m in zip(lists, many, strict=True):
        own = np.unpackbits(np.frombuffer(m, np.uint8), count=len(h)).astype(bool)
        bits.append(np.packbits(own | repeated[at : at + len(h)]).tobytes())
        at += len(h)
    return pa.table({"chunk": pa.array(chunks, pa.int32()), "part": pa.array([key[0].as_py()] * len(chunks), pa.int32()), "bits": pa.array(bits, pa.binary())})


def cut(k: int, bits: int):
    """Removes the repeated windows of one chunk; the words of a text that no repeated window covers stay."""

    def one(_: tuple, table: pa.Table, told: pa.Table) -> pa.Table:
        if not len(table):
            return pa.table({n: [] for n in ("doc_id", "n_words", "n_removed", "kept_sha256", "intervals")}, schema=_RESULT)
        ids, texts = unpacked(table)
        hashes, checks = _window_hashes(texts, k)
        order, first, place = _distinct(hashes, checks)
        where = {p: (a, b) for p, a, b in zip(*(x.tolist() for x in ranges_of(hashes[order[first]], 64 - bits)), strict=True)}
        distinct = first
        repeated = np.zeros(len(distinct), bool)
        for part, packed in zip(told["part"].to_pylist(), told["bits"].to_pylist(), strict=True):
            a, b = where[part]
            repeated[a:b] = np.unpackbits(np.frombuffer(packed, np.uint8), count=b - a)
        hit = repeated[place] if len(distinct) else np.zeros(0, bool)
        n_words, n_removed, shas, spans, at = [], [], [], [], 0
        for text in texts:
            words = text.split()
            n = max(0, len(words) - k + 1)
            first = np.flatnonzero(hit[at : at + n])
            at += n
            intervals = []
            if len(first):
                breaks = np.flatnonzero(np.diff(first) > k)
                lo, hi = first[np.r_[0, breaks + 1]], first[np.r_[breaks, len(first) - 1]] + k
                intervals = [{"start": int(a), "end": int(b)} for a, b in zip(lo, hi, strict=True)]
            kept, last = [], 0
            for x in intervals:
                kept += words[last : x["start"]]
                last = x["end"]
            kept += words[last:]
            n_words.append(len(words))
            n_removed.append(len(words) - len(kept))
            shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            spans.append(intervals)
        return pa.table({"doc_id": ids, "n_words": n_words, "n_removed": n_removed, "kept_sha256": shas, "intervals": spans}, schema=_RESULT)

    return one


_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("intervals", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """RESULT rows, one for each row of docs: word counts, the digest of what is kept and the removed word intervals."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0  # one number
    chunks = max(8, -(-size // CHUNK_BYTES))
    bits = range_bits(size // 6)
    dealt = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)).cast("int"))
    packed = dealt.mapInArrow(pack, PACKED)
    sent = packed.groupBy("chunk").applyInArrow(send(window, bits), SENT)
    told = sent.groupBy("part").applyInArrow(judge, BITS)
    return packed.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(cut(window, bits), RESULT)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "n_words", "n_removed", "kept_sha256")


OP8_SQL = r"""
WITH words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos
  FROM (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents)
), grams AS (
  SELECT doc_id, pos, count(*) OVER win AS n, string_agg(word, ' ') OVER win AS gram
  FROM words WINDOW win AS (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)
), repeated AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, count(*) OVER (PARTITION BY hash(gram), gram) AS c FROM grams WHERE n = 35) WHERE c > 1
), marked AS (
  SELECT w.doc_id, w.pos, w.word, max(r.pos) OVER (PARTITION BY w.doc_id ORDER BY w.pos ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM words w LEFT JOIN repeated r ON w.doc_id = r.doc_id AND w.pos = r.pos
), cut AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT gone), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN cut USING (doc_id)
"""
