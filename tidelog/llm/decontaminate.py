"""Benchmark decontamination (operator 6): SimHash windows, multi-index Hamming blocks, exact verification.

Texts are words of letters and digits, ASCII lower case; shingles are K neighbouring words. Each benchmark
item is a weighted set of shingles (inverse frequency among items) with a 64-bit SimHash. A window of as many
words as the item slides over a document. Windows that share no shingle with any item have similarity 0 to
all of them, so only windows near a shared shingle are fingerprinted: each place where an item's shingle
stands in a document implies a start, and all starts within SLACK words of an implied one are windows.

The fingerprint of a window is matched against the items' by a multi-index: 64 bits in BLOCKS blocks. Two
fingerprints within RADIUS bits differ by PROBE = RADIUS // BLOCKS bits at most in one block at least, so reading the
items of all values within PROBE bits of each block's value misses none within the radius. Those within the radius are
verified by weighted Jaccard similarity of the exact shingle multisets, which decides at THRESHOLD.

The items travel to the tasks in portions of about ITEM_BYTES of text (their size is checked first). Frequencies are counted over
all of them before they are cut, and the portions are matched one after the other in one pass over the documents.

Defined cases. Null or empty texts on either side: no match. Items of fewer than K words: one shingle, all
their words. Texts of fewer words than an item: one window, all their words. Empty benchmark or documents: no rows. Repeated document rows: each matches; repeated items each
count under their own id. Null ids stay null. Further columns are ignored. Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import arrays
from tidelog.llm.scratch import bounded_batches

K, THRESHOLD = 5, 0.8
BLOCKS, RADIUS = 5, 19
PROBE = RADIUS // BLOCKS
SLACK = 2
ITEM_BYTES = 8 << 20
FOUND = "doc_id long, item_id long, similarity double, distance int, start int, n_words int"
HITS = "array<struct<item_id:bigint,similarity:double,distance:int,start:int,n_words:int>>"
_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64()), ("distance", pa.int32()), ("start", pa.int32()), ("n_words", pa.int32())]))
_TABLE_BITS = 22


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of words of letters and digits, ASCII lower case."""
    starts, ends, doc = arrays.runs(~arrays.PUNCT[data], offsets)
    return doc, arrays.hash_runs(arrays.LOWER[data], starts, ends)


def _bits(h: np.ndarray) -> np.ndarray:
    """+1 or -1 for each of 64 bits of each hash."""
    return (np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32) * 2) - 1


def _pack(votes: np.ndarray) -> np.ndarray:
    return np.packbits(votes > 0, axis=1, bitorder="little").view(np.uint64).ravel()


@lru_cache
def _near(width: int) -> np.ndarray:
    """All values of so many bits with PROBE bits set at most: what a block's value may differ by."""
    return np.array([sum(1 << b for b in bits) for n in range(PROBE + 1) for bits in combinations(range(width), n)], np.uint64)


class Items:
    """The benchmark side: shingles, weights, fingerprints and the multi-index."""

    def __init__(self, ids: list, texts: list[str], shared: tuple[int, np.ndarray, np.ndarray] | None = None) -> None:
        """shared: of a larger benchmark that these are a portion of, the number of items, and the shingles of several items with their number."""
        self.ids: list = []
        self.grams: list[np.ndarray] = []  # shingle hashes in order
        self.sizes: list[int] = []
        self.k: list[int] = []
        for first, end, data, offsets in arrays.slices(pa.array(texts, pa.large_string())):
            doc, h = _words(data, offsets)
            for i in range(end - first):
                own = h[doc == i]
                if not len(own):
                    continue
                k = min(K, len(own))
                self.ids.append(ids[first + i])
                self.grams.append(arrays.windows(own, k))
                self.sizes.append(len(own))
                self.k.append(k)
        n = max(1, len(self.ids)) if shared is None else shared[0]
        distinct, times = np.unique(np.concatenate([np.unique(g) for g in self.grams]) if self.grams else np.zeros(0, np.uint64), return_counts=True)
        self.shingles, self.weight = (distinct, np.log1p(n / times)) if shared is None else (shared[1], np.log1p(n / shared[2]))
        self.unseen = float(np.log1p(n))  # the weight of a shingle of no item
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[(distinct >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
        self.prints = np.array([self.fingerprint(g[None, :])[0] for g in self.grams], np.uint64)
        # places of each shingle: shingle -> (item, place)
        pairs = [(s, i, q) for i, g in enumerate(self.grams) for q, s in enumerate(g)]
        order = np.argsort(np.array([s for s, _, _ in pairs], np.uint64), kind="stable") if pairs else np.zeros(0, int)
        self.at_shingle = np.array([pairs[j][0] for j in order], np.uint64)
        self.at_item = np.array([pairs[j][1] for j in order], np.int64)
        self.at_place = np.array([pairs[j][2] for j in order], np.int64)
        cuts = np.linspace(0, 64, BLOCKS + 1).astype(int).tolist()
        self.index: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # of each block: shift, width, items by value, where each value begins
        for at, end in zip(cuts[:-1], cuts[1:], strict=True):
            keys = (self.prints >> np.uint64(at)) & np.uint64((1 << (end - at)) - 1) if len(self.prints) else np.zeros(0, np.uint64)
            order = np.argsort(keys, kind="stable")
            self.index.append((at, end - at, order, np.searchsorted(keys[order], np.arange((1 << (end - at)) + 1, dtype=np.uint64))))

    def weights_of(self, grams: np.ndarray) -> np.ndarray:
        if not len(self.shingles):
            return np.full(grams.shape, self.unseen)
        at = np.minimum(np.searchsorted(self.shingles, grams), len(self.shingles) - 1)
        return np.where(self.shingles[at] == grams, self.weight[at], self.unseen)

    def fingerprint(self, grams: np.ndarray) -> np.ndarray:
        """SimHash of each row of shingles."""
        w = self.weights_of(grams)[..., None].astype(np.float32)
        return _pack((_bits(np.ascontiguousarray(grams).ravel()).reshape(*grams.shape, 64) * w).sum(axis=1))

    def within(self, prints: np.ndarray) -> list[tuple[int, int, int]]:
        """(row, item, distance) of all items within RADIUS of each fingerprint, by the multi-index."""
        found = []
        for shift, width, order, begins in self.index:
            keys = (prints >> np.uint64(shift)) & np.uint64((1 << width) - 1)
            asked = (keys[:, None] ^ _near(width)[None, :]).astype(np.int64)
            lo, times = begins[asked], begins[asked + 1] - begins[asked]
            rows, cols = np.nonzero(times)
            lo, times = lo[rows, cols], times[rows, cols]
            at = np.repeat(lo - np.cumsum(times) + times, times) + np.arange(times.sum())
            found.append(np.repeat(rows, times) * max(1, len(self.prints)) + order[at])
        both = np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)
        rows, items = np.divmod(both, max(1, len(self.prints)))
        d = np.bitwise_count(prints[rows] ^ self.prints[items]) if len(both) else np.zeros(0, np.uint8)
        return [(int(r), int(i), int(x)) for r, i, x in zip(rows[d <= RADIUS], items[d <= RADIUS], d[d <= RADIUS], strict=True)]

    def similarity(self, grams: np.ndarray, item: int) -> float:
        """Weighted Jaccard similarity of multisets."""
        own = self.grams[item]
        keys, back = np.unique(np.concatenate([grams, own]), return_inverse=True)
        a, b = np.bincount(back[: len(grams)], minlength=len(keys)), np.bincount(back[len(grams) :], minlength=len(keys))
        w = self.weights_of(keys)
        return float((w * np.minimum(a, b)).sum() / (w * np.maximum(a, b)).sum())


def search(items: Items, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, float, int, int, int]]:
    """(text index, item index, similarity, distance, start, words) of the best window of each text and item that match."""
    doc, words = _words(data, offsets)
    for k in sorted(set(items.k)):
        inside = arrays.whole(doc, k)
        grams = arrays.windows(words, k)
        near = np.flatnonzero(items.table[(grams >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] & inside)
        if not len(near):
            continue
        lo, hi = np.searchsorted(items.at_shingle, grams[near], "left"), np.searchsorted(items.at_shingle, grams[near], "right")
        times = hi - lo
        place = np.repeat(near, times)
        entry = np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item, start = items.at_item[entry], place - items.at_place[entry]
        sizes = np.array(items.sizes)[item]
        ok = np.array(items.k)[item] == k
        first = np.searchsorted(doc, doc[place], "left")
        last = np.searchsorted(doc, doc[place], "right")
        best: dict[tuple[int, int], tuple[float, int, int, int]] = {}
        for size in np.unique(sizes[ok]):
            take = ok & (sizes == size)
            base = np.unique(np.stack([start[take], first[take], last[take]], axis=1), axis=0)
            starts = (base[:, :1] + np.arange(-SLACK, SLACK + 1)).ravel()
            f, e = np.repeat(base[:, 1], 2 * SLACK + 1), np.repeat(base[:, 2], 2 * SLACK + 1)
            # a start over the text's edge: the window nearest inside
            starts = np.clip(starts, f, np.maximum(f, e - size))
            length = np.minimum(size, e - starts)
            starts = np.unique(starts[length == size])
            many = int(size) - k + 1
            for a in range(0, len(starts), 256):
                part = starts[a : a + 256]
                rows = grams[part[:, None] + np.arange(many)]
                for r, i, d in items.within(items.fingerprint(rows)):
                    if items.sizes[i] != size or items.k[i] != k:
                        continue
                    s = items.similarity(rows[r], i)
                    if s >= THRESHOLD:
                        at = int(part[r])
                        t = int(doc[at])
                        got = (s, -d, -(at - int(np.searchsorted(doc, t, "left"))), int(size))
                        if got > best.get((t, i), (-1.0, 0, 0, 0)):
                            best[t, i] = got
        # a text shorter than an item: one window, all its words
        short = np.unique(np.stack([first, last], axis=1)[ok & (last - first < sizes)], axis=0)
        for size in np.unique(short[:, 1] - short[:, 0]):
            starts = short[short[:, 1] - short[:, 0] == size, 0]
            for a in range(0, len(starts), 256):
                part = starts[a : a + 256]
                rows = grams[part[:, None] + np.arange(int(size) - k + 1)]
                for r, i, d in items.within(items.fingerprint(rows)):
                    if items.sizes[i] > size and items.k[i] == k and (s := items.similarity(rows[r], i)) >= THRESHOLD:
                        best[int(doc[part[r]]), i] = (s, -d, 0, int(size))
        for (t, i), (s, d, at, size) in best.items():
            yield t, i, s, -d, -at, size


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """FOUND rows: the best matching window of every document and item that match."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.array().cast(HITS).alias("hits")).where("text is not null")
    for items in portions(benchmark):
        rows = _with_hits(rows, items)
    return rows.select("doc_id", F.inline("hits")).select(*(x.split()[0] for x in FOUND.split(", ")))


def portions(benchmark: DataFrame) -> Iterator[Items]:
    """The items, in portions of about ITEM_BYTES; one portion at least."""
    bounded_batches(benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // ITEM_BYTES) or 1
    shared = _shared(items) if count > 1 else None
    for portion in range(count):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(count)) == portion).toArrow().sort_by([("item_id", "ascending"), ("text", "ascending")])
        yield Items(own["item_id"].to_pylist(), own["text"].to_pylist(), shared)


def _shared(items: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of items with words; the shingles of several items, ascending, and of how many. All others weigh as those of no item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, data, offsets in arrays.slices(batch.column("text")):
                doc, h = _words(data, offsets)
                own = [np.unique(arrays.windows(x, min(K, len(x)))) for i in range(end - first) if len(x := h[doc == i])]
                if own:
                    yield pa.RecordBatch.from_arrays([pa.array(arrays.signed(np.concatenate(own))), pa.array(np.concatenate([np.arange(len(x)) == 0 for x in own]))], ["h", "leads"])

    grams = items.select("text").mapInArrow(run, "h long, leads boolean")
    n = grams.where("leads").count()
    several = grams.groupBy("h").count().where("count > 1").toArrow()
    h = several["h"].to_numpy().view(np.uint64)
    order = np.argsort(h)
    return max(1, n), h[order], several["count"].to_numpy()[order]


def without_matches(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows of docs, all columns, in which no item matches. A row is judged where it lies; nothing is shuffled."""
    at, columns, width = docs.columns.index(text_col), docs.columns, len(docs.columns)
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema.fields))
    rows = docs.toDF(*(f"c{i}" for i in range(width)))  # names may clash
    for items in portions(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for first, _, data, offsets in arrays.slices(batch.column(at)):
                    clean[[first + x[0] for x in search(sent.value, data, offsets)]] = False
                yield batch.filter(pa.array(clean))

        rows = rows.mapInArrow(run, schema)
    return rows.toDF(*columns)


def _with_hits(rows: DataFrame, items: Items) -> DataFrame:
    """Adds what matches of one portion to each row's hits."""
    sent = rows.sparkSession.sparkContext.broadcast(items)
    names = [x.split(":")[0] for x in HITS.removeprefix("array<struct<").removesuffix(">>").split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            hits = batch.column("hits").to_pylist()
            for first, _, data, offsets in arrays.slices(batch.column("text")):
                for t, i, *rest in search(known, data, offsets):
                    hits[first + t] = [*hits[first + t], dict(zip(names, (known.ids[i], *rest), strict=True))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text"), pa.array(hits, _HITS)], ["doc_id", "text", "hits"])

    return rows.mapInArrow(run, f"doc_id long, text string, hits {HITS}")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matches(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
