"""Language identification (operator 7): known words first, then ever shorter character n-grams.

A text's words (runs of letters, lower case) are scored one by one. A known word adds its smoothed
log-frequency in each language. An unseen word backs off to its character n-grams: the longest length, from
LONGEST down to 1, of which at least one n-gram was seen, and adds the mean over those. The language with the greatest
sum wins; the score is its posterior when the mean score of a word is sharpened by at most SHARPEN words.

Training counts every word of all training rows in Spark, and the n-grams of every counted word. All of them are
known; the model stays a pair of tables. Documents are cut into chunks of about CHUNK characters. A chunk asks for its
distinct words by 64-bit hash, packed by ranges of hashes, and then for the n-grams of the words that are unseen; each range
of the model answers with the counts of those it knows, and the chunk, which now holds all of the model that it needs,
scores its documents. Only what is distinct in a chunk is shuffled. The number of ranges follows the number of chunks, and a range that a chunk asks
nothing of costs nothing. train() collects the model for use in one process, where it fits.

Defined cases. Null text, or a text with no letter: `und`, score 0. No training rows: `und`, score 0. One
language only: that, score 1. Ties: the language first in the alphabet. Training rows with null text or lang
are not used. Characters that are numerals (², ½, Ⅷ) are no letters. Empty table: no rows. Repeated rows: each gets its own row. Further columns are ignored. Texts
are never cut.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import arrays, substrings
from tidelog.llm.scratch import Scratch

LONGEST = 5
CHUNK = 32 << 20
SHARPEN = 50
ASCII_LETTERS, LETTERS = re.compile("[a-z]+"), regex.compile(r"\p{L}+")
FLUSH = 500_000  # distinct (language, word) counts held by a task before it hands them on
SLICE = 1 << 21  # characters scored together


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower case."""
    if not text:
        return []
    text = text.lower()
    return (ASCII_LETTERS if text.isascii() else LETTERS).findall(text)


def word_hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(("\n".join(words) + "\n").encode(), np.uint8)
    ends = np.flatnonzero(data == 10) if words else np.zeros(0, np.int64)
    starts = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
    return arrays.mix(arrays.hash_runs(data, starts, ends) ^ arrays.BASE)


class WordList:
    """Code points of words, each between two marks, and the hashes of their n-grams."""

    def __init__(self, words: list[str]) -> None:
        flat = "\x03\x02".join(words)
        self.points = np.frombuffer(f"\x02{flat}\x03".encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        self.word = np.repeat(np.arange(len(words)), sizes)

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(word, hash) of every n-gram; single characters go without the marks."""
        count = len(self.points) - n + 1
        if count <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.full(count, n, np.uint64)
        for i in range(n):
            h = h * arrays.BASE + self.points[i : i + count]
        inside = self.word[n - 1 :] == self.word[:count]
        if n == 1:
            inside &= self.points > 3
        return self.word[:count][inside], arrays.mix(h[inside])


class Model:
    """words: word -> row of scores; grams: by length, ascending hashes and their rows of scores."""

    def __init__(self, langs: list[str], words: dict[str, np.ndarray], grams: dict[int, tuple[np.ndarray, np.ndarray]]) -> None:
        self.langs, self.grams = langs, grams
        self.rows = {w: i for i, w in enumerate(words)}
        self.scores = np.array(list(words.values()), np.float32).reshape(len(words), len(langs))

    def back_off(self, words: list[str]) -> np.ndarray:
        """Scores of unseen words."""
        out = np.zeros((len(words), len(self.langs)), np.float32)
        left = np.arange(len(words))
        for n in range(LONGEST, 0, -1):
            known, scores = self.grams.get(n, (np.zeros(0, np.uint64), None))
            if not len(left) or not len(known):
                continue
            of, h = WordList([words[i] for i in left]).grams(n)
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = known[at] == h
            of, at = of[hit], at[hit]
            times = np.bincount(of, minlength=len(left))
            for lang in range(len(self.langs)):
                out[left, lang] = np.bincount(of, scores[at, lang], len(left)) / np.maximum(times, 1)
            left = left[times == 0]
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """The language and the score of each text."""
        split = [words_of(t) for t in texts]
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        names, scores = ["und"] * len(texts), np.zeros(len(texts))
        if not self.langs or not sizes.sum():
            return names, scores
        get, own = self.rows.get, {}
        base, rows = len(self.rows), []
        for words in split:
            for w in words:
                i = get(w)
                rows.append(i if i is not None else base + own.setdefault(w, len(own)))
        table = np.concatenate([self.scores, self.back_off(list(own))]) if own else self.scores
        return _decided(self.langs, table, np.array(rows), sizes)


def _decided(langs: list[str], table: np.ndarray, rows: np.ndarray, sizes: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The language and the score of texts of so many words; rows: each word's row of scores in table."""
    names, scores = ["und"] * len(sizes), np.zeros(len(sizes))
    some = np.flatnonzero(sizes)
    if not langs or not len(some):
        return names, scores
    ends = np.cumsum(sizes)
    starts, until = (ends - sizes)[some], ends[some]
    total = np.empty((len(some), len(langs)))
    a = 0
    while a < len(some):  # about SLICE words at a time
        b = max(a + 1, int(np.searchsorted(until, starts[a] + SLICE, "right")))
        total[a:b] = np.add.reduceat(table[rows[starts[a] : until[b - 1]]].astype(np.float64), starts[a:b] - starts[a], axis=0)
        a = b
    best = total.argmax(axis=1)
    spread = (total - total.max(axis=1, keepdims=True)) * (np.minimum(sizes[some], SHARPEN) / sizes[some])[:, None]
    scores[some] = 1 / np.exp(np.clip(spread, -700, 0)).sum(axis=1)
    for i, b in zip(some.tolist(), best.tolist(), strict=True):
        names[i] = langs[b]
    return names, scores


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, word)."""

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, words in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words), pa.string()), pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], ["lang", "word", "k"])

    held: dict[str, Counter] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            own = held.setdefault(lang, Counter())
            before = len(own)
            own.update(words_of(text))
            size += len(own) - before
            if size >= FLUSH:
                yield from flush()
                held, size = {}, 0
    yield from flush()


def _tally_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (lang, n, hash) over counted words."""
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        of_word, times = langs.indices.to_numpy(zero_copy_only=False), batch.column("k").to_numpy(zero_copy_only=False)
        listed = WordList(batch.column("word").to_pylist())
        for n in range(1, LONGEST + 1):
            word, h = listed.grams(n)
            for i, lang in enumerate(langs.dictionary.to_pylist()):
                mine = of_word[word] == i
                keys, place = np.unique(h[mine], return_inverse=True)
                k = np.bincount(place, times[word[mine]]).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(np.full(len(keys), n, np.int32)), pa.array(arrays.signed(keys)), pa.array(k)], ["lang", "n", "h", "k"])


class Counts:
    """The model as tables: words (word, by) and grams (n, h, by), by: counts of each language; sizes and sums for smoothing."""

    def __init__(self, docs: DataFrame, scratch: Scratch) -> None:
        rows = docs.where("text is not null and lang is not null").select("lang", "text")
        by = F.collect_list(F.struct("lang", "k")).alias("by")  # one entry per language
        counted = rows.mapInArrow(_tally, "lang string, word string, k long").repartition("word").groupBy("word", "lang").agg(F.sum("k").alias("k"))
        self.words = scratch.save(counted.groupBy("word").agg(by), "words")
        scratch.release()
        self.langs = sorted(x["lang"] for x in rows.select("lang").distinct().collect())
        counted = self.words.select("word", F.inline("by"))
        parts = counted.mapInArrow(_tally_grams, "lang string, n int, h long, k long").groupBy("n", "h", "lang").agg(F.sum("k").alias("k"))
        self.grams = scratch.save(parts.groupBy("n", "h").agg(by), "grams")
        sums = lambda df, *n: df.groupBy(*n, "lang").agg(F.sum("k").alias("k")).collect()
        self.word_sums = {x["lang"]: x["k"] for x in sums(counted)}
        self.word_count = self.words.count()
        self.gram_sums = {(x["n"], x["lang"]): x["k"] for x in sums(self.grams.select("n", F.inline("by")), "n")}
        self.gram_count = {x["n"]: x["count"] for x in self.grams.groupBy("n").count().collect()}
        scratch.release()

    def floor(self, n: int) -> np.ndarray:
        """What smoothing takes off log(count + 1/2) in each language; n: the length of n-grams, 0 for words."""
        size, total = (self.word_count, self.word_sums.get) if n == 0 else (self.gram_count.get(n, 0), lambda x, none: self.gram_sums.get((n, x), none))
        return np.array([np.log(total(x, 0) + 0.5 * size) if size else 0.0 for x in self.langs])

    def scored(self, counts: np.ndarray, n: int) -> np.ndarray:
        """Smoothed log-frequencies of rows of counts."""
        return (np.log(counts + 0.5) - self.floor(n)).astype(np.float32)


def _matrix(by: pa.Array, langs: list[str]) -> np.ndarray:
    """Rows of counts in each language, of a column `by`."""
    if isinstance(by, pa.ChunkedArray):
        by = by.combine_chunks()
    rows = np.repeat(np.arange(len(by)), np.diff(by.offsets.to_numpy()))
    flat = by.flatten()
    place = pc.index_in(flat.field("lang"), value_set=pa.array(langs, pa.string())).to_numpy(zero_copy_only=False)
    out = np.zeros((len(by), len(langs)), np.int64)
    out[rows, place.astype(np.int64)] = flat.field("k").to_numpy(zero_copy_only=False)
    return out


def train(docs: DataFrame) -> Model:
    """The whole model in this process; docs: rows with text and lang to learn from."""
    counts = Counts(docs, Scratch(docs.sparkSession))
    if not counts.langs:
        return Model([], {}, {})
    table = counts.words.select("word", "by").toArrow()
    words = dict(zip(table["word"].to_pylist(), counts.scored(_matrix(table["by"], counts.langs), 0), strict=True))
    by_n = {}
    for n in counts.gram_count:
        table = counts.grams.where(F.col("n") == n).select("h", "by").toArrow()
        h = table["h"].to_numpy().view(np.uint64)
        order = np.argsort(h)
        by_n[n] = (h[order], counts.scored(_matrix(table["by"], counts.langs)[order], n))
    return Model(counts.langs, words, by_n)


CHUNKS = "chunk long, ids array<long>, held array<boolean>, sizes binary, rows binary, words binary"


def _pack_rows(rows: np.ndarray) -> bytes:
    """Rows, each document's ascending, as gaps by byte planes: most gaps are small, so they pack well."""
    return np.diff(rows, prepend=np.int32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()


def _unpack_rows(data: bytes) -> np.ndarray:
    gaps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view(np.int32).ravel()
    return np.cumsum(gaps, dtype=np.int32)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """CHUNKS rows: documents as rows of the chunk's list of distinct words, without the order of the text."""
    press, part, serial = zstandard.ZstdCompressor(level=3), TaskContext.get().partitionId(), 0
    names = [x.split()[0] for x in CHUNKS.split(", ")]

    def flush() -> pa.RecordBatch:
        packed = [press.compress(x) for x in (np.array(sizes, np.int64).tobytes(), _pack_rows(np.concatenate(rows)), "\n".join(own).encode())]
        columns = [pa.array([(part << 32) + serial], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())), *(pa.array([x], pa.binary()) for x in packed)]
        return pa.RecordBatch.from_arrays(columns, names)

    ids, held, sizes, rows, own, size = [], [], [], [], {}, 0
    for batch in batches:
        for doc, out, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "held_out", "text")), strict=True):
            found = words_of(text)
            ids.append(doc)
            held.append(out)
            sizes.append(len(found))
            rows.append(np.sort(np.array([own.setdefault(w, len(own)) for w in found], np.int32)))
            size += len(text or "") + 64
            if size >= CHUNK:
                yield flush()
                ids, held, sizes, rows, own, size, serial = [], [], [], [], {}, 0, serial + 1
    if ids:
        yield flush()


def _words_in(packed: bytes) -> list[str]:
    text = zstandard.ZstdDecompressor().decompress(packed).decode()
    return text.split("\n") if text else []


def _distinct_grams(words: list[str]) -> np.ndarray:
    """Hashes of all n-grams of the words, distinct and ascending."""
    if not words:
        return np.zeros(0, np.uint64)
    listed = WordList(words)
    return np.unique(np.concatenate([np.unique(listed.grams(n)[1]) for n in range(1, LONGEST + 1)]))  # one length in memory at a time


ASKED = "part int, chunk long, hashes binary"


def _by_range(chunk: int, asked: np.ndarray, bits: int) -> list[pa.Array]:
    """Columns of ASKED: what a chunk asks of each range of hashes."""
    parts, starts, ends = substrings.ranges_of(asked, 64 - bits)
    packed = [substrings.deltas(asked[a:b]) for a, b in zip(starts, ends, strict=True)]
    return [pa.array(parts, pa.int32()), pa.array(np.full(len(parts), chunk, np.int64)), pa.array(packed, pa.binary())]


def _send(bits: int):
    """The distinct words of each chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, packed in zip(batch.column("chunk").to_pylist(), batch.column("words").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays(_by_range(chunk, np.unique(word_hashes(_words_in(packed))), bits), ["part", "chunk", "hashes"])

    return run


def _told(asked: np.ndarray, told: pa.Table, bits: int) -> np.ndarray:
    """Which of the hashes are known."""
    parts, starts, ends = substrings.ranges_of(asked, 64 - bits)
    where = {p: (a, b) for p, a, b in zip(parts.tolist(), starts.tolist(), ends.tolist(), strict=True)}
    hit = np.zeros(len(asked), bool)
    for part, known in zip(told["part"].to_pylist(), told["known"].to_pylist(), strict=True):
        a, b = where[part]
        hit[a:b] = np.unpackbits(np.frombuffer(known, np.uint8), count=b - a).astype(bool)
    return hit


def _send_grams(bits: int):
    """The distinct n-grams of those words of a chunk that are unseen."""

    def run(chunk: pa.Table, told: pa.Table) -> pa.Table:
        words = _words_in(chunk["words"][0].as_py())
        asked = np.unique(word_hashes(words))
        hit = _told(asked, told, bits)[np.searchsorted(asked, word_hashes(words))] if words else np.zeros(0, bool)
        unseen = [words[i] for i in np.flatnonzero(~hit)]
        return pa.table(_by_range(chunk["chunk"][0].as_py(), _distinct_grams(unseen), bits), ["part", "chunk", "hashes"])

    return run


def _packs(h: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    """Hashes and counts by range: most counts are small, and few languages have any, so they pack well."""
    order = np.argsort(h)
    h, counts = h[order], counts[order]
    parts, starts, ends = substrings.ranges_of(h, 64 - bits)
    rows = list(zip(starts.tolist(), ends.tolist(), strict=True))
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array([substrings.deltas(h[a:b]) for a, b in rows], pa.binary()), pa.array([zstandard.compress(counts[a:b].T.tobytes(), 3) for a, b in rows], pa.binary())], ["part", "hashes", "counts"])


def _known(words: bool, langs: list[str], bits: int):
    """The model's packs, from its tables."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                h = word_hashes(batch.column("word").to_pylist()) if words else batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)
                yield _packs(h, _matrix(batch.column("by"), langs), bits)

    return run


class _Grams:
    """N-grams by length, as in Model; their hashes tell their length, so all lengths share one table of log(count + 1/2)."""

    def __init__(self, hashes: np.ndarray, logs: np.ndarray, floors: list[np.ndarray]) -> None:
        self.hashes, self.logs, self.floors = hashes, logs, floors

    def get(self, n: int, _: tuple) -> tuple[np.ndarray, np.ndarray]:
        return self.hashes, (self.logs - self.floors[n]).astype(np.float32)


def identified(docs: DataFrame, counts: Counts, scratch: Scratch) -> DataFrame:
    """As predict(), with the model in tables."""
    schema = "doc_id long, held_out boolean, lang_pred string, score double"
    if not counts.langs:
        return predict(docs, Model([], {}, {}))
    langs, width = counts.langs, len(counts.langs)
    chunks = scratch.save(docs.select("doc_id", "held_out", "text").mapInArrow(_chunks, CHUNKS), "chunks")
    bits = max(3, (chunks.count() - 1).bit_length())
    packs = "part int, hashes binary, counts binary"
    floors = [counts.floor(n) for n in range(LONGEST + 1)]

    def answer(asked: pa.Table, known: pa.Table) -> pa.Table:
        un = zstandard.ZstdDecompressor()
        h = np.concatenate([np.zeros(0, np.uint64), *map(substrings.undeltas, known["hashes"].to_pylist())])
        counted = np.concatenate([np.zeros((0, width), np.int64), *(np.frombuffer(un.decompress(x), np.int64).reshape(width, -1).T for x in known["counts"].to_pylist())])
        order = np.argsort(h)
        h = h[order]
        bits_of, values = [], []
        for packed in asked["hashes"].to_pylist():
            own = substrings.undeltas(packed)
            at = np.minimum(np.searchsorted(h, own), max(0, len(h) - 1))
            hit = h[at] == own if len(h) else np.zeros(len(own), bool)
            bits_of.append(np.packbits(hit).tobytes())
            values.append(zstandard.compress(counted[order[at[hit]]].T.tobytes() if len(h) else b"", 3))
        return pa.table([asked["chunk"], asked["part"], pa.array(bits_of, pa.binary()), pa.array(values, pa.binary())], ["chunk", "part", "known", "counts"])

    def look_up(asked: DataFrame, model: DataFrame) -> DataFrame:
        return asked.groupBy("part").cogroup(model.groupBy("part")).applyInArrow(answer, "chunk long, part int, known binary, counts binary")

    of_words = look_up(chunks.select("chunk", "words").mapInArrow(_send(bits), ASKED), counts.words.select("word", "by").mapInArrow(_known(True, langs, bits), packs))
    of_words = scratch.save(of_words, "known-words")
    left = chunks.select("chunk", "words").groupBy("chunk").cogroup(of_words.select("chunk", "part", "known").groupBy("chunk")).applyInArrow(_send_grams(bits), ASKED)
    of_grams = look_up(left, counts.grams.select("h", "by").mapInArrow(_known(False, langs, bits), packs))
    answers = of_words.withColumn("words", F.lit(True)).unionByName(of_grams.withColumn("words", F.lit(False)))

    def values_of(asked: np.ndarray, told: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Which hashes are known, and log(count + 1/2) of those, in their order."""
        hit = _told(asked, told, bits)
        values, un, order = [np.zeros((0, width), np.float32)], zstandard.ZstdDecompressor(), np.argsort(told["part"].to_numpy())
        for i in order.tolist():
            values.append(np.log(np.frombuffer(un.decompress(told["counts"][i].as_py()), np.int64).reshape(width, -1).T + 0.5).astype(np.float32))
        return hit, np.concatenate(values)

    def run(chunk: pa.Table, told: pa.Table) -> pa.Table:
        un = zstandard.ZstdDecompressor()
        sizes = np.frombuffer(un.decompress(chunk["sizes"][0].as_py()), np.int64)
        rows = _unpack_rows(un.decompress(chunk["rows"][0].as_py()))
        words = _words_in(chunk["words"][0].as_py())
        hashes = word_hashes(words)
        asked = np.unique(hashes)
        hit, logs = values_of(asked, told.filter(told["words"]))
        at = np.searchsorted(asked, hashes)
        seen = np.flatnonzero(hit[at]) if words else np.zeros(0, np.int64)
        unseen = np.flatnonzero(~hit[at]) if words else seen
        table = np.zeros((len(words), width), np.float32)
        table[seen] = logs[(np.cumsum(hit) - 1)[at[seen]]] - floors[0]
        left = [words[i] for i in unseen]
        asked = _distinct_grams(left)
        hit, logs = values_of(asked, told.filter(pc.invert(told["words"])))
        table[unseen] = Model(langs, {}, _Grams(asked[hit], logs, floors)).back_off(left)
        names, best = _decided(langs, table, rows, sizes)
        return pa.table([pa.array(chunk["ids"][0].as_py(), pa.int64()), pa.array(chunk["held"][0].as_py(), pa.bool_()), pa.array(names, pa.string()), pa.array(best, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(run, schema)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score; docs: doc_id, held_out and text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # of one process; identified() needs no broadcast

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, end, _, _ in arrays.slices(batch.column("text"), SLICE):
                part = batch.slice(first, end - first)
                names, scores = sent.value.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))
    scratch = Scratch(spark)
    return identified(docs, Counts(docs.where("not held_out"), scratch), scratch)
