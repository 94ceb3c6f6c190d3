"""Quality rules (operator 4): counting rules and a calibrated hashed n-gram classifier.

The rules count words, symbols, repeated lines and words in repeated three-word windows. The classifier is a
logistic regression over hashed features in three families (words, word pairs and character 4-grams, ASCII
lower case), each family's counts divided by its total, so that length alone says nothing. It is fitted on
labelled quality rows: about TRAIN_ROWS of them, chosen by a hash of doc_id, of texts up to TRAIN_BYTES
bytes, one text (the least) for each doc_id (both documented bounds of the sample; they bound the driver's memory and touch nothing else). A fifth
of the sample is held out and fits Platt's two calibration parameters. Texts are scored in Arrow batches
against the fixed threshold KEEP_AT on the calibrated probability.

Defined cases. Null or empty text: no words, fails the rules, not kept. No labels, or labels of one class
only: the verdict is that class' (kept where there are none), with probability 1 or 0. Labels that are null
or contradict each other for one doc_id are not used. Null doc_ids are scored but never train. Empty table:
no rows. Repeated rows: each gets its own result row. Further columns are ignored. Texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import arrays
from tidelog.llm.scratch import bounded_batches

BUCKETS = 1 << 17
TRAIN_ROWS, TRAIN_BYTES = 1500, 1 << 14
KEEP_AT = 0.5
#: Added to a feature's spread when it is scaled, so that features seen once or twice weigh little.
FLOOR = 2e-3
#: Fixed values of the rules.
MIN_WORDS, MAX_REPEAT_PERCENT = 50, 50
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
#: Seeds that keep the three families apart.
_PAIR, _CHAR = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
SCORED = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, probability double"


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # of BUCKETS float32
    bias: float
    slope: float = 1.0  # Platt's parameters
    shift: float = 0.0

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * (margin + self.bias) + self.shift, -40, 40)))


def _per_text(values: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(of, weights=values, minlength=n)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(47)).astype(np.int32)  # the top 17 bits


def families(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, text index) of each family of features."""
    lower = arrays.LOWER[data]
    words = arrays.hash_runs(lower, starts, ends)
    yield _bucket(words), doc
    inside = arrays.whole(doc, 2)
    yield _bucket(arrays.mix(arrays.windows(words, 2)[inside] ^ _PAIR)), doc[:-1][inside] if len(doc) else doc
    lead = (lower & 0xC0) != 0x80
    points = np.frombuffer(lower.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.add.reduceat(np.append(lead, False), offsets[:-1]) if len(offsets) > 1 else np.zeros(0, int)
    sizes = np.where(np.diff(offsets) > 0, sizes, 0).astype(np.int64)
    of = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    if len(points) >= 4 and len(points) == len(of):
        h = ((points[:-3] * np.uint64(0x9E3779B97F4A7C15) + points[1:-2]) * np.uint64(0xC2B2AE3D27D4EB4F) + points[2:-1]) * np.uint64(0x165667B19E3779F9) + points[3:]
        inside = of[3:] == of[:-3]
        yield _bucket((h ^ (h >> np.uint64(29))) * _CHAR)[inside], of[:-3][inside]
    else:
        yield np.zeros(0, np.int32), np.zeros(0, np.int32)


def counts(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> dict[str, np.ndarray]:
    """The rules' counts of each text of one slice."""
    n = len(offsets) - 1
    text_of = lambda at: np.searchsorted(offsets, at, "right") - 1
    hashes = arrays.hash_runs(data, starts, ends)
    space = arrays.SPACE[data]
    heads = np.concatenate([[0], np.cumsum(~space & ((data & 0xC0) != 0x80))])
    out = {"n_words": np.bincount(doc, minlength=n), "word_chars": np.diff(heads[offsets]), "n_symbols": np.bincount(text_of(np.flatnonzero(SYMBOLS[data])), minlength=n)}
    # lines: whole lines with a word, equal to an earlier one
    l_starts, l_ends, l_doc = arrays.runs(data != 10, offsets)
    has_word = np.concatenate([[0], np.cumsum(~space)])
    l_starts, l_ends, l_doc = (x[has_word[l_ends] > has_word[l_starts]] for x in (l_starts, l_ends, l_doc))
    keys = arrays.mix(arrays.hash_runs(data, l_starts, l_ends) + l_doc.astype(np.uint64) * arrays.BASE)
    _, first = np.unique(keys, return_index=True)
    out["n_dup_lines"] = np.bincount(l_doc, minlength=n) - np.bincount(l_doc[first], minlength=n)
    # words in three-word windows that occur twice or more in the text
    inside = arrays.whole(doc, 3)
    at = np.flatnonzero(inside)
    keys = arrays.mix(arrays.windows(hashes, 3)[at] + doc[at].astype(np.uint64) * arrays.BASE)
    _, place, times = np.unique(keys, return_inverse=True, return_counts=True)
    hit = at[times[place] > 1] if len(at) else at
    covered = np.zeros(len(doc), bool)
    for k in range(3):
        covered[hit + k] = True
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=n)
    return out


def margins(weights: np.ndarray, data: np.ndarray, offsets: np.ndarray, starts: np.ndarray, ends: np.ndarray, doc: np.ndarray) -> np.ndarray:
    n = len(offsets) - 1
    total = np.zeros(n)
    for buckets, of in families(data, offsets, starts, ends, doc):
        total += _per_text(weights[buckets], of, n) / np.maximum(1, np.bincount(of, minlength=n))
    return total


def score_texts(texts: pa.Array, model: Model) -> dict[str, np.ndarray]:
    """SCORED columns of a batch."""
    parts = []
    for _, _, data, offsets in arrays.slices(texts):
        found = arrays.runs(~arrays.SPACE[data], offsets)
        part = counts(data, offsets, *found)
        part["probability"] = model.probability(margins(model.weights, data, offsets, *found))
        parts.append(part)
    names = [x.split()[0] for x in SCORED.split(", ")]
    return {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0) for k in names}


def featurise(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, value) of the sample's feature matrix."""
    rows, cols, values = [], [], []
    for first, end, data, offsets in arrays.slices(pa.array(texts, pa.large_string())):
        for buckets, of in families(data, offsets, *arrays.runs(~arrays.SPACE[data], offsets)):
            keys, times = np.unique(of.astype(np.int64) * BUCKETS + buckets, return_counts=True)
            of_key, total = keys // BUCKETS, np.maximum(1, np.bincount(of, minlength=end - first))
            rows.append((of_key + first).astype(np.int32))
            cols.append((keys % BUCKETS).astype(np.int32))
            values.append((times / total[of_key]).astype(np.float32))
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(values)


def _platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton's method on Platt's smoothed targets."""
    up, down = y.sum(), len(y) - y.sum()
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    size = max(float(margin.std()), 1e-9)
    z = margin / size

    def loss(a: float, b: float) -> float:
        t = a * z + b
        return float(np.sum(np.logaddexp(0, t) - target * t)) + 5e-3 * a * a

    a, b = 1.0, 0.0
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -40, 40)))
        g = np.array([((p - target) * z).sum() + 1e-2 * a, (p - target).sum()])
        w = p * (1 - p) + 1e-9
        h = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum()]])
        step, part = np.linalg.solve(h, g), 1.0
        while part > 1e-6 and loss(a - part * step[0], b - part * step[1]) > loss(a, b):
            part /= 2
        a, b = a - part * step[0], b - part * step[1]
        if np.abs(part * step).max() < 1e-9:
            break
    return float(a / size), float(b)


def fit(texts: list[str], labels: list[int], held: list[bool], rounds: int = 100, rate: float = 0.5, decay: float = 1e-7) -> Model:
    """Balanced logistic regression by Adam over the rows not held, calibrated on those held."""
    y, kept_out = np.array(labels, float), np.array(held, bool)
    if not len(y) or y.min() == y.max():
        return Model(np.zeros(BUCKETS, np.float32), 40.0 if not len(y) or y[0] else -40.0)
    if not 0 < y[kept_out].sum() < kept_out.sum() or not 0 < y[~kept_out].sum() < (~kept_out).sum():
        kept_out = np.zeros(len(y), bool)  # too few rows to hold any out
    rows, cols, values = featurise(texts)
    used, col = np.unique(cols, return_inverse=True)
    col = col.astype(np.int32)
    train = ~kept_out
    cost = np.where(y > 0, 0.5 / y[train].mean(), 0.5 / (1 - y[train].mean())) * train / train.sum()
    # scale each feature by its spread, so that rare and frequent ones learn alike
    spread = np.sqrt(np.bincount(col, values * values, len(used)) / len(y)) + FLOOR
    scaled = values / spread[col].astype(np.float32)
    w, bias = np.zeros(len(used)), 0.0
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    rate = rate / 100
    for t in range(1, rounds + 1):
        z = np.bincount(rows, w[col] * scaled, len(y)) + bias
        e = cost * (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y)
        g, gb = np.bincount(col, e[rows] * scaled, len(used)) + decay * w, e.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9**t, 1 - 0.99**t
        w -= rate * (m / a) / (np.sqrt(v / b) + 1e-8)
        bias -= rate * (mb / a) / (np.sqrt(vb / b) + 1e-8)
    weights = np.zeros(BUCKETS, np.float32)
    weights[used] = w / spread
    check = kept_out if kept_out.any() else train
    z = np.bincount(rows, w[col] * scaled, len(y))[check] + bias
    return Model(weights, float(bias), *_platt(z, y[check]))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> Model:
    """Fits on a bounded sample of labelled rows, chosen by a hash of doc_id."""
    marked = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).where("quality = most")
    n = marked.count()
    share = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(7)), F.lit(1 << 20)) < int(min(1.0, rows / max(n, 1)) * (1 << 20))
    texts = docs.where(share & F.col("text").isNotNull() & (F.octet_length("text") <= most_bytes)).select("doc_id", "text")
    texts = texts.groupBy("doc_id").agg(F.min("text").alias("text"))  # a repeated doc_id counts once
    sample = texts.join(marked.where(share).select("doc_id", "quality"), "doc_id").withColumn("held", F.pmod(F.xxhash64(F.col("doc_id"), F.lit(11)), F.lit(5)) == 0)
    got = sample.toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return fit(got["text"].to_pylist(), [int(q > 0) for q in got["quality"].to_pylist()], got["held"].to_pylist())


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """docs with one struct column `_q` of SCORED fields."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sent = spark.sparkContext.broadcast(model)  # BUCKETS float32: half a megabyte
    at = docs.columns.index(text_col)
    width = len(docs.columns)
    schema = ", ".join(f"c{i} {t.dataType.simpleString()}" for i, t in enumerate(docs.schema.fields)) + f", _q struct<{SCORED.replace(' ', ':').replace(',:', ',')}>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = score_texts(batch.column(at), sent.value)
            kinds = [pa.int64()] * 5 + [pa.float64()]
            q = pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(got.values(), kinds, strict=True)], list(got))
            yield pa.RecordBatch.from_arrays([*batch.columns, q], [*(f"c{i}" for i in range(width)), "_q"])
        got = q = batch = None
        arrays.give_back()

    plain = docs.toDF(*(f"c{i}" for i in range(width)))
    return plain.mapInArrow(run, schema).toDF(*docs.columns, "_q")


def base_failed() -> Column:
    return (F.col("_q.n_words") < MIN_WORDS) | (100 * F.col("_q.n_repeat_words") > MAX_REPEAT_PERCENT * F.col("_q.n_words"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = scored(docs.select("doc_id", "text"), model).withColumn("base_failed", base_failed())
    kept = ~F.col("base_failed") & (F.col("_q.probability") >= KEEP_AT)
    return rows.select("doc_id", *(F.col(f"_q.{c}").alias(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")), "base_failed", kept.alias("kept"), F.col("_q.probability").alias("probability"))
