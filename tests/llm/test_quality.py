import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidelog.llm import quality

SF = "/root/testdata/sf0.001"


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if times[g] > 1:
            covered |= {i, i + 1, i + 2}
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)]


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
CASES = [None, "", " \n\t", "a b c a b c a b", "é😀 ü\né😀 ü\n\n x\nx", "x\x0bx\x1fy\n#$%\n#$%\n", "a b   c", "word " * 5000, "z" * 3_000_000 + " end"]


def test_counts_match_brute_force():
    got = quality.score_texts(pa.array(CASES, pa.string()), quality.Model(np.zeros(quality.BUCKETS, np.float32), 0.0))
    for i, t in enumerate(CASES):
        assert [int(got[k][i]) for k in NAMES] == brute(t), t and t[:30]


def test_query_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = quality.op4_quality(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r.doc_id])
        assert [r[k] for k in NAMES] == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert r.kept == (not r.base_failed and r.probability >= quality.KEEP_AT)


def test_classifier_separates_and_is_calibrated():
    rng = np.random.default_rng(3)
    good, bad = ["alpha", "beta", "gamma", "delta"], ["buy", "cheap", "now", "click"]
    texts, y = [], []
    for i in range(400):
        y.append(i % 2)
        mine, other = (good, bad) if i % 2 else (bad, good)
        texts.append(" ".join(rng.choice(mine + mine + other, 60)))
    model = quality.fit(texts, y, [i % 5 == 0 for i in range(400)])
    p = quality.score_texts(pa.array(texts), model)["probability"]
    assert np.mean((p >= 0.5) == np.array(y)) > 0.95
    assert abs(p.mean() - 0.5) < 0.1


@pytest.mark.parametrize(("labels", "p"), [([], 1.0), ([1, 1], 1.0), ([0, 0], 0.0)])
def test_one_class_or_none(labels, p):
    model = quality.fit(["some text"] * len(labels), labels, [False] * len(labels))
    assert abs(quality.score_texts(pa.array(["other"]), model)["probability"][0] - p) < 1e-9


def test_nulls_repeats_and_extra_columns(spark, tmp_path):
    rows = [(1, None, "x"), (1, None, "x"), (None, "a b", None), (2, "ok " * 60, "y")]
    spark.createDataFrame(rows, "doc_id long, text string, quality string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(2, None), (None, 1), (1, 0), (1, 1)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = quality.op4_quality(spark, str(tmp_path)).collect()
    assert len(got) == 4 and all(r.base_failed for r in got)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert quality.op4_quality(spark, str(tmp_path)).count() == 0


def test_a_repeated_id_brings_one_text(spark):
    seen = []
    rows = [(1, f"text number {i} " * 20) for i in range(400)] + [(2, "other " * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, quality int")
    fit, quality.fit = quality.fit, lambda texts, *a: seen.append(texts) or fit(texts, *a)
    try:
        quality.train(docs, labels)
    finally:
        quality.fit = fit
    assert len(seen[0]) == 2
