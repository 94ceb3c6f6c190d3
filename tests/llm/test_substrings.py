import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidelog.llm import substrings


def brute(rows, k):
    words = [(t or "").encode().split() for _, t in rows]
    times = Counter(tuple(w[i : i + k]) for w in words for i in range(len(w) - k + 1))
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - k + 1):
            if times[tuple(w[i : i + k])] > 1:
                gone.update(range(i, i + k))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d is None, d, len(w), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [5, 35])
def test_matches_brute_force(spark, k):
    rng = random.Random(k)
    words = [f"é{i}" for i in range(200)]
    passages = [rng.choices(words, k=60) for _ in range(5)]
    rows = []
    for i in range(120):
        text = rng.choices(words, k=rng.randint(0, 150))
        if rng.random() < 0.4:
            p = rng.choice(passages)
            a = rng.randint(0, 20)
            at = rng.randint(0, len(text))
            text[at:at] = p[a : a + rng.randint(20, 40)]
        rows.append((i, rng.choice([" ", "\n", "\t "]).join(text)))
    rows += [(500, None), (501, ""), (502, "a " * 200), (None, rows[0][1]), (0, rows[0][1]), (503, "Word " * 3 + "\x0b\x0c\r end\x1f")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, chunk int")
    got = sorted(((r.doc_id is None, r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.dedup(df, window=k).collect()), key=str)
    assert got == brute(rows, k)


def test_empty_table(spark):
    assert substrings.dedup(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_packs_round_trip():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 1000):
        h = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
        assert (substrings.undeltas(substrings.deltas(h)) == h).all()


def test_windows_that_share_the_first_hash_only():
    h, g = np.array([5, 5, 7, 5, 9, 7], np.uint64), np.array([1, 2, 3, 1, 4, 3], np.uint32)
    order, first, place = substrings._distinct(h, g)
    pairs = list(zip(h.tolist(), g.tolist(), strict=True))
    assert [pairs[order[i]] for i in first] == sorted(set(pairs)) and [sorted(set(pairs))[p] for p in place] == pairs
    assert substrings._distinct(h[:0], g[:0])[1].tolist() == []


def test_ranges_of_hashes():
    rng = np.random.default_rng(3)
    h = np.unique(rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2))
    parts, starts, ends = substrings.ranges_of(h, 64 - 6)
    assert starts[0] == 0 and ends[-1] == len(h) and (starts[1:] == ends[:-1]).all() and len(set(parts.tolist())) == len(parts)
    assert all(((h[a:b] >> np.uint64(58)) == np.uint64(p)).all() for p, a, b in zip(parts, starts, ends, strict=True))
    assert substrings.range_bits(0) == 3 and 1 << substrings.range_bits(100 * substrings.RANGE_HASHES) >= 100


def test_a_very_long_text(spark):
    words = [f"w{i}" for i in range(60_000)]
    rows = [(1, " ".join(words + words[100:200])), (2, " ".join(words[30_000:30_040]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id is None, r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in substrings.dedup(df).collect()), key=str)
    assert got == brute(rows, 35)
