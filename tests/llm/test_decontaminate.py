import random

import numpy as np
import pyarrow as pa

from tidelog.llm import arrays, decontaminate as dec

SF = "/root/testdata/sf0.01"
VOCAB = [f"w{i}" for i in range(300)]


def words(text):
    out, cur = [], []
    for c in text:
        c = c.lower() if c.isascii() else c
        if c.isascii() and not c.isalnum():
            if cur:
                out.append("".join(cur))
            cur = []
        else:
            cur.append(c)
    return out + (["".join(cur)] if cur else [])


def brute(docs, items):
    """Pairs where some window of an item's words has weighted Jaccard similarity of THRESHOLD or more."""
    grams = lambda w, k: [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    its = {i: (w, min(dec.K, len(w))) for i, t in items if (w := words(t or ""))}
    times = {}
    for w, k in its.values():
        for g in set(grams(w, k)):
            times[g] = times.get(g, 0) + 1
    weight = lambda g: np.log1p(len(its) / times[g]) if g in times else np.log1p(len(its))
    found = {}
    for d, t in docs:
        w = words(t or "")
        for i, (v, k) in its.items():
            own = grams(v, k)
            for a in range(len(w) - len(v) + 1):
                win = grams(w[a : a + len(v)], k)
                keys = set(win) | set(own)
                up = sum(weight(g) * min(win.count(g), own.count(g)) for g in keys)
                down = sum(weight(g) * max(win.count(g), own.count(g)) for g in keys)
                if up / down >= dec.THRESHOLD - 1e-12:
                    found[d, i] = max(found.get((d, i), 0), up / down)
    return found


def cases(seed):
    rng = random.Random(seed)
    items = [(i, " ".join(rng.choices(VOCAB, k=rng.randint(15, 60)))) for i in range(12)] + [(50, None), (51, ""), (52, "tiny item")]
    docs = []
    for d in range(60):
        w = rng.choices(VOCAB, k=rng.randint(0, 80))
        if d % 2:
            own = items[d % 12][1].split()
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                own[rng.randrange(len(own))] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = own
        docs.append((d, rng.choice([" ", ", ", "\n"]).join(w).upper() if d % 3 else " ".join(w)))
    return [*docs, (100, None), (101, ""), (102, "x tiny item y"), (None, items[0][1])], items


def test_matches_brute_force(spark):
    docs, items = cases(4)
    df = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int")
    got = {(r.doc_id, r.item_id): r.similarity for r in dec.matches(df, spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute(docs, items)
    assert set(got) == set(want)
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
    assert dec.matches(df.where("false"), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert dec.matches(df, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_multi_index_misses_none_within_the_radius():
    rng = np.random.default_rng(2)
    items = dec.Items(list(range(30)), [" ".join(rng.choice(VOCAB, 20)) for _ in range(30)])
    prints = items.prints[rng.integers(0, 30, 400)].copy()
    for row in range(400):
        for bit in rng.choice(64, rng.integers(0, 25), replace=False):
            prints[row] ^= np.uint64(1) << np.uint64(bit)
    d = np.bitwise_count(prints[:, None] ^ items.prints[None, :])
    assert items.within(prints) == [(int(r), int(i), int(d[r, i])) for r, i in np.argwhere(d <= dec.RADIUS)]


def test_planted_items_of_the_table(spark):
    """Every document that holds a whole item word for word is found."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    got = {(r.doc_id, r.item_id) for r in dec.op6_decontaminate(spark, SF).collect()}
    texts = [(r.doc_id, f" {' '.join(words(r.text))} ") for r in docs]
    held = {(d, i.item_id) for i in items for d, t in texts if f" {' '.join(words(i.text))} " in t}
    assert held and held <= got


def test_portions_give_the_same(spark, monkeypatch):
    docs, items = cases(7)
    df, its = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    whole = {(r.doc_id, r.item_id) for r in dec.matches(df, its).collect()}
    monkeypatch.setattr(dec, "ITEM_BYTES", 1500)
    assert {(r.doc_id, r.item_id) for r in dec.matches(df, its).collect()} == whole


def test_fingerprints_use_all_bits():
    items = dec.Items([0], ["one two three four five six seven"])
    assert 16 < int(np.bitwise_count(items.prints[0])) < 48
    assert list(dec.search(items, *next(iter(arrays.slices(pa.array([None, "x"]))))[2:])) == []
