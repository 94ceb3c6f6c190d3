"""Texts shorter than an item, and frequencies over all portions."""

import random

from tidelog.llm import decontaminate as dec

VOCAB = [f"w{i}" for i in range(40)]


def test_texts_shorter_than_the_item(spark):
    item = [f"v{i}" for i in range(40)]
    cut = {1: item[:-1], 2: item[1:], 3: item[2:-2], 4: item[:20], 5: item[:3], 6: item}
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in cut.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in dec.matches(docs, spark.createDataFrame([(7, " ".join(item)), (8, "else where altogether it is")], "item_id long, text string")).collect()}
    assert {i: (round(r.similarity, 6), r.start, r.n_words) for i, r in got.items()} == {1: (round(35 / 36, 6), 0, 39), 2: (round(35 / 36, 6), 0, 39), 3: (round(32 / 36, 6), 0, 36), 6: (1.0, 0, 40)}


def test_portions_weigh_over_all_items(spark, monkeypatch):
    rng = random.Random(1)
    common = " ".join(rng.choices(VOCAB, k=12))
    items = [(i, f"{' '.join(rng.choices(VOCAB, k=30))} {common}") for i in range(20)]
    docs = [(i, t.replace("w3 ", "other ", 1)) for i, t in items] + [(50 + i, f"{' '.join(t.split()[:-1])} changed") for i, t in items]
    df, its = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    found = lambda: {(r.doc_id, r.item_id): round(r.similarity, 9) for r in dec.matches(df, its).collect()}
    whole = found()
    monkeypatch.setattr(dec, "ITEM_BYTES", 800)
    assert whole and found() == whole


def test_items_that_share_shingles_equal_brute_force(spark, monkeypatch):
    """Also in the similarities, however the benchmark is cut into portions; short texts, repeated rows and very long ones among them."""
    from tests.llm.test_decontaminate import brute

    rng = random.Random(12)
    common = [" ".join(rng.choices(VOCAB, k=9)) for _ in range(4)]
    items = [(i, f"{' '.join(rng.choices(VOCAB, k=rng.randint(8, 25)))} {rng.choice(common)} {' '.join(rng.choices(VOCAB, k=rng.randint(3, 20)))}") for i in range(10)]
    docs = []
    for d in range(24):
        w = items[d % 10][1].split()
        for _ in range(rng.choice([0, 0, 1, 1])):
            w[rng.choice([0, 1, -1, -2])] = "other"
        docs.append((d, " ".join(rng.choices(VOCAB, k=rng.choice([0, 12]))) + " " + " ".join(w) + " " + " ".join(rng.choices(VOCAB, k=rng.choice([0, 15])))))
    want = brute(docs, items)
    df, its = spark.createDataFrame([*docs, docs[0]], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for size in (8 << 20, 2000, 700):
        monkeypatch.setattr(dec, "ITEM_BYTES", size)
        rows = [((r.doc_id, r.item_id), r.similarity) for r in dec.matches(df, its).collect()]
        got = dict(rows)
        assert {k: round(v, 9) for k, v in want.items()} == {k: round(got.get(k, 0), 9) for k in want}
        assert all(len(docs[k[0]][1].split()) < len(items[k[1]][1].split()) for k in set(got) - set(want))  # texts shorter than the item
        assert len(rows) == len(got) + sum(k[0] == 0 for k in got)
        clean = {r.doc_id for r in dec.without_matches(df, its).collect()}
        assert clean == {d for d, _ in docs} - {k[0] for k in got}


def test_a_very_long_text(spark):
    rng = random.Random(2)
    item = " ".join(rng.choices(VOCAB, k=30))
    long = " ".join(rng.choices([f"x{i}" for i in range(5000)], k=200_000))
    docs = spark.createDataFrame([(1, f"{long} {item} {long}"), (2, long)], "doc_id long, text string")
    got = dec.matches(docs, spark.createDataFrame([(7, item)], "item_id long, text string")).collect()
    assert [(r.doc_id, r.item_id, r.similarity, r.start, r.n_words) for r in got] == [(1, 7, 1.0, 200_000, 30)]


def test_recall_of_the_radius_near_the_threshold():
    """Windows of similarity 0.80 to 0.85 whose fingerprint lies within the radius."""
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(5000)]
    items = dec.Items(list(range(200)), [" ".join(rng.choices(vocabulary, k=rng.randint(25, 60))) for _ in range(200)])
    near = within = 0
    for i in range(200):
        own = items.grams[i]
        for _ in range(40):
            grams = own.copy()
            at = rng.randrange(len(grams))
            for j in range(at, min(len(grams), at + rng.choice([3, 4, 5]))):  # one changed word changes up to five shingles
                grams[j] = rng.getrandbits(63)
            if 0.8 <= items.similarity(grams, i) < 0.85:
                near += 1
                within += any(x[1] == i for x in items.within(items.fingerprint(grams[None, :])))
    assert near > 300 and within / near >= 0.995, (near, within / near)
