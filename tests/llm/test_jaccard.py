import random
import re

import pytest

from tidelog.llm import jaccard

WORDS = [f"w{i}" for i in range(400)]


def brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((d is None, d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows))


def corpus(seed, percent):
    """Families of near copies at many distances, so that classes hang together by chains."""
    rng = random.Random(seed)
    rows = []
    for family in range(8):
        text = rng.choices(WORDS, k=rng.choice([12, 40, 90]))
        for _ in range(rng.choice([2, 9, 25])):
            copy = list(text)
            for _ in range(rng.randint(0, max(1, len(text) * (100 - percent) // 250))):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            rows.append(" ".join(copy))
            if rng.random() < 0.5:
                text = copy
    rows += [" ".join(rng.choices(WORDS, k=30)) for _ in range(20)]
    rng.shuffle(rows)
    return list(enumerate(rows, 100))


@pytest.mark.parametrize(("seed", "k", "percent"), [(1, 3, 90), (2, 5, 80)])
def test_matches_brute_force(spark, seed, k, percent):
    rows = corpus(seed, percent) + [(1, None), (2, ""), (3, " \t\n"), (4, "A b"), (5, "a B"), (6, "a b c"), (7, "é"), (7, "é"), (8, "one"), (9, "x " * 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(df, k, percent).collect())
    assert got == brute(rows, k, percent)


def test_many_pivots_of_one_region(spark):
    """Texts that share most rare shingles without being near: regions that need several rounds."""
    rng = random.Random(9)
    shared = [f"s{i}" for i in range(30)]
    rows = [(i, " ".join(shared[: 10 + i % 20] + rng.choices(WORDS, k=25))) for i in range(60)]
    got = sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 80).collect())
    assert got == brute(rows, 3, 80)


def test_empty_and_clashing_columns(spark):
    assert jaccard.join(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(None, "a b c d", 1, "x"), (None, "a b c d", 2, "y"), (3, "q", 3, "z")], "doc_id long, text string, node int, region string")
    got = jaccard.join(df).collect()
    assert [(r.doc_id, r.component_id) for r in sorted(got, key=lambda r: r.doc_id or 0)] == [(None, None), (None, None), (3, 3)]
