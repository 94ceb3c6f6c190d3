import re

import sentencepiece

import corpus_pipeline as cp
from tidelog.llm import pieces, pii

SF = "/root/testdata/sf0.01"


def stage(i, spark, docs):
    return cp.STAGES[i][1](spark, docs, SF)


def shingles(text, k=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_stages_on_the_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = stage(0, spark, docs).cache()
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    good = [d for d, q in labels.items() if q == 1]
    bad = [d for d, q in labels.items() if q == 0]
    assert sum(d in ids for d in good) > 0.9 * len(good) and sum(d in ids for d in bad) < 0.1 * len(bad)

    once = stage(1, spark, kept).cache()
    sets = {r.doc_id: shingles(r.text) for r in kept.collect()}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = {}
    for d, s in sets.items():
        near = {e for g in s for e in index.get(g, ())}
        for e in near:
            if 100 * len(s & sets[e]) >= 80 * len(s | sets[e]):
                a, b = find(d), find(e)
                root[max(a, b)] = min(a, b)
        for g in s:
            index.setdefault(g, []).append(d)
    assert {r.doc_id for r in once.collect()} == {find(d) for d in sets}

    clean = stage(2, spark, once).cache()
    words = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r.doc_id for r in once.collect() if any(i in words(r.text) for i in items)}
    left = {r.doc_id for r in clean.collect()}
    assert held and not held & left and len(left) >= once.count() - len(held) - 3

    safe = stage(3, spark, clean).cache()
    assert safe.columns == docs.columns and safe.count() == clean.count()
    before = {r.doc_id: r.text for r in clean.collect()}
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
    for r in safe.collect():
        assert not email.search(r.text) and r.n_chars == len(r.text)
        assert r.text == before[r.doc_id] or "[" in r.text

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    texts = {r.doc_id: r.text for r in safe.collect()}
    for r in stage(4, spark, safe).collect():
        assert r.ids == lib.encode(texts[r.doc_id])


def test_run_is_the_chain_of_stages(spark):
    assert [n for n, _ in cp.STAGES] == ["quality rules", "n-gram Jaccard join", "benchmark decontamination", "PII", "SentencePiece"]
    got = cp.run(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "n_tokens", "ids", "round_trip"] and got.count() > 50


def test_nulls_repeats_empty_texts_and_extra_columns(spark):
    long = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None, None, "s", 0, "x"), (2, "", "en", None, 0, "x"), (3, long, "en", "s", None, "x"), (3, long, "en", "s", None, "x"), (None, long + " a@b.cd", "en", "s", 1, "x"), (5, long.upper(), "en", "s", 1, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, base string")
    for i, n in ((0, 4), (1, 3), (2, 6), (3, 6), (4, 6)):
        got = stage(i, spark, docs)
        assert got.count() == n, (i, got.collect())
        assert stage(i, spark, docs.where("false")).count() == 0
        if i < 4:
            assert got.columns == docs.columns
    assert {r.text for r in stage(3, spark, docs).collect()} == {None, "", long, long + " [EMAIL]", long.upper()}


def test_disclosing_terms_are_generalised(spark):
    """A name met with one address in several contexts goes with it; common words stay."""
    filler = [f"filler{i} text{i}" for i in range(40)]
    rows = [(i, f"{filler[i]} the Zworykin wrote from z@lab.org about {filler[i + 1]} today") for i in range(6)]
    rows += [(100 + i, f"the text about {filler[i]} today") for i in range(30)]
    found = pii.sanitise(pii.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()
    texts = {r.doc_id: r.clean for r in found}
    assert all("Zworykin" not in texts[i] and "[NAME]" in texts[i] and "[EMAIL]" in texts[i] and " about " in texts[i] and texts[i].endswith("today") for i in range(6))
    assert all(texts[100 + i] == rows[6 + i][1] for i in range(30))
