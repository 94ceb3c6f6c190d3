"""Near-duplicates where ids repeat or are missing."""

import corpus_pipeline as cp


def test_repeated_and_missing_ids(spark):
    text = {x: " ".join(f"{x}{i}" for i in range(60)) for x in "abcd"}
    near = text["b"].replace("b59", "changed")
    rows = [(3, text["b"]), (7, text["a"]), (7, text["b"]), (None, text["b"]), (None, text["c"]), (None, text["c"]), (None, text["d"]), (9, near), (2, None), (2, None), (4, None), (None, ""), (5, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, mark string").repartition(3)
    got = cp.STAGES[1][1](spark, docs, "")
    assert got.columns == docs.columns
    want = [(3, text["b"]), (7, text["a"]), (None, text["c"]), (None, text["d"]), (2, None), (4, None), (None, ""), (5, "")]
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(want, key=str)
