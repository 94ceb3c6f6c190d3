"""Nothing that was counted falls out of the model, and the tables score like the model in one process."""

import random

from tidelog.llm import language
from tidelog.llm.scratch import Scratch


def test_every_counted_word_is_known(spark):
    names = ["".join(chr(97 + int(c)) for c in f"{i:06d}") for i in range(110_000)]
    rows = [(i, " ".join(names[a : a + 11_000] * 2), "xx") for i, a in enumerate(range(0, 110_000, 11_000))] + [(99, "zq", "yy")]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))
    assert len(model.rows) == 110_001 and "zq" in model.rows


def test_tables_score_as_the_model(spark, monkeypatch):
    rng = random.Random(3)
    word = lambda letters: "".join(rng.choices(letters, k=rng.randint(1, 8)))
    text = lambda letters: " ".join(word(letters) for _ in range(rng.randint(0, 40)))
    rows = [(i, False, text("abcde" if i % 2 else "defgh"), "x" if i % 2 else "y") for i in range(60)]
    asked = [(i, True, t, None) for i, t in enumerate([None, "", "12 !?", "жжж", "abжж", *(text("abcdefgh") for _ in range(80))])]
    docs = spark.createDataFrame([*rows, *asked, asked[9], (None, *asked[9][1:])], "doc_id long, held_out boolean, text string, lang string").repartition(3)
    monkeypatch.setattr(language, "CHUNK", 1500)
    scratch = Scratch(spark)
    learn = docs.where("not held_out")
    want, got = (sorted(map(str, ((r.doc_id, r.held_out, r.lang_pred, round(r.score, 4)) for r in df.collect()))) for df in (language.predict(docs, language.train(learn)), language.identified(docs, language.Counts(learn, scratch), scratch)))
    assert got == want and len(got) == len(rows) + len(asked) + 2
    none = language.identified(docs, language.Counts(docs.where("false"), scratch), scratch)
    assert none.where("lang_pred = 'und'").count() == len(got)


def test_chunks_without_words_or_without_unseen_words(spark):
    schema = "doc_id long, held_out boolean, text string, lang string"
    scratch = Scratch(spark)
    counts = language.Counts(spark.createDataFrame([(1, False, "der hund", "de"), (2, False, "the dog", "en")], schema), scratch)
    for text, want in (("12 !?", "und"), (None, "und"), ("the dog", "en"), ("hunde", "de")):
        got = language.identified(spark.createDataFrame([(3, True, text, None)], schema), counts, scratch).collect()
        assert [r.lang_pred for r in got] == [want]
