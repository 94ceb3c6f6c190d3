import zlib

from tidelog.llm import language

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    got = language.op7_language(spark, SF).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and r.lang_pred != "und"]
    right = sum(r.lang_pred == truth[r.doc_id] for r in held)
    assert right / len(held) > 0.97, right / len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_known_words_before_grams_and_defined_cases(spark):
    rows = [(1, "der hund und die katze", "de"), (2, "the dog and the cat", "en"), (3, None, "xx"), (4, "ohne", None)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.langs == ["de", "en"]
    one = lambda t: (lambda r: (r[0][0], float(r[1][0])))(model.predict([t]))
    assert one("The dog!")[0] == "en" and one("HUND")[0] == "de"
    assert one("hunde katzen")[0] == "de"  # unseen: by n-grams
    assert one(None) == ("und", 0.0) and one("12 !?") == ("und", 0.0) and one("")[0] == "und"
    assert one("жжж") == ("de", 0.5)  # nothing seen: a tie, the first
    assert model.predict(["the cat", None, "der hund", "хх"])[0] == ["en", "und", "de", "de"]
    docs = spark.createDataFrame([(1, False, None, "x"), (1, False, None, "x"), (None, True, "the cat " * 20000, "y")], "doc_id long, held_out boolean, text string, lang string")
    got = language.predict(docs, model).collect()
    assert [r.lang_pred for r in sorted(got, key=lambda r: r.lang_pred)] == ["en", "und", "und"]
    empty = language.train(docs.where("false"))
    assert language.predict(docs, empty).where("lang_pred <> 'und'").count() == 0


def test_backing_off_matches_brute_force(spark):
    """Scores of unseen words against a plain count of n-grams."""
    import math
    from collections import Counter

    rows = [(1, "abcab cabba abca", "x"), (2, "bcdbc cdbbd abd", "y"), (3, "aa bb aa", "x")]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    tables = {}
    for n in range(1, 6):
        for lang in "xy":
            grams = Counter()
            for _, t, own in rows:
                for w in t.split():
                    p = w if n == 1 else f"<{w}>"
                    if own == lang:
                        grams.update(p[i : i + n] for i in range(len(p) - n + 1))
            tables[n, lang] = grams
    for word in ("abcd", "zzabz", "d", "zz", "cabbax"):
        want = [0.0, 0.0]
        for n in range(5, 0, -1):
            p = word if n == 1 else f"<{word}>"
            seen = [g for g in (p[i : i + n] for i in range(len(p) - n + 1)) if tables[n, "x"][g] + tables[n, "y"][g]]
            if seen:
                size = len(set(tables[n, "x"]) | set(tables[n, "y"]))
                want = [sum(math.log((tables[n, la][g] + 0.5) / (sum(tables[n, la].values()) + 0.5 * size)) for g in seen) / len(seen) for la in "xy"]
                break
        got = model.back_off([word])[0]
        assert abs(got[0] - want[0]) < 1e-4 and abs(got[1] - want[1]) < 1e-4, word


def test_numerals_are_no_letters(spark):
    docs = spark.createDataFrame([(1, "der hund", "de"), (2, "the dog", "en")], "doc_id long, text string, lang string")
    model = language.train(docs)
    names, scores = model.predict(["² ½", "Ⅷ ① 12", "m² the", "ß"])
    assert names[:2] == ["und", "und"] and list(scores[:2]) == [0, 0] and names[2] == "en" and names[3] != "und"
    assert language.words_of("Œuvre, m² x3y ½") == ["œuvre", "m", "x", "y"]
