"""Disclosing terms: copies count once, and every occurrence counts and is generalised."""

from pyspark.sql import functions as F

from tidelog.llm import pii

ALPHABET = "abcdefghijklmnopqrstuvwxyz"


def told(i):
    return f"{ALPHABET[i] * 4} {ALPHABET[-1 - i] * 5} signed Quillfeather writes to boss@example.org about {ALPHABET[i] * 6}"


def fillers(n):
    return [(1000 + i, f"signed letter writes about nothing number {i}") for i in range(n)]


def found(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = pii.sanitise(pii.scan(df)).select("doc_id", "text", "clean", pii.listed(F.filter("found", lambda s: s["kind"] == "term")).alias("spans")).collect()
    assert len(out) == len(rows)
    return {r.doc_id: r for r in out}


def test_copies_do_not_hide_a_term(spark):
    got = found(spark, [(i, told(i)) for i in range(10)] + [(100 + i, told(0)) for i in range(600)] + fillers(300))
    for i in (*range(10), 100, 699):
        assert "Quillfeather" not in got[i].clean and "signed" in got[i].clean


def test_every_occurrence_is_generalised(spark):
    far = " and".join([" so on"] * 60)
    rows = [(i, told(i) + far + " yours, Quillfeather") for i in range(10)] + [(50, "met 'quillfeather' there"), (51, "Quillfeathers, Quill")]
    got = found(spark, rows + fillers(400))
    assert all("quillfeather" not in got[i].clean.lower() and got[i].spans.count("term:") >= 2 for i in range(10))
    assert got[50].spans == "term:5:17" and got[50].clean == "met '[TERM]' there"
    assert got[51].spans == ""


def test_terms_that_stand_far_from_every_mention_count(spark):
    far = " and".join([" so on"] * 60)
    rows = [(i, f"{ALPHABET[i] * 4} boss@example.org {ALPHABET[i] * 6}{far} Quillfeather") for i in range(10)]
    got = found(spark, rows + fillers(400))
    assert all("Quillfeather" not in got[i].clean for i in range(10))


def test_a_passage_in_several_texts_is_one_context(spark):
    far = " and".join([" so on"] * 60)
    rows = [(i, f"{far} only Quillfeather writes to boss@example.org from there {far} {i}") for i in range(10)]
    assert all(r.spans == "" for r in found(spark, rows + fillers(400)).values())


def test_near_copies_of_a_text_tell_nothing(spark):
    words = [f"{ALPHABET[i]}{ALPHABET[j]}{ALPHABET[(i * j) % 26]}word" for i in range(10) for j in range(12)]
    body = " ".join(words[:60]) + " Quillfeather asks boss@example.org " + " ".join(words[60:])
    rows = [(i, body.replace(words[(7 * i) % 120], f"changed{ALPHABET[i % 26] * 3}{ALPHABET[i // 26] * 3}")) for i in range(120)]
    assert all(r.spans == "" for r in found(spark, rows + fillers(400)).values())


def plain(rows, alpha=pii.ALPHA):
    """Term spans by the rule written out, for texts of plain words and one kind of entity."""
    import math
    import re

    texts = sorted({t for _, t in rows})
    mails = re.compile(pii_mail)
    word = re.compile(r"[^\W_](?:[^\W_]|['’-](?=[^\W]))*")
    held = {t: set(m.lower() for m in mails.findall(t)) for t in texts}
    terms = {t: {w.lower() for w in word.findall(mails.sub(" ", t)) if len(w) >= 3} for t in texts}
    n = len(texts)
    told = set()
    for c in {c for x in held.values() for c in x}:
        n_c = sum(c in x for x in held.values())
        for t in {t for x in texts if c in held[x] for t in terms[x]}:
            n_t, n_tc = sum(t in x for x in terms.values()), sum(t in terms[x] and c in held[x] for x in texts)
            if n_tc >= 3 and math.log(n_tc * n / (n_t * n_c)) >= alpha * math.log(n / n_c) - 1e-9:
                told.add(t)
    return {i: [m.span() for m in word.finditer(mails.sub(lambda m: "@" * len(m[0]), t)) if m[0].lower() in told] for i, t in rows}


pii_mail = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"


def test_the_same_terms_as_the_rule_written_out(spark):
    import random

    rng = random.Random(8)
    vocabulary = ["".join(rng.choices(ALPHABET, k=rng.randint(3, 7))) for _ in range(900)]
    rows = []
    for i in range(400):
        words = rng.choices(vocabulary, k=40)
        if i % 8 == 0:  # texts about one of five people: a name of their own and their address, far from each other or near
            who = rng.randrange(5)
            words[rng.randrange(40)] = f"person{who}@mail.example.org"
            words[rng.randrange(40)] = ["Abernathy", "Birtwhistle", "Cholmondeley", "Dunderdale", "Entwistle"][who]
        rows.append((i, " ".join(words)))
    want = plain(rows)
    got = found(spark, rows)
    listed = {i: [tuple(map(int, s.split(":")[1:])) for s in got[i].spans.split(",") if s] for i, _ in rows}
    assert listed == want and sum(map(bool, want.values())) >= 20
