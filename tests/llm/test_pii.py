import hashlib
import re

from tidelog.llm import pii

SF = "/root/testdata/sf0.01"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum((int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10))) for i, c in enumerate(reversed(d))) % 10 == 0


def passes(kind, m):
    d = re.sub("[^0-9]", "", m)
    return {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m.split(".")), "card": 12 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]


def base(text):
    out = [(m.start(), rank, m.end(), kind) for rank, (kind, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if passes(kind, m[0])]
    said = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))
    return [sum(x[3] == k for x in out) for k in PATTERNS], hashlib.sha256(said.encode()).hexdigest()


CASES = [
    None, "", "é😀 a.b+c@x-y.co.uk, x@y.zfoo_bar@c.de a@b.c@d.e @x.y a@b", "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.255 1.2.3 99999999999999999999999999999999999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 411111111111111 0000000000000", "+1 (555) 010-9999. +44 20 7946 0958- +1 2 +12345678901234567", "1" * 30_000, "a" * 30_000 + "@", "+1" * 2000, "5" * 12 + " " + "5" * 4 + "  5",
    "x%@a.b..c a@b.c-d.e", "1-1 " * 3000,
]


def test_base_matches_brute_force(spark, tmp_path):
    rows = [(i, t, "clash") for i, t in enumerate(CASES)] + [(0, None, "clash"), (None, "a@b.cd", "x")]
    spark.createDataFrame(rows, "doc_id long, text string, base string").write.parquet(f"{tmp_path}/documents.parquet")
    texts = {i: t for i, t, _ in rows}
    got = pii.op9_pii(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == base(texts[r.doc_id]), texts[r.doc_id][:60]


def test_whole_table_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = pii.op9_pii(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        assert ([r.n_email, r.n_ip, r.n_card, r.n_phone], r.base_sha256) == base(texts[r.doc_id])
        for span in filter(None, r.spans.split(",")):
            kind, a, b = span.split(":")
            if kind == "term":
                assert re.fullmatch(r"[^\W_][\w'’-]*", texts[r.doc_id][int(a) : int(b)])


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert pii.op9_pii(spark, str(tmp_path)).count() == 0
