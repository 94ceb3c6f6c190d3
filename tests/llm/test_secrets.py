import hashlib
import random
import re

import pytest

from tidelog.llm import secrets

SF = "/root/testdata/sf0.001"
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    said = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))
    return [sum(x[3] == k for x in out) for k in ("assign", "access", "hex")], hashlib.sha256(said.encode()).hexdigest()


CASES = [
    None, "", "é😀 password = 'abc' token:abcdef1", "secret=token:abcdefgh API_KEY=\"zzzzzz\" apikey=1234567",
    "AKIA" + "A" * 15 + " AKIA" + "B" * 16 + " akia", "0" * 24 + "g" + "a" * 23 + " " + "f" * 40, "password==abc\npasswd:  'xxxxxxx", "x" * 50_000 + " token=abcdef", "token=" * 3000 + "abcdefg",
]


def test_base_matches_brute_force(spark, tmp_path):
    rows = [(i, t, "clash") for i, t in enumerate(CASES)] + [(0, None, "clash"), (None, "token=abcdefgh", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, found string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = secrets.op2_secrets(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in got:
        n, sha = base(texts[r.doc_id])
        assert [r.n_assign, r.n_access, r.n_hex] == n and r.base_sha256 == sha, r


def test_whole_table_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in secrets.op2_secrets(spark, SF).collect():
        assert ([r.n_assign, r.n_access, r.n_hex], r.base_sha256) == base(texts[r.doc_id])


def test_random_runs_survive_and_words_are_rejected(spark, tmp_path):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    keys = [(i, "ghp " + "".join(rng.choices(letters, k=44)) + " end") for i in range(60)]
    words = ["static", "vendor", "module", "assets", "bundle", "release", "version", "common", "include"]
    paths = [(100 + i, "see " + "/".join(rng.choices(words, k=9)) + f"/v{i % 10} there") for i in range(60)]
    spark.createDataFrame(keys + paths, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r.n_random for r in secrets.op2_secrets(spark, str(tmp_path)).collect()}
    assert sum(got[i] for i, t in keys) >= 54
    assert sum(got[i] for i, t in paths) <= 3


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert secrets.op2_secrets(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize(("z", "p"), [(0.0, 0.5), (1.959964, 0.025), (-1.959964, 0.975), (5.0, 2.8665e-7)])
def test_normal_tail(spark, z, p):
    from pyspark.sql import functions as F

    assert spark.range(1).select(secrets.normal_tail(F.lit(z))).first()[0] == pytest.approx(p, abs=2e-7)
