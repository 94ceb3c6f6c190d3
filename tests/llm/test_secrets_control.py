"""The battery and its control against a plain computation, and precision and recall on planted rows."""

import math
import random
import re
import string

import pytest

from tidelog.llm import secrets

RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}")
WORDS = "get set user account name handler config file path build test data value index page service request response client server parser stream batch table column update delete insert report summary draft image photo backup release version notes meeting project customer order invoice payment".split()


def parts(run):
    if not (re.search("[+/]", run) and re.search("[-_]", run)):
        return [(0, run)]
    found = {(m.start(), m[0]) for p in (r"[A-Za-z0-9_-]{20,}={0,2}", r"[A-Za-z0-9+/]{20,}={0,2}") for m in re.finditer(p, run) if re.search("[A-Za-z]", m[0])}
    return sorted(found)


def score(value):
    bare = value.rstrip("=")
    alphabet = next((a for a in secrets.ALPHABETS if set(bare) <= set(a)), None)
    if alphabet is None:
        return None
    c, n, m = [alphabet.index(x) for x in bare], len(bare), len(alphabet)
    normal = lambda x, k: ((max(x, 0) / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    full = normal(m / n * sum(c.count(x) ** 2 for x in set(c)) - n, m - 1)
    cells = max(2, min(m, n // 5))
    cell = [x * cells // m for x in range(m)]
    pooled = normal(sum((sum(cell[x] == j for x in c) - n / m * cell.count(j)) ** 2 / (n / m * cell.count(j)) for j in range(cells)), cells - 1)
    high = [x >= m / 2 for x in c]
    mean = 2 * sum(high) * (n - sum(high)) / n + 1
    var = (mean - 1) * (mean - 2) / (n - 1)
    runs = abs(1 + sum(a != b for a, b in zip(high, high[1:], strict=False)) - mean) / math.sqrt(var) if var > 0 else 6
    avg = sum(c) / n
    ss = sum((x - avg) ** 2 for x in c)
    serial = abs(sum((a - avg) * (b - avg) for a, b in zip(c, c[1:], strict=False)) / ss) * math.sqrt(n) if ss > 1e-9 else 6
    h = math.sqrt(2 / math.pi)
    return n, (full + pooled + runs - h + serial - h) / math.sqrt(3 + 2 * (1 - h * h))


def brute(texts, fdr=0.05):
    """text index -> spans, by the rule written out."""
    places = [(i, m.start() + at, value) for i, t in enumerate(texts) for m in RUN.finditer(t or "") if re.search("[A-Za-z]", m[0]) for at, value in parts(m[0])]
    known = {v: s for v in {v for _, _, v in places} if (s := score(v))}
    line = lambda n: 1.6 * math.sqrt(n) - 5
    e = [z - line(n) for v, (n, z) in known.items() if not re.search("[0-9]", v)]
    shift = min(0.0, sum(e) / (len(e) + 50))
    mean = sum(e) / len(e) if e else 0
    spread = max(1.25, math.sqrt((50 * 1.25**2 + sum((x - mean) ** 2 for x in e)) / (50 + len(e))))
    bins = {v: (max(-1, math.floor(-((z - line(n) - shift) / spread) * 100)) if z <= 3.09 else -1) for v, (n, z) in known.items() if re.search("[0-9]", v)}
    tail = lambda x: math.erfc(x / math.sqrt(2)) / 2
    cut = min((b for b in set(bins.values()) if b >= 0 and tail(b / 100) <= fdr * sum(x >= b for x in bins.values()) / len(bins)), default=None)
    out = {}
    for i, at, v in places:
        if cut is not None and bins.get(v, -1) >= cut:
            out.setdefault(i, set()).add((at, at + len(v)))
    return {i: {x for x in own if not any(y[0] <= x[0] and x[1] <= y[1] and x != y for y in own)} for i, own in out.items()}


def scanned(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    spans = lambda said: {tuple(map(int, s.split(":")[1:])) for s in said.split(",") if s.startswith("random:")}
    rows = secrets.scan(df).select("doc_id", secrets.listed("found").alias("spans")).collect()
    assert len(rows) == len(texts)
    return {r.doc_id: found for r in rows if (found := spans(r.spans))}


def planted():
    rng = random.Random(11)
    keys, plain = [], []
    for alphabet in (secrets.HEX_LOWER, secrets.BASE32, secrets.LOWER36, secrets.BASE62, secrets.BASE64URL):
        for n in (24, 32, 40, 48, 64):
            keys += ["".join(rng.choices(alphabet, k=n)) for _ in range(8)]
    for i in range(600):
        words = rng.choices(WORDS, k=rng.randint(4, 7))
        number = str(rng.randint(0, 9999))
        plain.append([words[0] + "".join(w.title() for w in words[1:]) + number, "-".join([*words, "2019", "04", number]), "/".join([*words, "v" + number]), "_".join([number, *words])][i % 4])
    return keys, plain


def test_precision_and_recall_on_planted_rows(spark):
    keys, plain = planted()
    texts = [f"see {x} here" for x in keys + plain] + ["getUserAccountById2Handler reports/2023-04-01/summary-final-v2", None, "", keys[0] + " " + keys[0]]
    got = scanned(spark, texts)
    assert got == brute([t or "" for t in texts])
    hits, false = sum(i in got for i in range(len(keys))), sum(i in got for i in range(len(keys), len(keys) + len(plain) + 1))
    long = [i for i, k in enumerate(keys) if len(k) >= 32]
    assert hits / (hits + false) >= 0.93 and sum(i in got for i in long) / len(long) >= 0.9, (hits, false, sum(i in got for i in long) / len(long))


def test_identifiers_are_not_found_beside_keys_or_alone(spark):
    keys, plain = planted()
    some = plain[:8]
    alone, beside = scanned(spark, some), scanned(spark, some + keys)
    assert not alone and sum(i in beside for i in range(8)) == 0


def test_letters_of_one_case_and_many_matches(spark):
    rng = random.Random(3)
    key = "".join(rng.choices(string.ascii_letters + string.digits, k=48))
    texts = [" ".join(f"{i}{key}" for i in range(1300)), "a" * 40 + "1", "1" * 50, "-" * 60]
    got = scanned(spark, texts)
    assert got == brute(texts) and len(got[0]) == 1300 and set(got) == {0}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_tables(spark, sf):
    rows = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("text").collect()
    assert scanned(spark, [r.text for r in rows]) == brute([r.text or "" for r in rows])
