"""Random tokens in runs that fit no alphabet."""

import random
import string

from tidelog.llm import secrets


def test_tokens_in_hyphenated_paths(spark, tmp_path):
    rng = random.Random(7)
    texts = {}
    for i in range(60):
        token = "".join(rng.choices(string.ascii_letters + string.digits, k=40))
        texts[i] = (f"see host.com/build-7/job/{token} there", token)
    spark.createDataFrame([(i, t) for i, (t, _) in texts.items()], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    hit = 0
    for r in secrets.op2_secrets(spark, str(tmp_path)).collect():
        text, token = texts[r.doc_id]
        at = text.index(token)
        found = [tuple(map(int, s.split(":")[1:])) for s in r.spans.split(",") if s.startswith("random:")]
        assert all(text[a:b] == text[a:b].strip() and b <= at + 40 for a, b in found)
        hit += any(a <= at and at + 40 <= b for a, b in found)
    assert hit >= 54
