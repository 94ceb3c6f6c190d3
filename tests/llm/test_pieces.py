import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm import pieces

SF = "/root/testdata/sf0.001"
LIB = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
CASES = ["", " ", "  a   b    c     d", "ﬁ Ⅻ é é\t\n\n  x", "😀😀\x00", "a" * 3000, " " * 1000, "中文漢字かな한국어 עברית हिन्दी", "<unk> <s> </s> <0x41>", "    def f(x):\n        return x\n", "1234567890 ====--- !!!!!!!"]


@pytest.mark.parametrize("text", CASES)
def test_same_as_the_library(text):
    fst = pieces.load(pieces.MODEL)
    ids = fst.encode(text).tolist()
    assert ids == LIB.encode(text) and fst.decode(ids) == text


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab hetin.,éñ中😀\n\t  _-019"), max_size=60))
def test_any_text_round_trips(text):
    fst = pieces.load(pieces.MODEL)
    assert fst.encode(text).tolist() == LIB.encode(text) and fst.decode(fst.encode(text)) == text


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = pieces.op1_sentencepiece(spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.ids == LIB.encode(docs[r.doc_id]) and r.n_tokens == len(r.ids) and r.round_trip


def test_defined_cases(spark):
    df = spark.createDataFrame([(1, None, 0), (1, None, 0), (None, "", 0), (2, "a▁b", 0), (3, "long " * 50_000, 0)], "doc_id long, text string, ids int")
    got = pieces.encode(df)
    rows = {(r.doc_id, r.ids is None): r for r in got.collect()}
    assert rows[1, True].round_trip and rows[None, False].ids == [] and not rows[2, False].round_trip
    assert rows[3, False].round_trip and rows[3, False].ids == LIB.encode("long " * 50_000)
    back = {r.doc_id: r.text for r in pieces.decode(got.where("doc_id in (1, 3)")).collect()}
    assert back == {1: None, 3: "long " * 50_000}
    assert pieces.encode(df.where("false")).count() == 0
