import base64
import hashlib
import struct

import duckdb
import zstandard

from tidelog.llm import warc

SF = "/root/testdata/sf0.001"


def expected(rows, least_size=0):
    first = {}
    for p, h in rows:
        if p is not None:
            first[h] = min(p, first.get(h, p))
    out = []
    for p, h in rows:
        data = (h or "").encode()
        to = first.get(h) if p is not None and len(data) >= least_size and first.get(h) != p else None
        out.append((p is None, p, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


def test_whole_table(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").collect()
    got = sorted(((r.page_id is None, r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.op3_warc(spark, SF).collect()), key=str)
    assert got == expected([(r.page_id, r.html) for r in pages])


def test_oracle(spark):
    db = duckdb.connect()
    db.execute(f"create view pages as select * from '{SF}/pages.parquet'")
    want = sorted(db.execute(f"select page_id, payload_bytes, payload_digest, record_type, refers_to from ({warc.OP3_SQL})").fetchall())
    assert sorted(map(tuple, warc.op3_warc(spark, SF).collect())) == want


def test_copies_nulls_and_seeking(spark, tmp_path):
    big = "é" * 700_000
    rows = [(5, "u5", "same"), (3, "u3", "same"), (9, None, "same"), (7, "http://x/\r\ny", None), (8, "u8", ""), (1, "u", big), (2, "v", big + "x"), (None, None, "same"), (4, "w ", "\r\n\r\nWARC/1.1")]
    df = spark.createDataFrame([(*r, "z") for r in rows], "page_id long, url string, html string, size string").repartition(3)
    index = warc.write(df, f"file://{tmp_path}/bundles")
    got = warc.read(index).collect()
    want = expected([(r[0], r[2] or "") for r in rows])
    assert sorted(((r.page_id is None, r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == want
    payloads = {r.page_id: r.payload for r in got if r.record_type == "response" and r.page_id is not None}
    assert payloads[1].decode() == big and payloads[4] == b"\r\n\r\nWARC/1.1"
    assert {r.page_id: r.url for r in got}[7] == "http://x/\r\ny"
    fields, block = warc.seek(index, warc.record_id(2, None))
    assert fields["X-Page-ID"] == "2" and block.decode() == big + "x"
    assert warc.seek(index, "none") is None


def test_bundle_is_a_valid_seekable_file(spark, tmp_path):
    df = spark.createDataFrame([(i, f"u{i}", chr(97 + i % 26) * 300_000) for i in range(12)], "page_id long, url string, html string").coalesce(1)
    warc.write(df, f"file://{tmp_path}/bundles").count()
    (path,) = (tmp_path / "bundles").glob("*.warc.zst")
    data = path.read_bytes()
    sizes = warc.read_seek_table(data)
    assert len(sizes) > 1 and sum(c for c, _ in sizes) + 8 + len(sizes) * 8 + 9 == len(data)
    assert struct.unpack_from("<I", data, sum(c for c, _ in sizes))[0] == warc.SKIPPABLE
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert len(whole) == sum(n for _, n in sizes) and whole.count(b"WARC/1.1\r\n") == 12


def test_smaller_payloads_are_all_responses(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "xy"), (2, "b", "xy"), (3, "c", "xyz"), (4, "d", "xyz")], "page_id long, url string, html string")
    got = {r.page_id: (r.record_type, r.refers_to) for r in warc.read(warc.write(df, f"file://{tmp_path}/b", 3)).collect()}
    assert got == {1: ("response", None), 2: ("response", None), 3: ("response", None), 4: ("revisit", 3)}


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read(warc.write(df, f"file://{tmp_path}/b")).count() == 0


def test_a_block_that_is_not_what_its_headers_say(spark, tmp_path):
    import pytest

    df = spark.createDataFrame([(1, "http://a/", "one"), (2, "http://a/", "two")], "page_id long, url string, html string")
    index = warc.write(df.coalesce(1), f"file://{tmp_path}/w")
    assert warc.read(index).count() == 2
    path = index.first().bundle.removeprefix("file://")
    with open(path, "rb") as f:
        data = f.read()
    first = index.first()
    raw = zstandard.ZstdDecompressor().decompress(data[first.frame_at : first.frame_at + first.frame_size], max_output_size=first.raw_size)
    changed = zstandard.ZstdCompressor().compress(raw.replace(b"\r\n\r\none", b"\r\n\r\nONE"))
    with open(path, "wb") as f:
        f.write(changed)
    from pyspark.sql import functions as F

    with pytest.raises(Exception, match="headers"):
        warc.read(index.withColumn("frame_size", F.lit(len(changed)).cast("long"))).collect()


def test_records_without_a_page_have_identifiers_of_their_own(spark, tmp_path):
    df = spark.createDataFrame([(None, "http://a/", "one"), (None, "http://a/", "two"), (None, None, None)], "page_id long, url string, html string")
    index = warc.write(df, f"file://{tmp_path}/w").collect()
    assert len({r.record_id for r in index}) == 3
    full = warc.write(df, f"file://{tmp_path}/v")
    for r in full.collect():
        assert warc.seek(full, r.record_id)[0]["WARC-Record-ID"] == f"<{r.record_id}>"
