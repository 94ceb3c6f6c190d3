import random

import pytest
from pyspark.sql import functions as F

from tidelog.functions import rowkey
from tidelog.operators import cdc, membership
from tidelog.streaming import pipeline
from tidelog.streaming.metadata import Metadata
from tidelog.streaming.quarantine import Quarantined, check
from tidelog.streaming.store import GenerationTable


@pytest.mark.parametrize(("tx", "xmin", "xmax", "xip", "want"), [(99, "100", "200", [], True), (150, "100", "200", [], True), (200, "100", "200", [], False), (250, "100", "200", [], False), (150, "100", "200", ["150"], False), (150, "x", "200", [], False), (None, "1", "2", [], False)])
def test_visibility(spark, tx, xmin, xmax, xip, want):
    df = spark.createDataFrame([(tx, xmin, xmax, xip)], "tx long, xmin string, xmax string, xip array<string>")
    assert df.select(cdc.visible(F.col("tx"), F.col("xmin"), F.col("xmax"), F.col("xip"))).first()[0] is want


def test_snapshot_overlap_and_retirement(spark):
    live = spark.createDataFrame([(1, "a", [10, 150]), (2, "a", None), (3, "b", [150]), (4, None, [150]), (5, "c", [200]), (6, "a", [150])], "offset int, key string, txids array<bigint>")
    snaps = spark.createDataFrame([("s", "50", "200", [])], "snapshot_id string, xmin string, xmax string, xip array<string>")
    tracked = spark.createDataFrame([("s", "a")], "snapshot_id string, key string")
    assert [r.offset for r in cdc.without_snapshot_overlap(live, snaps, tracked).orderBy("offset").collect()] == [2, 3, 4, 5, 6]


def test_partial_rows_do_not_leak_over_deletes(spark):
    rows = [(1, "k", "insert", "a", True, 1, True), (2, "k", "delete", None, False, None, False), (3, "k", "insert", "b", True, None, False), (4, "k", "update", None, True, None, False), (5, "m", "update", "x", True, 1, True)]
    df = spark.createDataFrame(rows, "offset int, key string, op string, v string, has_v boolean, k int, has_k boolean")
    assert [tuple(r) for r in cdc.partial_rows(df, {"v": "has_v", "k": "has_k"}).collect()] == [("k", None, None, 4)]
    assert {r.key for r in cdc.missing_updates(df).collect()} == {"m"}
    assert cdc.missing_updates(df, existing=spark.createDataFrame([("m",)], "key string")).count() == 0


def test_row_keys(spark):
    assert rowkey.parse_text('"foo..bar"."baz"/"a//b"/_') == ("foo.bar", "baz", ["a/b", None]) and rowkey.encode_text("foo.bar", "baz", ["a/b", None]) == '"foo..bar"."baz"/"a//b"/_'
    x = spark.createDataFrame([('"foo..bar"."baz"/"a//b"/_',)], "k string").select(rowkey.parse(F.col("k")).alias("x")).first().x
    assert (x.schema, x.table, x.pk) == ("foo.bar", "baz", ["a/b", None])
    with pytest.raises(ValueError, match="not a row key"):
        rowkey.parse_text("x.y/1")


def test_completion_and_observation(spark):
    df = spark.createDataFrame([(1, "snapshot_end", True, "x", "s1"), (2, None, True, "", None), (3, None, False, "y", "s2")], "offset int, control string, is_subset_snapshot boolean, payload string, snapshot string")
    assert tuple(cdc.completion(df, was_up_to_date=True).first()) == (True, True) and tuple(cdc.completion(df).first()) == (True, False)
    assert tuple(cdc.observation(df).first()) == ("present", "s2") and cdc.observation(df.where("offset = 2")).first().outcome == "absent"
    seen = spark.createDataFrame([([5],)], "txids array<bigint>")
    snaps = spark.createDataFrame([("10", "20", [])], "xmin string, xmax string, xip array<string>")
    assert cdc.txid_seen(seen, snaps, 5) and cdc.txid_seen(seen, snaps, 9) and not cdc.txid_seen(seen, snaps, 20)


def dnf(spark, tags, events, positions=None):
    rows = spark.createDataFrame([("r", tags, [True] * len(tags[0].split("/")))], "k string, tags array<string>, active array<boolean>")
    ev = spark.createDataFrame([(i + 1, *e) for i, e in enumerate(events)], "seq long, kind string, pos int, value string")
    return membership.dnf_fold(rows, ev, "k", positions if positions is not None else membership.disjuncts(tags)).first()


def test_dnf():
    assert membership.disjuncts(["a/b/", "//c"]) == [[0, 1], [2]]


def test_dnf_lifetimes(spark):
    two = ["hash_a/", "/hash_b"]
    assert dnf(spark, two, [("move_out", 0, "hash_a")]).evicted_at is None
    assert dnf(spark, two, [("move_out", 0, "hash_a"), ("move_out", 1, "hash_b")]).evicted_at == 2
    assert dnf(spark, two, [("move_out", 0, "hash_a"), ("move_in", 0, "hash_a"), ("move_out", 1, "hash_b")]).evicted_at is None
    assert dnf(spark, two, [("move_out", 0, "hash_a"), ("move_out", 1, "hash_b"), ("move_in", 0, "hash_a")]).evicted_at == 2  # for good
    three = ["hash_a/hash_b/", "//hash_c"]
    assert dnf(spark, three, [("move_out", 0, "hash_a")]).evicted_at is None and dnf(spark, three, [("move_out", 0, "hash_a"), ("move_out", 2, "hash_c")]).evicted_at == 2
    assert dnf(spark, two, [("move_out", 0, "other")]).active == [True, True]


def test_moved_out(spark):
    rows = spark.createDataFrame([(1, ["a/b"]), (2, ["a/b", "c/d"]), (3, []), (4, ["a/"]), (5, ["x/_"])], "k int, tags array<string>")
    p = spark.createDataFrame([(0, "a")], "pos int, value string")
    assert sorted(r.k for r in membership.moved_out(rows, p, "k").collect()) == [1, 4]
    q = spark.createDataFrame([(1, "zz"), (0, "c")], "pos int, value string")
    assert sorted(r.k for r in membership.moved_out(rows, q, "k", legacy=True).collect()) == [5]


def test_tag_fold(spark):
    rows = [(1, "r", "insert", ["a/b"], []), (2, "r", "update", ["c/d"], ["a/b"]), (3, "r", "update", ["a/b/c"], []), (4, "s", "insert", ["a/b"], ["a/b"]), (5, "t", "insert", ["a/b"], []), (6, "t", "delete", [], [])]
    df = spark.createDataFrame(rows, "offset int, key string, op string, tags array<string>, removed_tags array<string>")
    assert sorted(map(tuple, membership.tag_fold(df).collect())) == [("r", "c/d"), ("s", "a/b")]


def test_store_commits_rows_and_state_together(spark, tmp_path):
    t = GenerationTable(spark, f"file://{tmp_path}/t", ["key"], 4)
    rows = lambda *x: spark.createDataFrame(list(x), "key int, v string")
    none = rows((0, "x")).where("false")
    assert t.read() is None and t.merge(rows(*((i, "a") for i in range(20))), none, {"offset": "1"}, 0)
    old = t.read()
    assert t.merge(rows((3, "b"), (100, "n")), rows((4, "")), {"offset": "2"}, 1) and not t.merge(rows((5, "z")), none, {"offset": "9"}, 1)
    got = {r.key: r.v for r in t.read().collect()}
    assert got[3] == "b" and 4 not in got and got[100] == "n" and len(got) == 20 and t.state() == {"offset": "2"}
    assert old.count() == 20  # a reader of the old generation still sees it whole
    assert t.replace(rows((7, "only")), {}, 2) and [r.key for r in t.read().collect()] == [7]
    t.vacuum()
    assert t.read().count() == 1


def test_reset_replaces_at_the_next_clean_batch(spark, tmp_path):
    t = GenerationTable(spark, f"file://{tmp_path}/t", ["key"], 2)
    batch = lambda *x: spark.createDataFrame(list(x), "offset int, key string, op string, v int, control string")
    pipeline.apply_batch(t, batch((1, "a", "insert", 1, None), (2, "b", "insert", 2, None)), 0)
    pipeline.apply_batch(t, batch((3, "c", "insert", 3, None), (4, None, None, None, "must_refetch")), 1)
    assert {r.key for r in t.read().collect()} == {"a", "b"} and t.state()["replacing"]
    pipeline.apply_batch(t, batch((5, "z", "insert", 9, None), (6, None, None, None, "up_to_date")), 2)
    assert {r.key for r in t.read().collect()} == {"z"} and "replacing" not in t.state() and t.state()["offset"] == "5"
    assert not pipeline.apply_batch(t, batch((5, "y", "insert", 9, None)), 2)


def test_stream_equals_batch(spark):
    rng = random.Random(4)
    rows = [(i, f"k{rng.randrange(30)}", rng.choice(["insert", "update", "update", "delete"]), i) for i in range(400)]
    df = spark.createDataFrame(rows, "offset int, key string, op string, v int")
    assert sorted(map(tuple, pipeline.replay(spark, df).select("key", "offset").collect())) == sorted(map(tuple, cdc.current_rows(df).select("key", "offset").collect()))


def test_quarantine_rejects_whole_batches(spark, tmp_path):
    cols = "offset int, key string, op string, v int, schema string, version string, control string, event string, tags array<string>, active_conditions array<boolean>"
    good, bad = (1, "a", "insert", 1, "public", "1", None, None, ["x/y"], [True, True]), (2, "b", "insert", 1, "public", "2", None, None, ["x/y"], [True, True])
    check(spark.createDataFrame([good], cols), 2)
    t = GenerationTable(spark, f"file://{tmp_path}/t", ["key"], 2)
    with pytest.raises(Quarantined) as e:
        pipeline.apply_batch(t, spark.createDataFrame([good, bad], cols), 0, 2)
    assert e.value.reasons == {"version": 1} and t.read() is None


def test_ownership(spark, tmp_path):
    m = Metadata(spark, f"file://{tmp_path}/m")
    own = lambda *x: spark.createDataFrame(list(x), "table string, row_key string, shape_id string, tags array<string>")
    m.claim(own(("t", "1", "s", ["a"]), ("t", "1", "u", []), ("t", "2", "s", ["b"])), 0)
    free = m.release(own(("t", "1", "s", []), ("t", "2", "s", []), ("t", "2", "other", [])), 1)
    assert [r.row_key for r in free.collect()] == ["2"] and m.owned().count() == 1 and m.rebuild_tags("t", "u").count() == 1
    m.record_range("t", "row_key", m.owned())
    assert m.ranges["t|row_key"] == {"min": "1", "max": "1", "count": 1}
