"""Queries of the catalog over the change log cover every row of their table."""

from tidelog.catalog import QUERIES

SF = "/root/testdata/sf0.01"


def test_every_row_is_covered(spark):
    events = spark.read.parquet(f"{SF}/events.parquet").select("event_id", "user_id", "event_type").collect()
    visible = QUERIES["snapshot_visibility"](spark, SF).collect()
    assert sorted((r.offset, r.snapshot_id) for r in visible) == sorted((e.event_id, s) for e in events for s in ("s1", "s2", "s3"))
    assert sorted(r.event_id for r in QUERIES["sse_events"](spark, SF).collect()) == sorted(e.event_id for e in events)
    op = {"signup": "insert", "error": "delete"}
    seen = {(e.user_id, op.get(e.event_type, "update"), 100 + e.event_id // 5) for e in events}
    done = {(e.user_id, op.get(e.event_type, "update"), 100 + e.event_id // 5) for e in events if e.event_id % 2 == 0}
    got = [(r.row_id, r.op, r.txid) for r in QUERIES["optimistic_retirement"](spark, SF).collect()]
    assert max(k for k, _, _ in got) >= 50 and sorted(got) == sorted(seen - done)
