import threading

import pytest

from tidelog.collection import Collection, CollectionError
from tidelog.functions.predicates import FALSE, And, Compare, In, PredicateError, equal, predicate_key
from tidelog.plans.coverage import Cursor, DedupLoader, Entry, Query, coalesces, compute_missing, demand_order, is_bounded, is_finite, records_coverage, scoped_key
from tidelog.plans.subset import subset
from tidelog.sources.changelog import EventParser, PagedRead, SourceError, decode_header_error, starting_options
from tidelog.streaming.breaker import CircuitBreaker, supervised
from tidelog.streaming.metadata import Metadata, SyncState, adopt, epoch_fence, latch_topology, needs_bootstrap, shape_identity
from tidelog.streaming.store import GenerationTable

AGE = lambda op, v: Compare("age", op, v)


def entry(p, complete=True, scoped=False, key=None):
    return Entry("t", key or predicate_key(p), p, complete, scoped=scoped)


def test_compute_missing():
    q = Query(AGE(">", 10))
    assert compute_missing(q, [entry(AGE(">", 10))]).remainder is None
    assert compute_missing(q, [entry(AGE(">", 5))]).remainder is None
    assert equal(compute_missing(q, [entry(AGE(">", 20))]).remainder, And((AGE(">", 10), AGE("<=", 20))))
    assert equal(compute_missing(q, [entry(AGE(">", 5), complete=False)]).remainder, AGE(">", 10))
    page = Query(AGE(">", 10), (("age", True),), 5)
    assert equal(compute_missing(page, [entry(AGE(">", 20))]).remainder, AGE(">", 10))  # a page is read whole
    assert compute_missing(page, [entry(AGE(">", 1))]).remainder is None  # a full fetch answers a page
    assert compute_missing(page, [entry(None, scoped=True, key=scoped_key(page))]).remainder is None
    assert equal(compute_missing(q, [entry(AGE(">", 10), scoped=True, key=scoped_key(page))]).remainder, AGE(">", 10))  # a page answers no full request
    assert compute_missing(Query(), [entry(None)]).remainder is None and compute_missing(q, [entry(AGE("<", 15)), entry(AGE(">=", 15))]).remainder is None


def test_rules():
    page = Query(AGE(">", 1), (), 5)
    assert not records_coverage("progressive", page, False) and not records_coverage("on_demand", Query(AGE(">", 1)), True) and records_coverage("eager", Query(), True)
    assert is_bounded(page) and not is_bounded(Query()) and not is_bounded(Query(AGE(">", 1), (), 0))
    assert is_finite(AGE("=", 1) & Compare("b", ">", 1)) and not is_finite(AGE("=", 1) | AGE(">", 5)) and is_finite(In("a", (1,)))
    a, b = Query(AGE(">", 1)), Query(AGE(">", 5))
    assert coalesces(a, b) and not coalesces(b, a) and not coalesces(page, Query(AGE(">", 2), (), 5))
    assert demand_order([b, a, a], first=b) == [b, a]


def test_dedup_loader():
    asked = []
    loader = DedupLoader(asked.append)
    assert not loader.request(Query(AGE(">", 10))) and loader.request(Query(AGE(">", 20))) and loader.request(Query(AGE(">", 11), (), 5))
    assert not loader.request(Query(AGE(">", 5))) and equal(asked[-1].predicate, And((AGE(">", 5), AGE("<=", 10))))
    assert not loader.request(Query()) and loader.request(Query(AGE("<", 0)))
    loader.reset()
    assert not loader.request(Query(AGE(">", 10), (("age", True),), 5)) and loader.request(Query(AGE(">", 10), (("age", True),), 3)) and not loader.request(Query(AGE(">", 10)))


def test_dedup_loader_joins_what_is_on_its_way():
    gate, seen = threading.Event(), []

    def load(q):
        seen.append(q)
        gate.wait(5)

    loader = DedupLoader(load)
    first = threading.Thread(target=loader.request, args=(Query(AGE(">", 1)),))
    first.start()
    while not seen:
        pass
    out = []
    second = threading.Thread(target=lambda: out.append(loader.request(Query(AGE(">", 2)))))
    second.start()
    gate.set()
    first.join(5)
    second.join(5)
    assert out == [True] and len(seen) == 1


def test_pages_tie_safe(spark):
    df = spark.createDataFrame([(i, [100, 100, 90, None, 80, 100][i]) for i in range(6)], "id int, created_at int")
    cursor = Cursor(Compare("createdAt", "<", 100), Compare("createdAt", "=", 100))
    got = [r.id for r in subset(df, Query(Compare("id", ">", 0), (("createdAt", False),), 1, cursor), key=("id",)).collect()]
    assert sorted(got[:2]) == [1, 5] and got[2:] == [2]
    assert [r.id for r in subset(df, Query(None, (("createdAt", False),), 2), key=("id",)).collect()] == [3, 0]
    assert [r.id for r in subset(df, Query(None, (("createdAt", True),)), key=("id",)).collect()][-1] == 3


def test_event_parser():
    data = b": hi\n\ndata: a\ndata:b\r\nid: 7\n\nevent: x\n\ndata:  c\n\ndata"
    for step in (1, 3, 1000):
        p, out = EventParser(), []
        for i in range(0, len(data), step):
            out += p.feed(data[i : i + step])
        assert out + p.finish() == ["a\nb", " c"]  # a bare field and a line without an end say nothing
    p = EventParser()
    assert p.feed(b"data: x\ndata:y") == [] and p.finish() == ["x"]
    with pytest.raises(UnicodeDecodeError):
        EventParser().feed(b"data: \xff\n")


def test_paged_read():
    pages = {None: [{"offset": "1"}], "1": [{"offset": "2", "control": "subset_end"}]}
    assert len(PagedRead(lambda at: pages[at]).run()) == 2
    assert PagedRead(lambda at: [{"offset": "1"}, {"offset": "2", "control": "must_refetch"}]).run() == [{"offset": "2", "control": "must_refetch"}]
    for bad in (lambda at: [], lambda at: [{"offset": "1"}], lambda at: [{"offset": str(int(at or 0) + 1)}]):
        with pytest.raises(SourceError):
            PagedRead(bad).run()
    with pytest.raises(SourceError):
        PagedRead(lambda at: [{"offset": str(i)} for i in range(9)], most_messages=5).run()
    assert starting_options(None) == {"offset": "-1"} and starting_options(None, "h", "on_demand") == {"offset": "now", "handle": "h", "log": "changes_only"}
    assert decode_header_error("at headers.tags: not a list") == "tags" and decode_header_error("other") is None


def test_breaker():
    now = [0.0]
    b = CircuitBreaker(clock=lambda: now[0], chance=lambda a, c: 1.0)
    assert b.failed("x") == 0.5 and b.failed("y") == 1.0 and not b.is_open and b.failed("z") == 2.0 and b.is_open and b.wait() == 2
    now[0] = 3
    assert not b.is_open and b.wait() == 0 and b.half_open
    b.succeeded()
    assert [b.failed("same") for _ in range(5)] == [0.5, 1, 2, 4, 30] and b.wait() == 30
    b.succeeded()
    assert not b.is_open and b.failures == 0
    late = CircuitBreaker(clock=lambda: now[0], chance=lambda a, c: 1.5)
    assert [late.failed(str(i)) for i in range(9)][-3:] == [30.0, 30.0, 30.0]  # jitter never passes the limit


def test_supervised_restarts():
    class Run:
        left = 2

        def awaitTermination(self):
            Run.left -= 1
            if Run.left >= 0:
                raise RuntimeError("lost")

    slept = []
    assert supervised(Run, CircuitBreaker(clock=lambda: 0.0, chance=lambda a, c: 1.0), sleep=slept.append) == 2 and slept == [0, 0.5, 0, 1.0, 0]
    Run.left = 9
    with pytest.raises(RuntimeError):
        supervised(Run, CircuitBreaker(clock=lambda: 0.0), 1, sleep=slept.append)


def test_state_rules():
    s = SyncState("5", "h", "c")
    assert adopt(s, []) == (s, "exact") and adopt(None, []) == (None, "fresh") and adopt(None, [s, s])[1] == "legacy_adopted" and adopt(None, [s, SyncState("6", "h", "c")])[1] == "legacy_exact_miss"
    assert epoch_fence(SyncState(epoch="a"), "b") == "bootstrap" and epoch_fence(None, "b") == "continue"
    assert latch_topology("simple", True, False) == ("dnf", True) and latch_topology("simple", True, True) == ("dnf", False) and latch_topology("simple", False, False) == ("simple", False)
    assert needs_bootstrap(True, True, False) and not needs_bootstrap(True, False, False)
    assert shape_identity(["é", "ab"]) == "1:22:é2:ab" and shape_identity(["a"], "full") == "1:21:a4:full1:1"


def make(spark, tmp_path, mode="eager", base=None):
    remote = spark.createDataFrame([(i, i % 10, f"n{i}") for i in range(100)], "id int, age int, name string")
    return Collection("people", remote, GenerationTable(spark, f"file://{tmp_path}/people", ["id"], 4), Metadata(spark, f"file://{tmp_path}/meta"), mode, base)


def test_collection_reads_each_row_once(spark, tmp_path):
    c = make(spark, tmp_path)
    events = []
    c.listeners.append(events.append)
    assert c.query(AGE(">", 7)).count() == 20 and events == ["start", "end"]
    c.remote = c.remote.where("age <= 7")  # what was covered is not read again
    assert c.query(AGE(">", 5)).count() == 40 and c.query(AGE(">", 6)).count() == 30
    assert c.plan(Query(AGE(">", 8))).remainder is None
    assert c.query(AGE(">", 5), (("age", False),), 3).count() == 3
    assert c.lazily(Query(AGE(">", 4))).count() == 50
    c.mark_fetched(AGE("<", 1))
    assert c.plan(Query(AGE("<", 1))).remainder is None


def test_collection_demands_and_recovery(spark, tmp_path):
    c = make(spark, tmp_path, "on_demand", Compare("id", "<", 50))
    r = c.ensure_subset(AGE("=", 3))
    assert r.outcome == "present" and r.local.count() == 5 and c.ensure_subset(AGE("=", 77)).outcome == "absent"
    assert c.metadata.latest_observation("people", And((Compare("id", "<", 50), AGE("=", 77))))["outcome"] == "absent"
    with pytest.raises(PredicateError), c.demand(AGE("=", 1), limit=0):
        pass
    with c.demand(AGE("=", 4)):
        c.recover([Query(AGE("=", 5)), Query(AGE("=", 4))])
        assert c.local().count() == 10
    assert not c.demands and c.start_options()["offset"] == "now"
    with pytest.raises(CollectionError):
        make(spark, tmp_path, "other")


def test_collection_follows_a_log(spark, tmp_path):
    c = make(spark, tmp_path)
    c.query(AGE("=", 1))
    log = spark.createDataFrame([(1, 11, 99, "new", "update"), (2, 500, 1, "ins", "insert"), (3, 21, None, None, "delete")], "offset int, id int, age int, name string, op string")
    log.write.parquet(f"{tmp_path}/log")
    run = c.keep_synced(spark.readStream.schema(log.schema).parquet(f"{tmp_path}/log"), f"{tmp_path}/cp", available_now=True)
    run.awaitTermination()
    got = {r.id: r.age for r in c.local().collect()}
    assert got[11] == 99 and got[500] == 1 and 21 not in got and c.table.state()["offset"] == "3"
    assert c.query(FALSE).count() == 0
