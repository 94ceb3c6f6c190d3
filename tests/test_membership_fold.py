import random

from tidelog.operators import membership
from tidelog.streaming import membership as stream
from tidelog.streaming.store import GenerationTable

CHANGES = "seq long, row string, op string, tags array<string>, removed_tags array<string>, active_conditions array<boolean>"
EVENTS = "seq long, kind string, pos int, value string"


def brute(steps, positions):
    """The rules, step by step. steps: (seq, 'change', row, op, tags, removed, conditions) or (seq, kind, pos, value)."""
    rows = {}
    for s in sorted(steps, key=lambda s: s[0]):
        if s[1] == "change":
            _, _, row, op, tags, removed, conds = s
            r = rows.setdefault(row, {"tags": set(), "active": [], "evicted": None})
            if op == "delete":
                r.update(tags=set(), active=[], evicted=None)
            elif tags or removed:
                r["tags"] = (r["tags"] - set(removed)) | set(tags)
                if conds:
                    r["active"] = list(conds)
                if r["tags"]:
                    r["evicted"] = None
            continue
        seq, kind, pos, value = s
        for r in rows.values():
            hit = {t for t in r["tags"] if pos < len(t.split("/")) and t.split("/")[pos] == value and value}
            if not hit:
                continue
            if not r["active"]:
                if kind == "move_out":
                    r["tags"] -= hit
                    if not r["tags"]:
                        r.update(active=[], evicted=seq)
                continue
            if pos < len(r["active"]):
                r["active"][pos] = kind == "move_in"
            if kind == "move_out" and not any(all(i < len(r["active"]) and r["active"][i] for i in d) for d in positions):
                r.update(tags=set(), active=[], evicted=seq)
    return {k: (sorted(r["tags"]), r["active"], r["evicted"]) for k, r in rows.items()}


def steps_of(seed, dnf):
    rng = random.Random(seed)
    shapes = ["{}/", "/{}"] if dnf else ["{}/x", "{}/y"]
    out = []
    for seq in range(1, 90):
        if rng.random() < 0.6:
            op = rng.choice(["insert", "update", "update", "delete"])
            tags = [s.format(rng.choice("abc")) for s in shapes if rng.random() < 0.7]
            removed = [rng.choice(shapes).format(rng.choice("abc"))] if rng.random() < 0.2 else []
            conds = [rng.random() < 0.8, rng.random() < 0.8] if dnf and tags else []
            out.append((seq, "change", f"r{rng.randrange(8)}", op, tags, removed, conds))
        else:
            out.append((seq, rng.choice(["move_out", "move_out", "move_in"]), rng.randrange(2), rng.choice("abcx")))
    return out


def frames(spark, steps):
    changes = [(s[0], s[2], s[3], s[4], s[5], s[6]) for s in steps if s[1] == "change"]
    return spark.createDataFrame(changes, CHANGES), spark.createDataFrame([s for s in steps if s[1] != "change"], EVENTS)


def test_fold_matches_the_rules(spark):
    for seed, dnf in ((1, False), (2, True), (3, True)):
        steps, positions = steps_of(seed, dnf), [[0], [1]]
        empty = spark.createDataFrame([], f"row string, {membership.STATE}")
        got = membership.fold(empty, *frames(spark, steps), "row", positions)
        assert {r.row: (sorted(r.tags), list(r.active), r.evicted_at) for r in got.collect()} == brute(steps, positions)


def test_batches_give_what_one_fold_gives(spark, tmp_path):
    steps = steps_of(5, True)
    steps[0] = (1, "change", "r0", "insert", ["a/", "/b"], [], [True, True])
    t = GenerationTable(spark, f"file://{tmp_path}/t", ["row"], 2)
    cols = f"{CHANGES}, event string, pos int, value string"
    for n, a in enumerate(range(0, len(steps), 30)):
        rows = [(s[0], s[2], s[3], s[4], s[5], s[6], None, None, None) if s[1] == "change" else (s[0], None, None, None, None, None, s[1], s[2], s[3]) for s in steps[a : a + 30]]
        assert stream.apply_batch(t, spark.createDataFrame(rows, cols), n)
    assert {r.row: (sorted(r.tags), list(r.active)) for r in t.read().collect()} == {k: v[:2] for k, v in brute(steps, [[0], [1]]).items()}
    assert t.state()["positions"] == [[0], [1]] and not stream.apply_batch(t, spark.createDataFrame([], cols), 0)
