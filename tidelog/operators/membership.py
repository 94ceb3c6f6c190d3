"""Membership of rows in shapes: tags, move-in and move-out events, ownership counts and tombstones.

A tag is a path of segments. A row belongs to a shape while its tag set is not empty (simple shapes), or while one
of its disjuncts holds (DNF shapes: each tag is a conjunction over the positions of its non-empty segments, each
position has an active flag).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def segments(tag: Column) -> Column:
    """Segments of a tag; empty ones stay."""
    return F.split(tag, "/", -1)


def tag_index(rows: DataFrame, key: str, tags: str = "tags", legacy: bool = False) -> DataFrame:
    """(key, tag, pos, value): the inverted index. Empty segments do not take part; in legacy tags they do, and `_` is a wildcard."""
    out = rows.select(key, F.explode(tags).alias("tag")).select(key, "tag", F.posexplode(segments(F.col("tag"))).alias("pos", "value"))
    return out if legacy else out.where("value <> ''")


def tag_fold(changes: DataFrame, key: str = "key", order: str = "offset") -> DataFrame:
    """(key, tag) that remain after ordered changes with tags and removed_tags; a delete clears. Within a change, removals come first.

    Tags whose number of segments differs from the first tag's ever seen are ignored.
    """
    first = changes.where(F.size("tags") > 0).agg(F.min_by(F.size(segments(F.col("tags")[0])), order).alias("len"))
    added = changes.where("op <> 'delete'").select(key, order, F.explode("tags").alias("tag"), F.lit(1).alias("add"))
    removed = changes.where("op <> 'delete'").select(key, order, F.explode("removed_tags").alias("tag"), F.lit(0).alias("add"))
    cleared = changes.where("op = 'delete'").groupBy(key).agg(F.max(order).alias("cleared"))
    both = added.unionByName(removed).where(F.size(segments(F.col("tag"))) == first.scalar())
    last = both.groupBy(key, "tag").agg(F.max(F.struct(order, "add")).alias("x")).where("x.add = 1")
    return last.join(cleared, key, "left").where(F.col("cleared").isNull() | (F.col(f"x.{order}") > F.col("cleared"))).select(key, "tag")


def moved_out(rows: DataFrame, patterns: DataFrame, key: str, tags: str = "tags", legacy: bool = False) -> DataFrame:
    """Keys of tagged rows, all of whose tags some pattern (pos, value) matches. Untagged rows are never moved out."""
    index = tag_index(rows, key, tags, legacy)
    # a wildcard is matched by position alone; two equality joins, no comparison of every tag with every pattern
    hit = index.join(patterns, ["pos", "value"], "left_semi").select(key, "tag")
    if legacy:
        hit = hit.unionByName(index.where("value = '_'").join(patterns.select("pos").distinct(), "pos", "left_semi").select(key, "tag"))
    left = rows.select(key, F.explode(F.array_distinct(tags)).alias("tag")).groupBy(key).agg(F.count("*").alias("n"))
    gone = hit.distinct().groupBy(key).agg(F.count("*").alias("gone"))
    return left.join(gone, key).where("n = gone").select(key)


def disjuncts(first_tags: list[str]) -> list[list[int]]:
    """Positions of the non-empty segments of each tag of the first tagged message of a generation."""
    return [[i for i, s in enumerate(t.split("/")) if s] for t in first_tags]


def row_visible(active: Column, positions: Column) -> Column:
    """Any disjunct with all positions active; positions out of range are inactive, an empty disjunct holds, no disjunct does not."""
    return F.exists(positions, lambda d: F.forall(d, lambda i: F.coalesce(F.get(active, i), F.lit(False))))


def dnf_fold(rows: DataFrame, events: DataFrame, key: str, positions: list[list[int]]) -> DataFrame:
    """Rows (key, tags, active) under ordered move events (seq, kind: move_in or move_out, pos, value).

    A move-out makes its position inactive for rows that have the segment; a row with no disjunct left is evicted
    for good, at that event. A move-in makes it active again for rows still there. Returns key, active, evicted_at
    (null while visible). A row's own events are those that match its segments: found by an equality join.
    """
    index = tag_index(rows, key).select(key, "pos", "value").distinct()
    mine = index.join(events, ["pos", "value"]).groupBy(key).agg(F.array_sort(F.collect_list(F.struct("seq", "pos", "kind"))).alias("moves"))  # events that name the row
    shape = F.array(*(F.array(*map(F.lit, d)) if d else F.array().cast("array<int>") for d in positions)) if positions else F.array().cast("array<array<int>>")
    start = F.struct(F.col("active").alias("active"), F.lit(None).cast("long").alias("evicted_at"))

    def step(s: Column, m: Column) -> Column:
        now = F.transform(s["active"], lambda a, i: F.when(i == m["pos"], m["kind"] == "move_in").otherwise(a))
        out = (m["kind"] == "move_out") & ~row_visible(now, shape)
        return F.when(s["evicted_at"].isNotNull(), s).otherwise(F.struct(now.alias("active"), F.when(out, m["seq"].cast("long")).alias("evicted_at")))

    joined = rows.select(key, "active").join(mine, key, "left")
    none = F.array().cast("array<struct<seq:bigint,pos:int,kind:string>>")
    moves = F.transform(F.coalesce("moves", none), lambda m: F.struct(m["seq"].cast("bigint").alias("seq"), m["pos"].cast("int").alias("pos"), m["kind"].alias("kind")))
    return joined.withColumn("s", F.aggregate(moves, start, step)).select(key, "s.active", "s.evicted_at")


# --- ownership


def orphans(ownership: DataFrame, released: DataFrame, row: str = "row_key", shape: str = "shape_id") -> DataFrame:
    """Rows that lose their last owner when the (row, shape) pairs of released let go; a pair that owns nothing releases nothing."""
    freed = ownership.join(released.select(row, shape).distinct().withColumn("_freed", F.lit(True)), [row, shape], "left")
    return freed.groupBy(row).agg(F.count_if(F.col("_freed").isNull()).alias("left"), F.count("*").alias("had")).where("left = 0").select(row)


def ownership_delta(old: DataFrame, new: DataFrame, row: str = "row_key") -> DataFrame:
    """Changed rows only: claimed, released or retagged. old, new: row and tags (arrays)."""
    a, b = old.select(row, F.array_sort("tags").alias("before")), new.select(row, F.array_sort("tags").alias("after"))
    both = a.join(b, row, "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))
    return both.select(row, F.when(F.col("before").isNull(), "claimed").when(F.col("after").isNull(), "released").otherwise("retagged").alias("change"))


# --- tombstones


def fenced(rows: DataFrame, tombstones: DataFrame, key: str, version: str = "version") -> DataFrame:
    """Rows that no tombstone of the same or a later version fences."""
    stones = tombstones.groupBy(key).agg(F.max(version).alias("_stone"))
    return rows.join(stones, key, "left").where(F.col("_stone").isNull() | (F.col(version) > F.col("_stone"))).drop("_stone")


def expired(tombstones: DataFrame, now: Column, ttl_seconds: int, most: int = 200, at: str = "deleted_at", key: str = "row_id") -> DataFrame:
    """The oldest tombstones past their time, at most so many in one batch."""
    return tombstones.where(F.col(at) < now - F.expr(f"interval {int(ttl_seconds)} seconds")).orderBy(at, key).limit(most)


# --- cursor owners


def owner_collisions(owners: DataFrame, cursor: str = "cursor_key", client: str = "client_id") -> DataFrame:
    """Cursors that more than one client holds."""
    return owners.groupBy(cursor).agg(F.countDistinct(client).alias("owners")).where("owners > 1")


# --- the general fold

STATE = "tags array<string>, active array<boolean>, evicted_at bigint"
_STEP = "struct<seq:bigint,what:string,tags:array<string>,removed:array<string>,active:array<boolean>,pos:int,value:string>"


def fold(state: DataFrame, changes: DataFrame, events: DataFrame, key: str, positions: list[list[int]], legacy: bool = False, length: int | None = None) -> DataFrame:
    """One batch of tagged changes and move events, in order of seq, over the membership of rows.

    state: key and STATE columns. changes: seq, key, op, tags, removed_tags, active_conditions. events: seq, kind, pos, value.
    Rules: a delete clears; a change without tags and removals does nothing; removals come before additions; conditions
    that come with tags replace the old ones. length: added tags with another number of segments are ignored. legacy: a
    segment `_` matches every value at its position, and empty segments are ordinary. A move-out takes matching tags from rows without conditions and evicts a row
    whose last tag goes; in rows with conditions it makes the position inactive and evicts those with no disjunct left. A
    move-in makes it active again, silently, and never brings back an evicted row; only new tags do.

    Events reach a row through an equality join with every segment that the row has or gets in the batch; the fold checks
    the tags that it has at that moment. A row's own steps are gathered, never a group of rows.
    """
    if length is not None:
        changes = changes.withColumn("tags", F.filter("tags", lambda t: F.size(segments(t)) == length))
    seen = state.select(key, F.explode("tags").alias("tag")).unionByName(changes.select(key, F.explode("tags").alias("tag")))
    index = seen.select(key, F.posexplode(segments(F.col("tag"))).alias("pos", "value")).distinct()
    index = index if legacy else index.where("value <> ''")
    none = lambda t: F.lit(None).cast(t)
    step = lambda **c: F.struct(*(c[n].alias(n) for n in ("seq", "what", "tags", "removed", "active", "pos", "value"))).cast(_STEP)
    empty = F.array().cast("array<string>")
    own = changes.select(
        key, step(seq=F.col("seq"), what=F.when(F.col("op") == "delete", "delete").otherwise("change"), tags=F.coalesce("tags", empty), removed=F.coalesce("removed_tags", empty), active=F.coalesce("active_conditions", F.array().cast("array<boolean>")), pos=none("int"), value=none("string")).alias("x")
    )
    reached = index.join(events, ["pos", "value"])
    if legacy:  # a wildcard is reached by position alone
        wild = index.where("value = '_'").select(key, "pos").join(events.where("value <> '_'"), "pos")
        reached = reached.unionByName(wild.select(*reached.columns)).distinct()
    moves = reached.select(key, step(seq=F.col("seq"), what=F.col("kind"), tags=empty, removed=empty, active=none("array<boolean>"), pos=F.col("pos"), value=F.col("value")).alias("x"))
    steps = own.unionByName(moves).groupBy(key).agg(F.array_sort(F.collect_list("x")).alias("steps"))
    shape = F.array(*(F.array(*map(F.lit, d)) if d else F.array().cast("array<int>") for d in positions)) if positions else F.array().cast("array<array<int>>")

    def apply(s: Column, m: Column) -> Column:
        at = lambda t: F.get(segments(t), m["pos"])
        matches = lambda t: (at(t) == m["value"]) | (at(t) == "_") if legacy else at(t) == m["value"]
        hit = F.exists(s["tags"], lambda t: F.coalesce(matches(t), F.lit(False)))
        made = lambda tags, active, evicted: F.struct(tags.alias("tags"), active.cast("array<boolean>").alias("active"), evicted.cast("bigint").alias("evicted_at"))
        nothing = F.array().cast("array<boolean>")
        tagged = (F.size(m["tags"]) > 0) | (F.size(m["removed"]) > 0)
        after = F.array_distinct(F.concat(F.array_except(s["tags"], m["removed"]), m["tags"]))
        simple = F.size(s["active"]) == 0
        left = F.filter(s["tags"], lambda t: ~F.coalesce(matches(t), F.lit(False)))
        flipped = F.transform(s["active"], lambda a, i: F.when(i == m["pos"], m["what"] == "move_in").otherwise(a))
        gone = made(empty, nothing, m["seq"])
        return (
            F.when(m["what"] == "delete", made(empty, nothing, F.lit(None)))
            .when(m["what"] == "change", F.when(tagged, made(after, F.when(F.size(m["active"]) > 0, m["active"]).otherwise(s["active"]), F.when(F.size(after) > 0, F.lit(None)).otherwise(s["evicted_at"]))).otherwise(s))
            .when(~hit, s)
            .when(simple, F.when(m["what"] == "move_in", s).when(F.size(left) == 0, gone).otherwise(made(left, s["active"], s["evicted_at"])))
            .when((m["what"] == "move_out") & ~row_visible(flipped, shape), gone)
            .otherwise(made(s["tags"], flipped, s["evicted_at"]))
        )

    both = state.join(steps, key, "full_outer")
    start = F.struct(F.coalesce("tags", empty).alias("tags"), F.coalesce("active", F.array().cast("array<boolean>")).cast("array<boolean>").alias("active"), F.col("evicted_at").cast("bigint").alias("evicted_at"))
    out = F.aggregate(F.coalesce("steps", F.array().cast(f"array<{_STEP}>")), start, apply)
    return both.withColumn("s", out).select(key, "s.tags", "s.active", "s.evicted_at")
