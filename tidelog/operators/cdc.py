"""Change-log materialisation: an ordered log of inserts, partial updates, deletes and controls to current rows.

A change log has a monotone order column. Keys may be very uneven, so current rows come from aggregates that combine
before the shuffle (max_by), not from windows over a key's whole history, wherever an aggregate can say it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESETS = ("truncate", "must_refetch")


def latest(changes: DataFrame, key: str, order: str) -> DataFrame:
    """The last change of each key."""
    others = [c for c in changes.columns if c != key]
    return changes.groupBy(key).agg(F.max_by(F.struct(*others), F.col(order)).alias("_last")).select(key, "_last.*")


def current_rows(changes: DataFrame, key: str = "key", order: str = "offset", op: str = "op") -> DataFrame:
    """Last writer wins: the last change of each key, where that is not a delete."""
    return latest(changes, key, order).where(F.col(op) != "delete")


def partial_rows(changes: DataFrame, fields: dict[str, str], key: str = "key", order: str = "offset", op: str = "op") -> DataFrame:
    """Current rows under partial updates. fields: column -> the boolean column that tells whether a change carries it.

    A carried null overwrites, an absent column keeps. A row lives from the first insert after its last delete;
    what came before does not show through.
    """
    ended = changes.groupBy(key).agg(F.max(F.when(F.col(op) == "delete", F.col(order))).alias("_ended"))
    alive = changes.join(ended, key).where(F.col("_ended").isNull() | (F.col(order) > F.col("_ended")))
    begun = alive.where(F.col(op) == "insert").groupBy(key).agg(F.min(order).alias("_begun"))
    rows = alive.join(begun, key).where(F.col(order) >= F.col("_begun"))
    last = lambda c, has: F.max_by(F.struct(F.col(c)), F.when(F.col(has), F.col(order)))[c]
    return rows.groupBy(key).agg(*(last(c, has).alias(c) for c, has in fields.items()), F.max(order).alias(order))


def missing_updates(changes: DataFrame, key: str = "key", order: str = "offset", op: str = "op", existing: DataFrame | None = None, block: int = 1 << 16) -> DataFrame:
    """Keys with an update to a row that is not there at that time, each once. existing: keys there before the log.

    The order column is integral. A key's history is cut into blocks of the order's values, so that no task gets all of a
    hot key: a block tells whether it misses a row by itself, whether it updates before it inserts or deletes, and how it ends.
    """
    part = F.floor(F.col(order) / block).cast("long")
    life = F.when(F.col(op).isin("insert", "delete"), F.col(op))
    before = Window.partitionBy(key, "_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    steps = changes.select(key, order, op, part.alias("_part")).withColumn("_life", F.last(life, ignorenulls=True).over(before))
    update = F.col(op) == "update"
    parts = steps.groupBy(key, "_part").agg(
        F.coalesce(F.max(update & (F.col("_life") == "delete")), F.lit(False)).alias("_gone"), F.max(update & F.col("_life").isNull()).alias("_early"), F.max_by(life, F.when(life.isNotNull(), F.col(order))).alias("_ends")
    )
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_was", F.last("_ends", ignorenulls=True).over(earlier))
    gone = parts.where("_gone or (_early and _was = 'delete')").select(key)
    never = parts.where("_early and _was is null").select(key)
    if existing is not None:
        never = never.join(existing.select(key), key, "left_anti")
    return gone.unionByName(never).distinct()


def hydrate(base: DataFrame, missing: DataFrame, base_key: str, key: str = "key") -> DataFrame:
    """Rows of the base table for missing keys; the join's side is chosen by size at run time."""
    return base.join(missing.select(F.col(key).alias(base_key)), base_key, "left_semi")


def visible(txid: Column, xmin: Column, xmax: Column, xip: Column) -> Column:
    """Whether a transaction is visible in a snapshot. Bounds are text; bounds that are not numbers see nothing."""
    low, high = xmin.try_cast("bigint"), xmax.try_cast("bigint")
    return F.coalesce(F.when(low.isNull() | high.isNull(), F.lit(False)).when(txid < low, True).when(txid >= high, False).otherwise(~F.array_contains(xip, txid.cast("string"))), F.lit(False))


def _least_after(steps: DataFrame, bounds: DataFrame, value: str, bound: str, names: list[str], at: str, to: str) -> DataFrame:
    """names and `to`: for each row of bounds the least `at` among steps whose value is at or over its bound; rows without one are left out.

    64-bit values; steps have distinct values. No comparison of every bound with every step: both are named by digits of
    base 256. The values over a bound are those with a greater digit at one of eight places and the same digits before it,
    so a bound asks for 8 * 255 + 1 names at most, by an equality join with the least `at` of each name.
    """
    prefix = lambda c, i: F.shiftright(c, 8 * i)
    named = F.explode(F.array(*(F.struct(F.lit(i).alias("place"), prefix(F.col(value), i).alias("digits")) for i in range(8))))
    least = steps.select(named.alias("x"), at).groupBy("x.place", "x.digits").agg(F.min(at).alias("_least"))

    def over(i: int) -> Column:
        here = prefix(F.col(bound), i)
        last = F.lit(127).cast("long") if i == 7 else here.bitwiseOR(F.lit(255).cast("long"))
        digits = F.when(here < last, F.sequence(here + 1, last)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(digits, lambda d: F.struct(F.lit(i).alias("place"), d.alias("digits")))

    asked = F.concat(F.array(F.struct(F.lit(0).alias("place"), F.col(bound).alias("digits"))), *(over(i) for i in range(8)))
    return bounds.where(F.col(bound).isNotNull()).select(*names, F.explode(asked).alias("x")).select(*names, "x.*").join(least, ["place", "digits"]).groupBy(*names).agg(F.min("_least").alias(to))


def without_snapshot_overlap(live: DataFrame, snapshots: DataFrame, tracked: DataFrame, key: str = "key", order: str = "offset", txids: str = "txids") -> DataFrame:
    """Live changes without those that a tracked snapshot already shows.

    snapshots: snapshot_id, xmin, xmax, xip; tracked: snapshot_id, key. A change goes if a snapshot tracks its key and sees its
    greatest transaction, unless the snapshot has retired: from the first change on with a transaction at or
    over its xmax. Changes without key or transaction stay. All joins are by equality; Spark chooses their sides by size.
    """
    rows = live.withColumn("_tx", F.array_max(txids))
    heads = rows.where(F.col(key).isNotNull() & F.col("_tx").isNotNull())
    # retirement needs the least order over a bound for each snapshot: an aggregate, no running maximum
    steps = heads.groupBy(F.col("_tx").cast("long").alias("_tx")).agg(F.min(order).alias("_at"))
    bounds = snapshots.select("snapshot_id", F.col("xmax").try_cast("bigint").alias("_bound")).groupBy("snapshot_id").agg(F.min("_bound").alias("_bound"))
    retired = _least_after(steps, bounds, "_tx", "_bound", ["snapshot_id"], "_at", "_retired")
    known = tracked.join(snapshots, "snapshot_id").join(retired, "snapshot_id", "left").withColumnRenamed(key, "_key")
    seen = (F.col(key) == F.col("_key")) & visible(F.col("_tx"), F.col("xmin"), F.col("xmax"), F.col("xip")) & (F.col("_retired").isNull() | (F.col(order) < F.col("_retired")))
    return rows.join(known, seen, "left_anti").drop("_tx")


def reset_projection(messages: DataFrame, batch: str = "batch_id", control: str = "control") -> DataFrame:
    """Messages by batch, where a batch with a reset keeps its resets only."""
    resets = messages.where(F.col(control).isin(*RESETS)).select(batch).distinct()
    kept = messages.where(F.col(control).isin(*RESETS))
    return messages.join(resets, batch, "left_anti").unionByName(kept)


def message_stats(messages: DataFrame, batch: str = "batch_id") -> DataFrame:
    """Counts and sizes of each batch; columns op, control, payload (text)."""
    size = F.coalesce(F.octet_length("payload"), F.lit(0))
    return messages.groupBy(batch).agg(
        F.count("*").alias("messages"),
        *(F.count_if(F.col("op") == o).alias(f"{o}s") for o in ("insert", "update", "delete")),
        F.count_if(F.col("control").isNotNull()).alias("controls"),
        F.sum(size).cast("long").alias("payload_bytes"),
        F.count_if(size == 0).alias("empty_payloads"),
        F.max(F.coalesce(F.col("control").isin(*RESETS), F.lit(False))).alias("has_reset"),
    )


def resume_identity(messages: DataFrame, group: str, order: str = "offset", columns: tuple[str, ...] = ("handle", "cursor")) -> DataFrame:
    """The last value of each resume column that is not null, by group. Move events do not count as processed."""
    rows = messages.where(F.coalesce(F.col("event"), F.lit("")) == "") if "event" in messages.columns else messages
    return rows.groupBy(group).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in columns))


def payloads(messages: DataFrame, payload: str = "payload") -> DataFrame:
    """Messages that carry a row. The others are headers only: they are not decoded, but they do move the resume state."""
    return messages.where(F.coalesce(F.octet_length(payload), F.lit(0)) > 0)


def completion(batch: DataFrame, control: str = "control", was_up_to_date: Column | bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Whether a batch (or each group `by`) is complete, and whether the shape is up to date after it (subset and snapshot ends keep what was).

    was_up_to_date: what was known before, a constant or a column that is alike in the group.
    """
    was = F.max(was_up_to_date) if isinstance(was_up_to_date, Column) else F.lit(was_up_to_date)
    complete = F.coalesce(F.max(F.col(control).isin("up_to_date", "snapshot_end", "subset_end")), F.lit(False))
    now = F.coalesce(F.max(F.col(control) == "up_to_date"), F.lit(False))
    return batch.groupBy(*by).agg(complete.alias("is_complete"), (now | (complete & F.coalesce(was, F.lit(False)))).alias("is_up_to_date"))


def observation(batch: DataFrame, order: str = "offset", by: tuple[str, ...] = ()) -> DataFrame:
    """present if a subset row with a payload came, and the last snapshot of the batch (or of each group `by`)."""
    present = F.coalesce(F.max(F.col("is_subset_snapshot") & (F.octet_length("payload") > 0)), F.lit(False))
    return batch.groupBy(*by).agg(F.when(present, "present").otherwise("absent").alias("outcome"), F.max_by("snapshot", F.when(F.col("snapshot").isNotNull(), F.col(order))).alias("boundary"))


def value_range(rows: DataFrame, order_field: str, by: tuple[str, ...] = ()) -> DataFrame:
    """low, high and n of an order field: what a range record holds."""
    return rows.groupBy(*by).agg(F.min(order_field).alias("low"), F.max(order_field).alias("high"), F.count("*").alias("n"))


def evidence(changes: DataFrame, key: str = "key", op: str = "op", txids: str = "txids") -> DataFrame:
    """Distinct (row, op, transaction): what lets a pending optimistic mutation go."""
    return changes.select(F.col(key).alias("row_id"), F.col(op).alias("op"), F.explode(txids).alias("txid")).distinct()


def retire_mutations(pending: DataFrame, seen: DataFrame) -> DataFrame:
    """Pending mutations (row_id, op, txid, ...) without exact evidence."""
    return pending.join(seen, ["row_id", "op", "txid"], "left_anti")


def field_presence(rows: DataFrame, fields: list[str], value: str = "value") -> DataFrame:
    """For each field of a JSON object column: absent, explicit_null or present_value."""
    keys = F.coalesce(F.json_object_keys(value), F.array().cast("array<string>"))
    got = F.from_json(value, "map<string,string>")
    state = lambda f: F.when(~F.array_contains(keys, f), "absent").when(got[f].isNull(), "explicit_null").otherwise("present_value")
    return rows.select("*", *(state(f).alias(f"{f}_presence") for f in fields))


def txid_seen(changes: DataFrame, snapshots: DataFrame, txid: int, txids: str = "txids") -> bool:
    """Whether a transaction came in a change or is visible in a snapshot."""
    if not changes.where(F.array_contains(txids, txid)).isEmpty():
        return True
    return not snapshots.where(visible(F.lit(txid).cast("bigint"), F.col("xmin"), F.col("xmax"), F.col("xip"))).isEmpty()
