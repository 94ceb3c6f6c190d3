"""Membership as a stream: each micro-batch folds its changes and move events over the stored membership of rows.

Steps of one row that fall into different batches give the same as in one batch, because the fold's state is all that
it remembers; the store commits it with the batch number, so a replay changes nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators import membership
from tidelog.streaming.store import GenerationTable


def apply_batch(table: GenerationTable, messages: DataFrame, batch_id: int, legacy: bool = False) -> bool:
    """messages: seq, row, op, tags, removed_tags, active_conditions, event (move_in or move_out, else null), pos, value.

    The first tagged message of a generation fixes the disjuncts, the number of segments and the mode for good.
    """
    if batch_id <= table.manifest()["batch"]:
        return False
    key = table.key[0]
    changes = messages.where("event is null").select("seq", key, "op", "tags", "removed_tags", "active_conditions")
    events = messages.where("event is not null").select("seq", F.col("event").alias("kind"), "pos", "value")
    state = table.state()
    positions = state.get("positions")
    if positions is None:
        first = changes.where(F.size("tags") > 0).agg(F.min_by("tags", "seq")).first()[0]
        positions = membership.disjuncts(first) if first else None
        state = state | ({"length": len(first[0].split("/")), "legacy": legacy} if first else {})
    old = table.read()
    if old is None:
        old = messages.sparkSession.createDataFrame([], f"{key} {messages.schema[key].dataType.simpleString()}, {membership.STATE}")
    after = membership.fold(old, changes, events, key, positions or [], state.get("legacy", legacy), state.get("length"))
    changed = after.join(old, [key, "tags", "active"], "left_anti")  # the others stay where they are
    return table.merge(changed, changed.select(key).where("false"), state | ({"positions": positions} if positions else {}), batch_id)


def start(stream: DataFrame, table: GenerationTable, checkpoint: str, legacy: bool = False):
    return stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: apply_batch(table, df, n, legacy)).trigger(availableNow=True).start()
