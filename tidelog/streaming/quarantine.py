"""Protocol quarantine: a batch with a message this engine does not understand is rejected whole, before any write."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROLS = ("up_to_date", "snapshot_end", "must_refetch", "subset_end", "truncate")
VERSION = "1"


class Quarantined(RuntimeError):
    """A batch was rejected; reasons holds what was found."""

    def __init__(self, reasons: dict[str, int]) -> None:
        super().__init__(", ".join(f"{k}: {v}" for k, v in sorted(reasons.items())))
        self.reasons = reasons


def reason(segments: int | None) -> Column:
    """Why a message is not understood, or null: schema, version, control, tag, active_conditions or move_in."""
    c = F.col
    tag = F.lit(False) if segments is None else F.exists(F.coalesce("tags", F.array().cast("array<string>")), lambda x: F.size(F.split(x, "/", -1)) != segments)
    conditions = F.lit(False) if segments is None else F.size(F.coalesce("active_conditions", F.array().cast("array<boolean>"))).between(1, segments - 1)
    return (
        F.when(F.coalesce(c("schema"), F.lit("")) == "", "schema")
        .when(c("version") != VERSION, "version")
        .when(c("control").isNotNull() & ~c("control").isin(*CONTROLS), "control")
        .when(tag, "tag")
        .when(conditions, "active_conditions")
        .when((c("event") == "move_in") & (F.size(F.coalesce("active_conditions", F.array().cast("array<boolean>"))) == 0), "move_in")
    )


def report(messages: DataFrame, segments: int | None = None) -> DataFrame:
    """Messages by reason."""
    return messages.select(reason(segments).alias("reason")).where("reason is not null").groupBy("reason").agg(F.count("*").alias("messages"))


def check(batch: DataFrame, segments: int | None = None) -> None:
    """Raises Quarantined if a message of the batch is not understood; at most one row for each reason comes back."""
    found = {r["reason"]: r["messages"] for r in report(batch, segments).collect()}
    if found:
        raise Quarantined(found)
