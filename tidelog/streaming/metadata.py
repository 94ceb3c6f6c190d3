"""Metadata of replicated shapes: coverage, observations, ranges, resume state, row ownership, tombstones.

Small facts (resume state, coverage, observations, ranges) live in one versioned JSON manifest that changes by
compare-and-set, so they outlive the process; what grows with the rows (ownership) lives in a generation table, changed by
DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict, dataclass, replace
from datetime import UTC, datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.functions.predicates import Predicate, from_json, predicate_key, to_json
from tidelog.operators import cdc, membership
from tidelog.plans.coverage import Entry
from tidelog.streaming.manifest import Conflict, Manifest
from tidelog.streaming.store import GenerationTable

OWNERSHIP = "table string, row_key string, shape_id string, tags array<string>"


def shape_identity(fields: list[str], replica: str = "default", version: str = "1") -> str:
    """Length-prefixed concatenation (lengths in UTF-8 bytes); the two discriminators join only where they differ from the defaults."""
    parts = ["2", *fields] + ([replica, version] if replica != "default" or version != "1" else [])
    return "".join(f"{len(x.encode())}:{x}" for x in parts)


@dataclass(frozen=True)
class SyncState:
    offset: str = "-1"
    handle: str | None = None
    cursor: str | None = None
    is_up_to_date: bool = False
    epoch: str | None = None
    bridged_from: str | None = None

    @property
    def resumable(self) -> bool:
        return self.offset not in ("-1", "") and self.handle is not None


def adopt(existing: SyncState | None, legacy: list[SyncState], cutover: bool = True) -> tuple[SyncState | None, str]:
    """The state to resume from and its class: exact, fresh, legacy_adopted, legacy_exact_miss, legacy_bridged or legacy_pre_cutover.

    Legacy states are adopted only if all agree on the resume identity and it can be resumed. cutover False: shapes are
    still kept under their old keys; a state that was moved from another mode's key is bridged, any other is from before.
    """
    if existing is not None:
        if cutover:
            return existing, "exact"
        return existing, "legacy_bridged" if existing.bridged_from else "legacy_pre_cutover"
    if not legacy:
        return None, "fresh"
    same = {(s.offset, s.handle, s.cursor) for s in legacy}
    if len(same) == 1 and legacy[0].resumable:
        return replace(legacy[0], bridged_from="legacy"), "legacy_adopted"
    return None, "legacy_exact_miss"


def epoch_fence(state: SyncState | None, epoch: str | None) -> str:
    """continue, or bootstrap where the semantic epoch of what is stored is another."""
    return "continue" if state is None or state.epoch == epoch else "bootstrap"


def latch_topology(declared: str, saw_conditions: bool, latched: bool) -> tuple[str, bool]:
    """(topology, needs bootstrap): a shape declared simple that receives conditions is DNF from then on, after one bootstrap."""
    if declared == "dnf" or latched:
        return "dnf", False
    return ("dnf", True) if saw_conditions else ("simple", False)


def needs_bootstrap(tagged: bool, resumed: bool, continuous: bool) -> bool:
    """Tagged input on a resumed cursor without a continuous tracker cannot be folded."""
    return tagged and resumed and not continuous


def start_class(state: SyncState | None, epoch: str | None, tagged: bool, continuous: bool, declared: str = "simple", saw_conditions: bool = False, latched: bool = False) -> tuple[str, str]:
    """(continue or bootstrap, topology): how a shape starts, by the fences of epoch, topology and tracker continuity together."""
    topology, relatched = latch_topology(declared, saw_conditions, latched)
    resumed = state is not None and state.resumable
    if not resumed or relatched or epoch_fence(state, epoch) == "bootstrap" or needs_bootstrap(tagged, resumed, continuous):
        return "bootstrap", topology
    return "continue", topology


def _now() -> str:
    return datetime.now(UTC).isoformat()


class Metadata:
    """The metadata of all shapes under one path."""

    durable_ownership = True
    exclusive_working_set_reset = True

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self._manifest = Manifest(spark, f"{self.path}/facts")
        self.ownership = GenerationTable(spark, f"{self.path}/ownership", ["table", "row_key", "shape_id"])

    # facts

    def facts(self) -> dict[str, dict[str, Any]]:
        return {"coverage": {}, "observations": {}, "ranges": {}, "states": {}, "latches": {}} | (self._manifest.read()[1] or {})

    def _change(self, change: Callable[[dict[str, dict[str, Any]]], Any]) -> Any:
        """Applies a change to the facts; again on what another writer left, where it came first."""
        while True:
            version, said = self._manifest.read()
            facts = {"coverage": {}, "observations": {}, "ranges": {}, "states": {}, "latches": {}} | (said or {})
            out = change(facts)
            try:
                self._manifest.publish(version, facts)
                return out
            except Conflict:
                continue

    @property
    def ranges(self) -> dict[str, dict[str, Any]]:
        return self.facts()["ranges"]

    # coverage

    def record_fetch(self, table: str, p: Predicate | None, complete: bool = True, outcome: str = "present", key: str | None = None, base: str = "all", scoped: bool = False, boundary: Any = None) -> None:
        h = key or predicate_key(p)
        entry = {"table": table, "hash": h, "base": base, "predicate": to_json(p) if p is not None else None, "complete": complete, "outcome": outcome, "at": _now(), "scoped": scoped, "boundary": boundary}
        self._change(lambda f: f["coverage"].update({f"{table}|{base}|{h}": entry}))

    def has_fetched(self, table: str, h: str) -> bool:
        return any(c["table"] == table and c["hash"] == h and c["complete"] for c in self.facts()["coverage"].values())

    def entries(self, table: str) -> list[Entry]:
        return [
            Entry(c["table"], c["hash"], from_json(c["predicate"]) if c["predicate"] else None, c["complete"], c["outcome"], datetime.fromisoformat(c["at"]), c["scoped"], c["base"])
            for c in self.facts()["coverage"].values()
            if c["table"] == table
        ]

    def record_observation(self, table: str, p: Predicate | None, outcome: str, boundary: Any = None) -> None:
        self._change(lambda f: f["observations"].update({f"{table}|{predicate_key(p)}": {"outcome": outcome, "boundary": boundary, "at": _now()}}))

    def latest_observation(self, table: str, p: Predicate | None) -> dict[str, Any] | None:
        return self.facts()["observations"].get(f"{table}|{predicate_key(p)}")

    def record_range(self, table: str, order_field: str, rows: DataFrame) -> None:
        low, high, n = cdc.value_range(rows, order_field).select(F.col("low").cast("string"), F.col("high").cast("string"), "n").first()
        self._change(lambda f: f["ranges"].update({f"{table}|{order_field}": {"min": low, "max": high, "count": n}}))

    def fetched_ranges(self, table: str, order_field: str) -> dict[str, Any] | None:
        return self.facts()["ranges"].get(f"{table}|{order_field}")

    def clear(self, table: str, base: str | None = None) -> None:
        """Coverage of a table (within one base predicate, where rows have durable owners) counts no more."""

        def change(f: dict[str, dict[str, Any]]) -> None:
            f["coverage"] = {k: c for k, c in f["coverage"].items() if c["table"] != table or (base is not None and c["base"] != base)}

        self._change(change)

    # resume state

    def sync_state(self, collection: str) -> SyncState | None:
        found = self.facts()["states"].get(collection)
        return SyncState(**found) if found else None

    def update_sync_state(self, collection: str, state: SyncState) -> None:
        self._change(lambda f: f["states"].update({collection: asdict(state)}))

    def update_sync_states(self, states: DataFrame) -> None:
        """One commit of many: collection, offset, handle, cursor and is_up_to_date; the last offset of each counts."""
        last = cdc.latest(states.select("collection", "offset", "handle", "cursor", "is_up_to_date"), "collection", "offset").collect()  # one row for each collection
        self._change(lambda f: f["states"].update({x["collection"]: asdict(SyncState(str(x["offset"]), x["handle"], x["cursor"], x["is_up_to_date"])) for x in last}))

    def sync_states(self) -> DataFrame:
        rows = [(k, *(x[c] for c in ("offset", "handle", "cursor", "is_up_to_date"))) for k, x in self.facts()["states"].items()]
        return self.spark.createDataFrame(rows, "collection string, offset string, handle string, cursor string, is_up_to_date boolean")

    def reset_sync_state(self, collection: str) -> None:
        self._change(lambda f: f["states"].pop(collection, None))

    def adopt_sync_state(self, collection: str, legacy: list[str]) -> SyncState | None:
        """Takes over a state that all legacy keys agree on; otherwise nothing changes."""

        def change(f: dict[str, dict[str, Any]]) -> SyncState | None:
            own = f["states"].get(collection)
            state, _ = adopt(SyncState(**own) if own else None, [SyncState(**f["states"][x]) for x in legacy if x in f["states"]])
            if state is not None:
                f["states"][collection] = asdict(state)
            return state

        return self._change(change)

    def latch(self, shape: str) -> bool:
        """Notes that a shape sent conditions; whether that was known."""
        return self._change(lambda f: f["latches"].setdefault(shape, False) or bool(f["latches"].update({shape: True})))

    # ownership

    def owned(self) -> DataFrame:
        rows = self.ownership.read()
        return rows if rows is not None else self.spark.createDataFrame([], OWNERSHIP)

    def _next(self) -> int:
        return self.ownership.manifest()["batch"] + 1

    def claim(self, rows: DataFrame, batch: int) -> None:
        """rows: OWNERSHIP columns."""
        self.ownership.merge(rows, rows.where("false"), self.ownership.state(), batch)

    def release(self, rows: DataFrame, batch: int) -> DataFrame:
        """Lets go of (table, row_key, shape_id); returns the row keys that no shape owns now and may be deleted."""
        before = self.owned()  # old files stay until vacuum(), so this plan still reads what was
        free = membership.orphans(before, rows)
        self.ownership.merge(before.where("false"), rows, self.ownership.state(), batch)
        return free

    def release_all(self, table: str, shape: str) -> DataFrame:
        """Lets go of all rows of a shape; returns the row keys that no shape owns now."""
        mine = (F.col("table") == table) & (F.col("shape_id") == shape)
        before = self.owned()
        return self.release(before.where(mine), self._next()) if not before.where(mine).isEmpty() else before.select("row_key").where("false")

    def remove_rows(self, table: str, keys: DataFrame) -> None:
        """Every shape's ownership of rows (row_key) that were deleted."""
        gone = self.owned().where(F.col("table") == table).join(keys.select("row_key").distinct(), "row_key", "left_semi")
        self.ownership.merge(gone.where("false"), gone, self.ownership.state(), self._next())

    def clear_exclusive(self, table: str) -> None:
        """Every owner of an exclusive table, and its coverage: for a replacement of its rows."""
        self.ownership.replace(self.owned().where(F.col("table") != table), self.ownership.state(), self._next())
        self.clear(table)

    def ownership_tags(self, table: str, shape: str, keys: DataFrame | None = None) -> DataFrame:
        """row_key and tags of a shape (of some rows)."""
        rows = self.owned().where((F.col("table") == table) & (F.col("shape_id") == shape)).select("row_key", "tags")
        return rows if keys is None else rows.join(keys.select("row_key").distinct(), "row_key", "left_semi")

    def rebuild_tags(self, table: str, shape: str) -> DataFrame:
        """row_key and tags that a tracker starts from."""
        return self.ownership_tags(table, shape)

    def rebuild_state(self, table: str, shape: str) -> DataFrame:
        """The membership state (row_key and membership.STATE) that a simple shape's fold starts from."""
        none = F.lit(None)
        return self.rebuild_tags(table, shape).select("row_key", "tags", F.array().cast("array<boolean>").alias("active"), none.cast("bigint").alias("evicted_at"))

    def update_ownership(self, table: str, shape: str, tags: DataFrame) -> None:
        """Brings a shape's ownership to `tags` (row_key, tags): only what changed is written."""
        old = self.ownership_tags(table, shape)
        delta = membership.ownership_delta(old, tags)
        named = lambda df: df.select(F.lit(table).alias("table"), "row_key", F.lit(shape).alias("shape_id"), "tags")
        claimed = named(tags.join(delta.where("change <> 'released'"), "row_key", "left_semi"))
        released = named(old.join(delta.where("change = 'released'"), "row_key", "left_semi"))
        self.ownership.merge(claimed, released, self.ownership.state(), self._next())

    def admits_fresh_owner(self, table: str, local: DataFrame | None, exclusive: bool) -> bool:
        """Whether a first demand may start without recovery: no owner and no coverage of the table, nor, if it is exclusive, any row."""
        if self.entries(table) or not self.owned().where(F.col("table") == table).isEmpty():
            return False
        return not exclusive or local is None or local.isEmpty()

    def retire_mutations(self, pending: DataFrame, published: DataFrame) -> DataFrame:
        """Pending optimistic mutations without exact evidence in what was published (row_id, op, txid)."""
        return cdc.retire_mutations(pending, published)
