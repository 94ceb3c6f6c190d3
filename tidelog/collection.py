"""Collections: demand on one shape, answered from a local table that is kept in step with a remote one.

Modes: eager reads everything and then follows the log; on_demand follows the tail and reads subsets as they are
asked for; progressive reads a first subset at once while the whole is on its way.
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame

from tidelog.functions.predicates import Predicate, PredicateError
from tidelog.plans.coverage import Plan, Query, compute_missing, demand_order, is_bounded, key, records_coverage, scope
from tidelog.plans.subset import answer, subset, where
from tidelog.sources.changelog import starting_options
from tidelog.streaming import pipeline
from tidelog.streaming.metadata import Metadata
from tidelog.streaming.store import GenerationTable

MODES = ("eager", "on_demand", "progressive")


class CollectionError(RuntimeError):
    """A demand that cannot be served."""


@dataclass(frozen=True)
class SubsetResult:
    applied: DataFrame
    local: DataFrame
    outcome: str


@dataclass
class Collection:
    """remote: the shape's rows. table: the local generation table. defaults apply where a call leaves a part out."""

    name: str
    remote: DataFrame
    table: GenerationTable
    metadata: Metadata
    mode: str = "eager"
    base: Predicate | None = None
    defaults: Query = field(default_factory=Query)
    demands: list[Query] = field(default_factory=list)
    listeners: list[Callable[[str], Any]] = field(default_factory=list)
    loading: int = 0
    batch: int = -1
    lock: threading.RLock = field(default_factory=threading.RLock)

    def __post_init__(self) -> None:
        if self.mode not in MODES:
            raise CollectionError(f"unknown mode {self.mode}")
        self.batch = self.table.manifest()["batch"]

    def _query(self, p: Predicate | None, order_by: tuple | None, limit: int | None, cursor: Any) -> Query:
        d = self.defaults
        return Query(p if p is not None else d.predicate, order_by if order_by is not None else d.order_by, limit if limit is not None else d.limit, cursor)

    def local(self) -> DataFrame:
        rows = self.table.read()
        return rows if rows is not None else self.remote.where("false")

    def plan(self, q: Query) -> Plan:
        return compute_missing(q, self.metadata.entries(self.name))

    @contextmanager
    def _loads(self) -> Iterator[None]:
        with self.lock:
            self.loading += 1
            if self.loading == 1:
                self._tell("start")
        try:
            yield
        finally:
            with self.lock:
                self.loading -= 1
                if not self.loading:
                    self._tell("end")

    def _tell(self, event: str) -> None:
        for x in self.listeners:
            x(event)

    def _apply(self, rows: DataFrame) -> None:
        self.batch = self.table.manifest()["batch"] + 1
        self.table.merge(rows, rows.where("false"), self.table.state(), self.batch)

    def query(self, p: Predicate | None = None, order_by: tuple | None = None, limit: int | None = None, cursor: Any = None) -> DataFrame:
        """Rows of a request: only what is not covered is read from the remote side and kept."""
        q = self._query(p, order_by, limit, cursor)
        with self.lock, self._loads():
            plan = self.plan(q)
            if plan.remainder is not None:
                first = not self.metadata.entries(self.name)
                fetched = subset(where(self.remote, self.base), q, key=tuple(self.table.key)) if q.scoped else where(where(self.remote, self.base), plan.remainder)
                self._apply(fetched)
                if records_coverage(self.mode, q, first):
                    self.metadata.record_fetch(self.name, q.predicate, key=key(q), scoped=q.scoped)
        return subset(where(self.local(), self.base), q, key=tuple(self.table.key))

    def lazily(self, q: Query) -> DataFrame:
        """The same answer as one lazy plan, local and remote parts together; nothing is kept."""
        return answer(where(self.local(), self.base), where(self.remote, self.base), q, self.plan(q), tuple(self.table.key))

    def ensure_subset(self, p: Predicate | None = None, order_by: tuple | None = None, limit: int | None = None) -> SubsetResult:
        """Always reads the remote side; records an observation, not coverage."""
        q = self._query(p, order_by, limit, None)
        with self.lock, self._loads():
            fetched = subset(where(self.remote, self.base), q, key=tuple(self.table.key))
            self._apply(fetched)
            outcome = "absent" if fetched.isEmpty() else "present"
            self.metadata.record_observation(self.name, scope(self.base, q.predicate), outcome)
            local = subset(where(self.local(), self.base), q, key=tuple(self.table.key))
        return SubsetResult(fetched, local if not local.isEmpty() else fetched, outcome)

    @contextmanager
    def demand(self, p: Predicate, order_by: tuple | None = None, limit: int | None = None) -> Iterator[SubsetResult]:
        """A bounded demand, kept among the working set while the context lasts."""
        q = self._query(p, order_by, limit, None)
        if not is_bounded(q):
            raise PredicateError("a demand needs a predicate and a positive limit, if any")
        self.demands.append(q)
        try:
            yield self.ensure_subset(p, order_by, limit)
        finally:
            self.demands.remove(q)

    def mark_fetched(self, p: Predicate | None) -> None:
        self.metadata.record_fetch(self.name, p)

    def recover(self, configured: list[Query] | None = None) -> None:
        """Replaces the working set: the union of configured and active demands, each row once, in one commit."""
        with self.lock:
            queries = demand_order([*(configured or []), *self.demands])
            rows = None
            for q in queries:
                part = subset(where(self.remote, self.base), q, key=tuple(self.table.key))
                rows = part if rows is None else rows.unionByName(part)
            rows = self.remote.where("false") if rows is None else rows.dropDuplicates(self.table.key)
            self.batch = self.table.manifest()["batch"] + 1
            self.metadata.clear(self.name)
            self.table.replace(rows, {}, self.batch)

    def apply_changes(self, changes: DataFrame, stream: str | None = None, number: int = -1) -> bool:
        """One batch of the log: the last change of each key, rows and resume state together, under the rules of pipeline.apply_batch.

        stream, number: a stream's checkpoint and its batch; a batch that was applied before is not applied again.
        """
        with self.lock:
            done = self.table.state().get("streams", {})
            if stream is not None and number <= done.get(stream, -1):
                return False
            self.batch = self.table.manifest()["batch"] + 1
            values = [c for c in changes.columns if c in {*self.local().columns, "op", "offset", "control", "schema", "version"}]
            more = {"streams": done | {stream: number}} if stream is not None else {}
            pipeline.apply_batch(self.table, changes.select(*values), self.batch, more_state=more, keep=tuple(self.local().columns))
            if self.table.manifest()["replacing"]:
                self.metadata.clear(self.name)  # what was covered is fetched again
            return True

    def keep_synced(self, stream: DataFrame, checkpoint: str, available_now: bool = False):
        """Follows the log; one tick per applied batch goes to the listeners. Returns the StreamingQuery."""

        def each(df: DataFrame, n: int) -> None:
            if self.apply_changes(df, checkpoint, n):
                self._tell("tick")

        writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(each)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def start_options(self) -> dict[str, str]:
        return starting_options(self.table.state().get("offset"), None, self.mode)
