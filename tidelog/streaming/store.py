"""Generation tables: rows and resume state that change together.

A table is a base, deltas beside it and a manifest. A commit writes one delta of the rows it changes (deleted keys as
marks) and publishes the next version of the manifest, which another writer cannot take at the same time, so readers see the
old rows and state or the new, never a mixture, and a batch that is replayed commits nothing twice. Reading takes
the newest version of each key. When MOST_DELTAS have gathered they are merged into one, or into the base if they hold
a QUARTER of its bytes, so a row is rewritten a bounded number of times for each quadrupling of the table.

Deltas may be staged: they are written and remembered, but not read before a later commit publishes them. A replacement
publishes what is staged in place of all rows, whatever the size of the batches it came in.
"""

from __future__ import annotations

import uuid
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.streaming.manifest import Manifest

MOST_DELTAS, QUARTER = 8, 4
_EMPTY: dict[str, Any] = {"base": [], "deltas": [], "staged": [], "replacing": False, "state": {}, "batch": -1, "schema": None}


class GenerationTable:
    """One table under path (any Hadoop file system). key: the columns that identify a row.

    order: a column that tells which of two rows of a key is newer, whatever the order of commits; else the later commit is.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = 16, order: str | None = None) -> None:
        self.spark, self.path, self.key, self.buckets, self.order = spark, path.rstrip("/"), key, buckets, order
        self._manifest = Manifest(spark, f"{self.path}/_manifest")

    def manifest(self) -> dict[str, Any]:
        version, said = self._manifest.read()
        return {**(said or _EMPTY), "generation": version}

    def _publish(self, before: dict[str, Any], **changes: Any) -> None:
        said = {k: v for k, v in (before | changes).items() if k != "generation"}
        self._manifest.publish(before["generation"], said)

    def state(self) -> dict[str, Any]:
        return self.manifest()["state"]

    def _load(self, paths: list[str], schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths)

    def _newest(self, deltas: DataFrame, columns: list[str]) -> DataFrame:
        by = F.struct(*([self.order] if self.order else []), "_seq", ~F.col("_gone"))
        return deltas.groupBy(*self.key).agg(F.max_by(F.struct(*(c for c in columns if c not in self.key), "_gone", "_seq"), by).alias("_row")).select(*self.key, "_row.*")

    def _merged(self, m: dict[str, Any], base: list[str], deltas: list[str]) -> DataFrame:
        schema = m["schema"]
        rows = self._load(base, schema) if base else self.spark.createDataFrame([], schema)
        if not deltas:
            return rows
        columns, changed = rows.columns, self._load(deltas, f"{schema}, _gone boolean, _seq bigint")
        if self.order:
            return self._newest(rows.withColumns({"_gone": F.lit(False), "_seq": F.lit(0).cast("long")}).unionByName(changed), columns).where("not _gone").select(*columns)
        newest = self._newest(changed, columns)
        return rows.join(newest.select(*self.key), self.key, "left_anti").select(*columns).unionByName(newest.where("not _gone").select(*columns))

    def read(self, staged: bool = False) -> DataFrame | None:
        """Current rows, or None before the first commit. staged: as they would be if what is staged were published."""
        m = self.manifest()
        if m["schema"] is None:
            return None
        if not staged:
            return self._merged(m, m["base"], m["deltas"])
        return self._merged(m, [] if m["replacing"] else m["base"], ([] if m["replacing"] else m["deltas"]) + m["staged"])

    def _folder(self, kind: str) -> str:
        return f"{self.path}/{kind}={uuid.uuid4().hex[:16]}"

    def _delta(self, upserts: DataFrame, deletes: DataFrame | None, m: dict[str, Any]) -> str:
        rows = upserts.withColumn("_gone", F.lit(False))
        if deletes is not None:
            rows = rows.unionByName(deletes.select(*self.key).withColumn("_gone", F.lit(True)), allowMissingColumns=True)
        where = self._folder("delta")
        rows.withColumn("_seq", F.lit(m["generation"] + 1).cast("long")).write.parquet(where)
        return where

    def commit(self, batch: int, state: dict[str, Any], publish: tuple | None = None, stage: tuple | None = None, boundary: bool = True, reset: bool = False) -> bool:
        """One commit; False if the batch was committed before. publish, stage: (upserts, deletes or None).

        boundary: what was staged is published, and a replacement that is under way is finished. reset: begins a replacement,
        what is staged is forgotten.
        """
        m = self.manifest()
        if batch <= m["batch"]:
            return False
        first = publish or stage
        m["schema"] = m["schema"] or (_ddl(first[0]) if first else None)
        if reset:
            self._publish(m, staged=[], replacing=True, state=state, batch=batch)
            return True
        new = [self._delta(*publish, m)] if publish else []
        later = [self._delta(*stage, m)] if stage else []
        if boundary:
            base, deltas = ([], m["staged"] + new) if m["replacing"] else (m["base"], m["deltas"] + m["staged"] + new)
            self._publish(m, base=base, deltas=deltas, staged=later, replacing=False, state=state, batch=batch)
        else:
            self._publish(m, staged=m["staged"] + new + later, state=state, batch=batch)
        self._tidy()
        return True

    def replace(self, rows: DataFrame, state: dict[str, Any], batch: int) -> bool:
        """All rows at once. False if the batch was committed before."""
        m = self.manifest()
        if batch <= m["batch"]:
            return False
        self._publish(m, base=[self._base(rows)], deltas=[], staged=[], replacing=False, state=state, batch=batch, schema=_ddl(rows))
        return True

    def merge(self, upserts: DataFrame, deletes: DataFrame, state: dict[str, Any], batch: int) -> bool:
        """Upserts whole rows and deletes keys; nothing else is read or written."""
        return self.commit(batch, state, publish=(upserts, deletes))

    def _base(self, rows: DataFrame) -> str:
        where = self._folder("base")
        rows.repartition(self.buckets, *self.key).write.parquet(where)
        return where

    def _bytes(self, paths: list[str]) -> int:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        return sum(self._manifest._fs.getContentSummary(hadoop(p)).getLength() for p in paths)

    def _tidy(self) -> None:
        """Merges deltas when there are many."""
        m = self.manifest()
        if len(m["deltas"]) < MOST_DELTAS:
            return
        if QUARTER * self._bytes(m["deltas"]) >= self._bytes(m["base"]):
            self._publish(m, base=[self._base(self._merged(m, m["base"], m["deltas"]))], deltas=[])
            return
        changed = self._load(m["deltas"], f"{m['schema']}, _gone boolean, _seq bigint")
        where = self._folder("delta")
        self._newest(changed, [c for c in changed.columns if c not in ("_gone", "_seq")]).write.parquet(where)
        self._publish(m, deltas=[where])

    def vacuum(self) -> None:
        """Deletes files that the manifest does not name."""
        m = self.manifest()
        used = {p.rsplit("/", 1)[1] for p in m["base"] + m["deltas"] + m["staged"]}
        fs, hadoop = self._manifest._fs, self.spark._jvm.org.apache.hadoop.fs.Path
        for x in fs.listStatus(hadoop(self.path)):
            name = x.getPath().getName()
            if name.startswith(("base=", "delta=")) and name not in used:
                fs.delete(x.getPath(), True)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
