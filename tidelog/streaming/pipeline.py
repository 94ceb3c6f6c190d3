"""The streaming pipeline: change-log micro-batches into a generation table, rows and resume state in one commit."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.operators import cdc
from tidelog.streaming import quarantine
from tidelog.streaming.store import GenerationTable

BOUNDARIES = ("up_to_date", "snapshot_end", "subset_end")
HYDRATION_PASSES = 5
_WIRE = ("control", "schema", "version")


def apply_batch(
    table: GenerationTable,
    batch: DataFrame,
    batch_id: int,
    segments: int | None = None,
    hydrate: Callable[[DataFrame], DataFrame] | None = None,
    fields: dict[str, str] | None = None,
    at_boundaries: bool = False,
    more_state: dict | None = None,
    keep: tuple[str, ...] | None = None,
) -> bool:
    """Applies one batch of changes (key columns, offset, op, values; control if there is one). False if it was committed before.

    fields: changes carry some columns only (column -> the boolean column that tells whether); else they carry whole rows.
    hydrate: given the keys of rows that are updated but not there, returns whole rows for them; asked HYDRATION_PASSES times at most.
    A batch with a reset keeps its reset alone, and from then on the table is being replaced. While it is, and always with
    at_boundaries, changes are staged until a boundary comes: readers see the rows of a finished boundary only.
    keep: the table's columns, where it has not all of the changes'.
    """
    if batch_id <= table.manifest()["batch"]:
        return False
    if "schema" in batch.columns and "version" in batch.columns:
        quarantine.check(batch, segments)
    has_control = "control" in batch.columns
    control = F.col("control") if has_control else F.lit(None).cast("string")
    last = lambda c: F.max(F.when(c, F.col("offset")))
    top, reset, end = batch.agg(last(control.isNull()), last(control.isin(*cdc.RESETS)), last(control.isin(*BOUNDARIES))).first()
    m = table.manifest()
    state = m["state"] | (more_state or {})
    rows = (batch.where(control.isNull()) if has_control else batch).drop(*_WIRE)
    if reset is not None:
        current = table.read()
        return table.commit(batch_id, state | {"replacing": True, "offset": "-1"}, publish=None if current is not None else (_whole(rows, fields).where("false"), None), reset=True)
    waits = has_control and (at_boundaries or m["replacing"])
    only = lambda sides: tuple(x.select(*keep) if keep and set(keep) <= set(x.columns) else x for x in sides)
    changed = lambda part, old: only(_changes(table, part, old, fields, hydrate))
    old = table.read(staged=True)
    if not waits:
        return table.commit(batch_id, state | ({"offset": str(top)} if top is not None else {}), publish=changed(rows, old))
    if end is None:
        return table.commit(batch_id, state, stage=changed(rows, old), boundary=False)
    state.pop("replacing", None)
    seen, later = rows.where(F.col("offset") <= end), rows.where(F.col("offset") > end)
    done = changed(seen, old)
    rest = None
    if top is not None and top > end:  # what comes after the boundary waits for the next one
        rest = changed(rows, old) if fields else changed(later, None)
    shown = top if top is None or top <= end else seen.agg(F.max("offset")).first()[0]
    return table.commit(batch_id, state | ({"offset": str(shown)} if shown is not None else {}), publish=done, stage=rest)


def _whole(rows: DataFrame, fields: dict[str, str] | None) -> DataFrame:
    return rows.drop("op", *fields.values()) if fields else rows


def _changes(table: GenerationTable, rows: DataFrame, old: DataFrame | None, fields: dict[str, str] | None, hydrate: Callable[[DataFrame], DataFrame] | None) -> tuple[DataFrame, DataFrame]:
    """(upserts, deletes) of ordered changes over the rows there were."""
    key = table.key[0]
    if not fields:
        last = cdc.latest(rows, key, "offset").select(*rows.columns)
        return last.where("op <> 'delete'"), last.where("op = 'delete'").select(*table.key)
    touched = rows.select(key).distinct()
    columns = [key, "offset", *fields]
    known = None
    if old is not None:
        known = old.select(*columns).join(touched, key, "left_semi")
        start = known.withColumn("offset", F.lit(-1).cast(rows.schema["offset"].dataType)).withColumn("op", F.lit("insert")).withColumns({has: F.lit(True) for has in fields.values()})
        log = start.unionByName(rows.select(*start.columns))
    else:
        log = rows.select(*columns, "op", *fields.values())
    alive = cdc.partial_rows(log, fields, key).select(*columns)
    if hydrate is not None:
        missing = cdc.missing_updates(rows, key, existing=known)
        for _ in range(HYDRATION_PASSES):
            if missing.isEmpty():
                break
            found = hydrate(missing).select(key, *fields)
            stamped = found.join(rows.groupBy(key).agg(F.max("offset").alias("offset")), key).select(*columns)
            alive = alive.join(stamped.select(key), key, "left_anti").select(*columns).unionByName(stamped)
            missing = missing.join(found.select(key), key, "left_anti")
    return alive, touched.join(alive.select(key), key, "left_anti")


def start(stream: DataFrame, table: GenerationTable, checkpoint: str, available_now: bool = True, segments: int | None = None, at_boundaries: bool = True, **options):
    """Runs the pipeline; exactly once through the checkpoint's batch numbers and the table's manifest. options: of apply_batch."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: apply_batch(table, df, n, segments, at_boundaries=at_boundaries, **options))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, one of our own on one machine, and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder, and the executors do not share this machine's")
        named = f"file://{tempfile.mkdtemp(prefix='tidelog-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared one, deleted when the JVM ends."""
    path = f"{shared_dir(spark)}/tidelog-{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def replay(spark: SparkSession, changes: DataFrame, files: int = 4) -> DataFrame:
    """Writes a change log as files, streams them in whatever order, and returns the table's rows: the offset decides, deletes stay as rows."""
    root = new_folder(spark, "stream")
    changes.repartitionByRange(files, "offset").write.parquet(f"{root}/log")
    table = GenerationTable(spark, f"{root}/table", ["key"], 4, order="offset")
    stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/log")
    each = lambda df, n: table.commit(n, table.state(), publish=(cdc.latest(df, "key", "offset").select(*df.columns), None))
    stream.writeStream.option("checkpointLocation", f"{root}/checkpoint").foreachBatch(each).trigger(availableNow=True).start().awaitTermination()
    return table.read().where("op <> 'delete'")


def replay_in_order(spark: SparkSession, changes: DataFrame, part: str, parts: int, key: str = "key", **options) -> DataFrame:
    """Writes the parts of a change log (numbers in a column) one after the other, streams them through start(), and returns the table's rows."""
    root = new_folder(spark, "stream")
    for i in range(parts):
        changes.where(F.col(part) == i).drop(part).coalesce(1).write.mode("append").parquet(f"{root}/log")
    table = GenerationTable(spark, f"{root}/table", [key], 4)
    stream = spark.readStream.schema(changes.drop(part).schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/log")
    start(stream, table, f"{root}/checkpoint", **options).awaitTermination()
    return table.read()
