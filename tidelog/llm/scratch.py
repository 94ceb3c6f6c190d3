"""Intermediate tables in the folder that driver and executors share.

A written table cuts lineage and survives lost executors. Tables go when their owner drops them, or when the
driver's JVM ends.
"""

from __future__ import annotations

import gc
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from tidelog.llm import arrays

BATCH_BYTES = 8 << 20
SAVES = 4  # so many tables after which what the driver holds of done plans is let go


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, one of our own on one machine, and an error on a cluster."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder, and the executors do not share this machine's")
        named = f"file://{tempfile.mkdtemp(prefix='tidelog-')}"
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, deleted when the JVM ends."""
    path = f"{shared_dir(spark)}/tidelog-{name}-{uuid.uuid4().hex[:12]}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def bounded_batches(spark: SparkSession) -> None:
    """Holds Arrow batches of this session to BATCH_BYTES, so that a worker's memory does not follow the length of texts."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = str(spark.conf.get(name)).lower().rstrip("b")
    unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(now[-1:], 1)
    size = int(now.rstrip("kmg")) * unit
    if size <= 0 or size > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def give_back(spark: SparkSession) -> None:
    """Hands memory that the driver has freed, in Python and outside the JVM's heap, back to the system.

    The threads that plan and compile free into many arenas of the C library, which keep it otherwise.
    """
    arrays.give_back()
    jvm = spark._jvm
    try:
        call = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethods() if m.getName() == "invoke")
        args = spark.sparkContext._gateway.new_array(jvm.Object, 4)
        args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        call.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), args)
    except Py4JError:
        pass  # a JVM without this command


class Scratch:
    """Writes tables of one job and drops those that are done with."""

    def __init__(self, spark: SparkSession) -> None:
        bounded_batches(spark)
        self.spark = spark
        self.paths: dict[int, str] = {}
        self.saves = 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = new_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        self.saves += 1
        if self.saves % SAVES == 0:
            self.release()
        else:
            give_back(self.spark)
        return out

    def drop(self, *tables: DataFrame) -> None:
        for df in tables:
            if path := self.paths.pop(id(df), None):
                hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(path)
                hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)

    def release(self) -> None:
        """Lets the shuffle files of plans that are done with go now, not when the driver next collects its garbage."""
        gc.collect()
        self.spark._jvm.System.gc()
        give_back(self.spark)
