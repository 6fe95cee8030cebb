"""Tables written to the folder that driver and executors share, so that jobs survive lost executors."""

from __future__ import annotations

import re
import tempfile
import uuid

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

from . import textkernel as tk

#: Files of a staged table for each core that the cluster has, at most.
FILES_A_CORE = 8
#: Share of the driver's largest heap that it may take from the system before its garbage is collected, and by which it has to
#: grow before that is done again.
HEAP_SHARE, HEAP_GROWTH = 0.5, 0.0625


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; where it is unset, a temporary folder on one machine and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = getattr(spark, "_claimloom_folder", None) or tempfile.mkdtemp(prefix="claimloom-")
        spark._claimloom_folder = found
    return found.rstrip("/")


def driver_makes_room(spark: SparkSession) -> None:
    """The driver returns to the system what it holds but does not use: heap, freed native memory, and that of its Python.

    A long chain of jobs leaves garbage, shuffle files and broadcasts that only a collection frees, and the JVM rather takes
    more heap than to collect. Its allocator keeps what compilers and network buffers have freed. Nothing in use is touched.
    """
    jvm = spark._jvm
    heap = jvm.java.lang.Runtime.getRuntime()
    most = heap.maxMemory()
    if heap.totalMemory() > max(HEAP_SHARE * most, getattr(spark, "_claimloom_heap", 0) + HEAP_GROWTH * most):
        jvm.System.gc()
        spark._claimloom_heap = heap.totalMemory()
    try:
        _trim_native(spark)
    except Py4JError:  # this JVM has no such command
        pass
    tk.make_room()


def _trim_native(spark: SparkSession) -> None:
    """The JVM's diagnostic command that returns freed native memory, by the public interface of its management server."""
    jvm, new_array = spark._jvm, spark.sparkContext._gateway.new_array
    types, values = new_array(jvm.Class, 4), new_array(jvm.Object, 4)
    for i, kind in enumerate(("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")):
        types[i] = jvm.Class.forName(kind)
    values[0] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
    values[1] = "systemTrimNativeHeap"
    invoke = jvm.Class.forName("javax.management.MBeanServer").getMethod("invoke", types)
    invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), values)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: lineage ends there.

    Many small partitions go into few files: on a local file system Hadoop starts processes for every file, and until such
    a process runs its own program it shares the whole memory of the executor. Partitions are still worked out one by one,
    so rows and numbers from monotonically_increasing_id stay the same; a step that reads its task's number must not be staged.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/claimloom-{name}-{uuid.uuid4().hex}"
    df.coalesce(FILES_A_CORE * spark.sparkContext.defaultParallelism).write.parquet(path)
    driver_makes_room(spark)
    return spark.read.schema(df.schema).parquet(path)


def summed(parts: DataFrame, fan: int = 64) -> DataFrame:
    """Adds up int64 arrays: rows (piece, source, values binary) become one row (piece, values) for each piece.

    Sources are added in two steps so that no group holds more than about a `fan`-th of them or `fan` arrays.
    """

    def add(table):
        import numpy as np
        import pyarrow as pa

        total = None
        for values in table.column("values"):
            array = np.frombuffer(values.as_buffer(), np.int64)
            total = array.copy() if total is None else total + array
        first = table.slice(0, 1)
        out = {"piece": first.column("piece")}
        if "source" in table.column_names:
            out["source"] = first.column("source")
        return pa.table(out | {"values": pa.array([total.tobytes()], pa.binary())})

    some = parts.withColumn("source", (parts["source"] % fan).cast("int")).groupBy("piece", "source").applyInArrow(add, "piece int, source int, values binary")
    return some.drop("source").groupBy("piece").applyInArrow(add, "piece int, values binary")
