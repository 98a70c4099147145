"""Helpers shared by the operators: written stages, worker-wide caches, Arrow slices."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wikipassages.session import ensure_checkpoint_dir

#: Bytes of text that one vectorised step takes at a time (a longer text is a step of its own).
STEP_BYTES = 1 << 20


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme of the store it is in: the session's default one if it names none."""
    full = spark._jvm.org.apache.hadoop.fs.Path(path)
    full = full.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(full).toString()
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage and keeps its result."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _held() -> dict:
    """What this worker process holds for the stage of the running task; what it held for another stage goes."""
    module = sys.modules.setdefault("_llm_worker_cache", types.ModuleType("_llm_worker_cache"))
    task = TaskContext.get()
    stage = task.stageId() if task else None
    if getattr(module, "stage", None) != stage or not hasattr(module, "held"):
        module.stage, module.held = stage, {}
        release()
    return module.held


def cached(key: tuple, make: Callable):
    """``make()`` once for each Python worker process and stage; later tasks of the stage find it.

    Workers outlive their stages, so without this end every stage's tables would stay in memory beside the JVM's heap.
    """
    store = _held()
    if key not in store:
        store[key] = make()
    return store[key]


def release() -> None:
    """Gives memory that this worker no longer uses back to the machine; idle workers stay small beside the JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def frugal(f: Callable) -> Callable:
    """A function from batches to batches that releases memory when it ends."""
    def run(batches):
        _held()
        try:
            yield from f(batches)
        finally:
            release()
    return run


def text_slices(batches: Iterator[pa.RecordBatch], column: str,
                step_bytes: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut so that each holds about ``step_bytes`` of ``column``, whole rows always."""
    taken = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        step = np.cumsum(sizes.astype(np.int64)) // step_bytes
        cuts = np.flatnonzero(np.diff(step)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(int(lo), int(hi - lo))
            taken += 1
            if taken % 16 == 0:
                release()


def crc_remainder(column, divisor: int):
    """crc32 of the value as decimal text, modulo ``divisor``; null counts as empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % divisor
