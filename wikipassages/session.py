"""Session helpers: sane defaults for the jobs in this package."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Defaults that matter for every job here. AQE re-plans joins from runtime
# sizes (a broadcast only happens behind its size check), coalesces small
# shuffle partitions and splits skewed ones.
_LOCAL_CHECKPOINT_BASE: str | None = None

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "wikipassages", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench; clusters bring their own session."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master.startswith("local"):
        # Local mode runs every task inside the driver JVM: give it a real heap
        # (the default is 1 GB). Clusters size executors in their own config.
        conf["spark.driver.memory"] = os.environ.get("WIKIPASSAGES_DRIVER_MEMORY", "16g")
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for written stages, shared by the driver and all executors.

    The context's checkpoint folder if one is set, else ``spark.checkpoint.dir``.
    With neither, a local master gets a scratch folder (one process, one
    disk); any other master raises, since each executor would write to its
    own disk and later reads would miss those files.
    """
    global _LOCAL_CHECKPOINT_BASE
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        # the context adds a folder of its own below the setting: the setting
        # itself is shared just as well
        return base if base and current.startswith(base.rstrip("/") + "/") else current
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        if _LOCAL_CHECKPOINT_BASE is None:
            _LOCAL_CHECKPOINT_BASE = tempfile.mkdtemp(prefix="wikipassages-ckpt-")
        base = _LOCAL_CHECKPOINT_BASE
    sc.setCheckpointDir(base)
    return base


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """``df`` dealt out evenly over ``partitions``; as it is without a number, or if it is read from twice as many files.

    For inputs packed into fewer splits than the work that follows can use
    (a few large row groups); the caller says so, nothing is guessed from sizes.
    """
    return df.repartition(partitions) if partitions and len(df.inputFiles()) < 2 * partitions else df


#: Parts for each shuffle partition: what a query makes of one part should fit a task's memory.
BUCKETS = 2


def buckets(spark: SparkSession) -> int:
    """Parts that :func:`dealt` makes, and buckets of the tables."""
    return BUCKETS * int(spark.conf.get("spark.sql.shuffle.partitions"))


def dealt(df: DataFrame, *cols: str) -> DataFrame:
    """``df`` dealt out by ``cols`` over ``BUCKETS`` times the session's shuffle partitions; the number is given, so that
    small rows which cost much work are not put together again by their size."""
    return df.repartition(buckets(df.sparkSession), *cols)


def stage_path(spark: SparkSession, name: str) -> str:
    """A new path for files of this run in the shared folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:8]}"


# A written stage is read from its files, so what it shuffled goes when it is written: otherwise the
# shuffles of all stages lie beside them until the driver's JVM happens to collect its garbage.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd",
           # a task holds a bucket or two: it opens their files instead of sorting its rows by bucket
           "spark.sql.maxConcurrentOutputFileWriters": "4"}


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]):
    """``conf`` while the block runs, then what was set before."""
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def leaving_no_shuffles(spark: SparkSession):
    """``WRITING`` while the block runs, for stages written by other means than :func:`materialize`."""
    return _settings(spark, WRITING)


def joined_by_part(spark: SparkSession):
    """While the block runs, a table bucketed by one of several join columns is not shuffled by all of them."""
    return _settings(spark, {"spark.sql.requireAllClusterKeysForCoPartition": "false"})


_MATERIALIZED: dict[tuple[str, str], str] = {}
_BUCKETED: dict[str, str] = {}               # path: name of the table over it


def materialize(spark: SparkSession, name: str, build, bucket: str | None = None) -> DataFrame:
    """Write ``build()`` once as Parquet in the shared checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads files instead of re-running the
    upstream job) and lets several queries of one application share an
    expensive stage such as the primary job or the index. Keyed by
    application id and ``name``. With ``bucket`` the stage is a table bucketed by
    that column, so that a grouping by it (and more) needs no shuffle; rows that
    are :func:`dealt` by it make one file for each bucket.
    """
    key = (spark.sparkContext.applicationId, name)
    path = _MATERIALIZED.get(key)
    if path is None:
        safe = "".join(ch if ch.isalnum() else "_" for ch in name)
        path = os.path.join(ensure_checkpoint_dir(spark), f"{safe}-{uuid.uuid4().hex[:8]}")
        with _settings(spark, WRITING):
            if bucket is None:
                build().write.mode("overwrite").parquet(path)
            else:
                table = re.sub(r"\W", "_", os.path.basename(path))
                build().write.bucketBy(buckets(spark), bucket).option("path", path).format("parquet").saveAsTable(table)
                _BUCKETED[path] = table
        _MATERIALIZED[key] = path
    return spark.table(_BUCKETED[path]) if path in _BUCKETED else spark.read.parquet(path)


def drop_materialized(spark: SparkSession) -> int:
    """Delete the stages this application has written; returns how many. Queries rebuild what they need."""
    app = spark.sparkContext.applicationId
    mine = [key for key in _MATERIALIZED if key[0] == app]
    for key in mine:
        at = _MATERIALIZED.pop(key)
        if at in _BUCKETED:
            spark.sql(f"DROP TABLE IF EXISTS {_BUCKETED.pop(at)}")
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return len(mine)
