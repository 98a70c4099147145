"""An index of segments: loads are added without touching earlier ones (K6, K7).

``path/segments/<name>/`` holds one load's tables with its own statistics:

* ``docs``, ``postings``, ``field_len``, ``values``   as in :mod:`.index`, postings by field
* ``term_stats``    field, term, df          of this load's documents
* ``field_stats``   field, n_docs, total_len

Document frequencies, document counts and field lengths add up over loads, so
they are summed when the index is read, and an append neither reads nor writes an
older posting. Which segments belong to the index stands in a manifest,
``path/manifest/<version>``, one line for each segment. A load writes its segment under
a new name, then the next version under a draft name, and renames it: the rename is the
commit. What a load left behind before it is never read, and of two loads that commit
the same version one finds the name taken and goes on from the other's.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .index import SearchIndex

TABLES = ("docs", "postings", "field_len", "values", "term_stats", "field_stats")
_VALUES = "term string, doc_id string, value bigint, positions array<int>, field string"


@dataclass
class SegmentedIndex(SearchIndex):
    """A search index over segments; its totals come from the segments' statistics."""

    field_stats: DataFrame | None = None

    def n_docs(self):
        return F.coalesce(self.field_stats.select(F.max("n_docs").cast("double")).scalar(), F.lit(0.0))

    def avg_len(self, field: str):
        total = self.field_stats.where(F.col("field") == field).select(F.sum("total_len").cast("double")).scalar()
        return F.try_divide(F.coalesce(total, F.lit(0.0)), self.n_docs())


class _Folder:
    """The index folder by Hadoop's FileSystem, whatever store it is in."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.path = path.rstrip("/")
        self.fs = self._at("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self._at(name))] if self.fs.exists(self._at(name)) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Write a file under a draft name and rename it; false if the name is taken."""
        draft = self._at(f"{name}.draft-{uuid.uuid4().hex}")
        draft = self.jvm.org.apache.hadoop.fs.Path(draft.getParent(), f"_{draft.getName()}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if not self.fs.exists(self._at(name)) and self.fs.rename(draft, self._at(name)):
            return True
        self.fs.delete(draft, False)
        return False


def _manifest(folder: _Folder) -> tuple[int, list[tuple[str, str]]]:
    """Newest version (0: none yet) and its (segment, load) pairs."""
    versions = sorted(int(n) for n in folder.names("manifest") if n.isdigit())
    if not versions:
        return 0, []
    lines = folder.read(f"manifest/{versions[-1]:08d}").splitlines()
    return versions[-1], [tuple(line.split("\t", 1)) for line in lines]


def write_segment(index: SearchIndex, path: str) -> str:
    """Write ``index`` as a new segment under ``path``, not part of the index yet; returns its name.

    The statistics come from the written tables, so texts are analysed once for each table that needs them.
    """
    spark, name = index.docs.sparkSession, uuid.uuid4().hex
    base = f"{path.rstrip('/')}/segments/{name}"
    index.docs.write.parquet(f"{base}/docs")
    index.postings.write.partitionBy("field").parquet(f"{base}/postings")
    values = index.values if index.values is not None else index.found_positions().drop("len").limit(0)
    values.write.partitionBy("field").parquet(f"{base}/values")
    postings = spark.read.schema(index.postings.schema).parquet(f"{base}/postings")
    lengths = postings.select("doc_id", "field", "len").distinct()
    lengths.write.partitionBy("field").parquet(f"{base}/field_len")
    postings.groupBy("field", "term").agg(F.count(F.lit(1)).alias("df")).write.parquet(f"{base}/term_stats")
    n_docs = spark.read.schema(index.docs.schema).parquet(f"{base}/docs").select(F.count(F.lit(1))).scalar()
    written = spark.read.schema(lengths.schema).parquet(f"{base}/field_len")
    # the row without a field holds the count of documents of a load in which no field has a token
    (written.groupBy("field").agg(F.sum("len").alias("total_len"))
     .union(spark.createDataFrame([("", 0)], "field string, total_len long"))
     .select("field", n_docs.alias("n_docs"), "total_len").write.parquet(f"{base}/field_stats"))
    return name


def commit(spark: SparkSession, path: str, segment: str, load: str = "", mode: str = "append") -> int:
    """Make ``segment`` part of the index at ``path`` (K6), or its only part (``mode="overwrite"``, K7); returns the version.

    A named ``load`` counts once: if the manifest has it already, as when a job is run again after its commit, an
    append changes nothing. Without a name every append adds, as indexing a file again does.
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"mode {mode!r}: append or overwrite")
    if "\n" in load:
        raise ValueError("the name of a load is one line")
    folder = _Folder(spark, path)
    while True:
        version, held = _manifest(folder)
        if mode == "append" and load and any(name == load for _, name in held):
            return version
        held = [*held, (segment, load)] if mode == "append" else [(segment, load)]
        if folder.create(f"manifest/{version + 1:08d}", "".join(f"{s}\t{name}\n" for s, name in held)):
            return version + 1


def add_load(index: SearchIndex, path: str, load: str = "", mode: str = "append") -> int:
    """K6/K7: write ``index`` as a segment and commit it. A named load that is there already is not written again."""
    spark = index.docs.sparkSession
    version, held = _manifest(_Folder(spark, path))
    if mode == "append" and load and any(name == load for _, name in held):
        return version
    return commit(spark, path, write_segment(index, path), load, mode)


def loads(spark: SparkSession, path: str) -> list[str]:
    """Names of the committed loads, in the order of their commits."""
    return [name for _, name in _manifest(_Folder(spark, path))[1]]


def read_segments(spark: SparkSession, path: str) -> SegmentedIndex:
    """The index of the newest manifest; loads that commit later do not change it."""
    _, held = _manifest(_Folder(spark, path))
    if not held:
        raise ValueError(f"no load is committed under {path}")
    bases = [f"{path.rstrip('/')}/segments/{segment}" for segment, _ in held]

    def table(name: str, schema: str | None = None) -> DataFrame:
        reader = spark.read.schema(schema) if schema else spark.read
        out = None
        for base in bases:               # partition columns are found below each segment's own folder
            part = reader.parquet(f"{base}/{name}")
            out = part if out is None else out.unionByName(part)
        return out

    term_stats = table("term_stats").groupBy("field", "term").agg(F.sum("df").alias("df"))
    field_stats = table("field_stats").groupBy("field").agg(F.sum("n_docs").alias("n_docs"), F.sum("total_len").alias("total_len"))
    postings = table("postings", "term string, doc_id string, tf int, len int, positions array<int>, field string")
    return SegmentedIndex(table("docs"), postings, term_stats, table("field_len", "doc_id string, len int, field string"),
                          table("values", _VALUES), field_stats=field_stats)


def drop_unused(spark: SparkSession, path: str) -> int:
    """Delete segments that the newest manifest does not name (failed loads, overwritten ones); returns how many.
    Not while another load is being written."""
    folder = _Folder(spark, path)
    held = {segment for segment, _ in _manifest(folder)[1]}
    unused = [n for n in folder.names("segments") if n not in held]
    for n in unused:
        folder.fs.delete(folder._at(f"segments/{n}"), True)
    return len(unused)
