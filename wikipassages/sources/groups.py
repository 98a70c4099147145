"""Group lines written piece by piece (K2, K3): no row and no task ever holds a group.

A line is the run of its pieces: the head with the number of members, one piece
for each member, the end. The pieces of a key meet in one task, sorted by
Spark's spilling sort, and a Python data source appends their bytes to a draft
file as they come; the files get their names when the whole job has committed.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..functions.text import FIELD_SEP

# the writer's classes travel with the job: executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass
class PartWritten(WriterCommitMessage):
    partition: int
    draft: str
    size: int


class PieceWriter(DataSourceArrowWriter):
    """Tasks append the text column's bytes to drafts; commit names them; abort drops them.

    Drafts lie in one folder of the job whose name starts with ``_``, which readers skip.
    Each attempt has a draft of its own, so a lost or repeated task leaves nothing in a file.
    """

    def __init__(self, folder: str, job: str):
        self.folder, self.drafts = folder, f"{folder}/_drafts-{job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> PartWritten:
        system, drafts = pafs.FileSystem.from_uri(self.drafts)
        system.create_dir(drafts, recursive=True)
        draft, size = f"part-{uuid.uuid4().hex}", 0
        with system.open_output_stream(f"{drafts}/{draft}") as out:
            for batch in iterator:
                pieces = batch.column(0).cast(pa.large_binary())
                if len(pieces):          # the column's bytes stand one after another in its buffer
                    _, offsets, data = pieces.buffers()
                    ends = pa.Array.from_buffers(pa.int64(), len(pieces) + 1, [None, offsets], offset=pieces.offset)
                    size += out.write(data.slice(ends[0].as_py(), ends[-1].as_py() - ends[0].as_py()))
        return PartWritten(TaskContext.get().partitionId(), draft, size)

    def commit(self, messages: list[PartWritten | None]) -> None:
        system, drafts = pafs.FileSystem.from_uri(self.drafts)
        folder = drafts.rsplit("/", 1)[0]
        for m in messages:
            if m is not None and m.size:
                system.move(f"{drafts}/{m.draft}", f"{folder}/part-{m.partition:05d}.txt")
        with system.open_output_stream(f"{folder}/_SUCCESS"):
            pass
        system.delete_dir(drafts)

    def abort(self, messages: list[PartWritten | None]) -> None:
        system, drafts = pafs.FileSystem.from_uri(self.drafts)
        if system.get_file_info(drafts).type == pafs.FileType.Directory:
            system.delete_dir(drafts)


class PieceFiles(DataSource):
    """Write-only source ``group_pieces``: option ``path``; one text column, written without separators."""

    @classmethod
    def name(cls) -> str:
        return "group_pieces"

    def writer(self, schema: StructType, overwrite: bool) -> PieceWriter:
        return PieceWriter(self.options["path"], uuid.uuid4().hex)


def write_group_lines(heads: DataFrame, members: DataFrame, path: str, key: str = "key",
                      num_parts: int | None = None) -> None:
    """Write one line for each row of ``heads``: ``head``, the number of members, the members, ``end``.

    ``heads``: ``key`` (unique), ``head``, ``end`` strings. ``members``: ``key``, ``order`` (any
    sortable type), ``piece``; several rows of a key may be equal, all are written, sorted by
    ``order`` and ``piece``. Members of a key that ``heads`` lacks raise nothing and are not
    written; a null ``head``, ``end`` or ``piece`` counts as empty. Lines stand in hash-partitioned
    files (``num_parts``: how many, K8), each sorted by key (L5); no line breaks are allowed inside.
    An existing ``path`` raises before anything is written (K9).

    If ``heads`` has a column ``n``, that is each key's number of members and ``members`` has no other
    keys: then every piece is shuffled once and nothing is joined. Else members are counted, with a
    partial count for each map task. One line lies in one file,
    so one task writes a hot key's line; it streams through in Arrow batches and is never held.
    """
    spark = heads.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(folder):
        raise FileExistsError(path)
    uri = fs.makeQualified(folder).toString()
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri.replace("file:/", "file:///", 1)

    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))
    numbered = heads
    if "n" not in heads.columns:
        counts = members.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
        numbered = heads.select(key, "head").join(counts, key, "left")          # the ends, which may be long, stay out of the join
        members = members.join(heads.select(key), key, "left_semi")
    order = F.lit(None).cast(members.schema["order"].dataType)

    def pieces_of(df: DataFrame, kind: int, order: Column, piece: Column) -> DataFrame:
        return df.select(F.col(key).alias("_key"), F.lit(kind).alias("_kind"), order.alias("_order"), piece.alias("_piece"))
    pieces = (pieces_of(numbered, 0, order, F.concat(text("head"), F.coalesce("n", F.lit(0)).cast("string")))
              .unionByName(pieces_of(members, 1, F.col("order"), text("piece")))
              .unionByName(pieces_of(heads, 2, order, F.concat(text("end"), F.lit("\n")))))
    pieces = pieces.repartition(num_parts, "_key") if num_parts else pieces.repartition("_key")
    spark.dataSource.register(PieceFiles)
    pieces.sortWithinPartitions("_key", "_kind", "_order", "_piece").select("_piece") \
        .write.format(PieceFiles.name()).option("path", uri).mode("append").save()


def write_redirect_groups(moved: DataFrame, path: str, num_parts: int | None = None) -> None:
    """K2 (L2): ``key, title, text`` rows, one line for each key: ``key⇥n███title███text…``, sorted by title and text."""
    heads = moved.groupBy("key").agg(F.count(F.lit(1)).alias("n")).select("key", F.concat("key", F.lit("\t")).alias("head"), "n", F.lit("").alias("end"))
    # members of equal titles are sorted by their pieces, that is by text
    members = moved.select("key", F.col("title").alias("order"),
                           F.concat(F.lit(FIELD_SEP), F.coalesce("title", F.lit("")), F.lit(FIELD_SEP), F.coalesce("text", F.lit(""))).alias("piece"))
    write_group_lines(heads, members, path, num_parts=num_parts)


def write_sections(redirected: DataFrame, redirects: DataFrame, path: str, num_parts: int | None = None) -> None:
    """K3 (L3): ``key⇥page███section███n███redirect…███text``; ``redirected`` has one row for each key, titles are sorted.

    A column ``n`` of ``redirected`` is taken as in :func:`write_group_lines`.
    """
    sep = F.lit(FIELD_SEP)
    heads = redirected.select("key", F.concat("key", F.lit("\t"), "page", sep, "section", sep).alias("head"),
                              F.concat(sep, F.coalesce("text", F.lit(""))).alias("end"), *(["n"] if "n" in redirected.columns else []))
    members = redirects.select("key", F.col("redirect").alias("order"), F.concat(sep, F.coalesce("redirect", F.lit(""))).alias("piece"))
    write_group_lines(heads, members, path, num_parts=num_parts)
