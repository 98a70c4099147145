"""Token ids as Simple-8b words in files, and back (operator 9).

A 64-bit word holds a 4-bit selector (top) and 60 bits: as many ids of equal
width as fit, the first in the lowest bits. Selector 14 is an escape: the id
is the whole next word. Ids are coded in blocks of ``BLOCK_IDS``; each
block's first word is in the file, so blocks decode side by side. The last
word of a block may hold fewer ids than its selector says.

File (little endian): magic, then 64-bit numbers: version, texts, ids, ids a
block, blocks; for each text its id (0 if null), a null flag and its number
of ids; for each block its first word's number, and the number of words;
then the words.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wikipassages.llm.common import STEP_BYTES, frugal, qualified, text_slices, written
from wikipassages.llm.word_ids import word_ids

#: Fixed values of the code: bits of an id and ids of a word, by selector.
WIDTHS = [(1, 60), (2, 30), (3, 20), (4, 15), (5, 12), (6, 10), (7, 8), (8, 7), (10, 6), (12, 5), (15, 4), (20, 3), (30, 2), (60, 1)]
ESCAPE = 14
MAGIC = b"S8BTOKEN"
BLOCK_IDS = 1024
#: Blocks coded at a time.
STEP_BLOCKS = 512
#: Ids of a file.
FILE_IDS = 4 << 20


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs."""
    if not ids.size or int(ids.max()) < 1 << 53:
        return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)
    high = (ids >> np.uint64(32)).astype(np.float64)
    return np.where(high > 0, 32 + np.frexp(high)[1], np.frexp((ids & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]).astype(np.uint8)


def pack(ids: np.ndarray, block: int = BLOCK_IDS) -> tuple[np.ndarray, np.ndarray]:
    """Words of all blocks, and each block's first word's number (with the end)."""
    parts = [_pack(ids[i:i + STEP_BLOCKS * block], block) for i in range(0, len(ids), STEP_BLOCKS * block)]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    before = np.cumsum([0, *(len(w) for w, _ in parts)])
    return np.concatenate([w for w, _ in parts]), np.append(np.concatenate([o[:-1] + b for (_, o), b in zip(parts, before)]), before[-1])


def _pack(ids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Some blocks side by side, one word each at a time."""
    blocks = -(-len(ids) // block)
    side = block + 64                     # zeros follow each block, they need no bits
    grid = np.zeros((blocks, side), np.uint64)
    full, rest = divmod(len(ids), block)
    grid[:full, :block] = ids[:full * block].reshape(full, block)
    if rest:
        grid[full, :rest] = ids[full * block:]
    count = np.full(blocks, block)
    count[-1] = rest or block
    widths = _bits(grid)
    powers = {1: widths}                  # widest of the next 1, 2, 4, ... ids
    for k in (2, 4, 8, 16, 32):
        half = powers[k // 2]
        powers[k] = half.copy()
        np.maximum(half[:, :-(k // 2)], half[:, k // 2:], out=powers[k][:, :-(k // 2)])
    choice = np.full((blocks, block), ESCAPE, np.uint8)
    for selector in range(len(WIDTHS) - 1, -1, -1):
        bits, n = WIDTHS[selector]
        k = 1 << (n.bit_length() - 1)
        fits = np.maximum(powers[k][:, :block], powers[k][:, n - k:n - k + block]) <= bits
        np.copyto(choice, selector, where=fits)
    steps = np.array([n for _, n in WIDTHS] + [1])
    choice, base = choice.reshape(-1), np.arange(blocks) * block
    at, live, selectors, starts = np.zeros(blocks, np.int64), np.arange(blocks), [], []
    while len(live):
        here = at[live]
        selector = choice[base[live] + here]
        row_selector, row_start = np.full(blocks, 255, np.uint8), np.zeros(blocks, np.int32)
        row_selector[live], row_start[live] = selector, here
        selectors.append(row_selector)
        starts.append(row_start)
        at[live] = here + steps[selector]
        live = live[at[live] < count[live]]
    table = np.stack(selectors, axis=1)
    row, step = np.nonzero(table != 255)
    selector = table[row, step]
    cell = row * side + np.stack(starts, axis=1)[row, step]
    size = 1 + (selector == ESCAPE)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    flat = grid.reshape(-1)
    for s in np.unique(selector).tolist():
        mine = np.flatnonzero(selector == s)
        word = np.full(len(mine), np.uint64(s << 60), np.uint64)
        if s == ESCAPE:
            words[place[mine] + 1] = flat[cell[mine]]
        else:
            bits, n = WIDTHS[s]
            for j in range(n):
                word |= flat[cell[mine] + j] << np.uint64(bits * j)
        words[place[mine]] = word
    return words, np.append(place[np.searchsorted(row, np.arange(blocks))], len(words))


def unpack(words: np.ndarray, offsets: np.ndarray, total: int, block: int) -> np.ndarray:
    """All ids again."""
    out = np.zeros(total, np.uint64 if total and int((words >> np.uint64(60)).max(initial=0)) >= ESCAPE - 1 else np.uint32)
    for i in range(0, len(offsets) - 1, STEP_BLOCKS):
        edge = offsets[i:i + STEP_BLOCKS + 1]
        n = min(total - i * block, (len(edge) - 1) * block)
        out[i * block:i * block + n] = _unpack(words[edge[0]:edge[-1]], edge - edge[0], n, block)
    return out


def _unpack(words: np.ndarray, offsets: np.ndarray, total: int, block: int) -> np.ndarray:
    """Some blocks side by side, one pass for each selector."""
    blocks = len(offsets) - 1
    steps = np.array([n for _, n in WIDTHS] + [1])
    selector = (words >> np.uint64(60)).astype(np.uint8)
    is_word = np.ones(len(words), bool)
    # a raw word follows each escape; runs of them are settled from the left
    for i in np.flatnonzero(selector == ESCAPE).tolist():
        if is_word[i] and i + 1 < len(words):
            is_word[i + 1] = False
    heads = np.flatnonzero(is_word)
    if len(heads) and int(selector[heads].max()) > ESCAPE:
        raise ValueError("not a Simple-8b selector")
    counts = steps[selector[heads]]
    before = np.cumsum(counts) - counts
    first = np.searchsorted(heads, offsets[:-1])
    row = np.searchsorted(offsets, heads, side="right") - 1
    start = before - before[first][row] if blocks else before
    out = np.zeros((blocks, block + 64), np.uint64)
    for s in np.unique(selector[heads]):
        mine = np.flatnonzero(selector[heads] == s)
        if s == ESCAPE:
            out[row[mine], start[mine]] = words[heads[mine] + 1]
            continue
        bits, n = WIDTHS[s]
        body = words[heads[mine]]
        mask = np.uint64((1 << bits) - 1)
        for j in range(n):
            out[row[mine], start[mine] + j] = (body >> np.uint64(bits * j)) & mask
    return out[:, :block].reshape(-1)[:total]


def to_file(doc: np.ndarray, null: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> bytes:
    words, offsets = pack(ids)
    head = np.array([1, len(doc), len(ids), BLOCK_IDS, len(offsets) - 1], "<i8")
    return b"".join([MAGIC, head.tobytes(), doc.astype("<i8").tobytes(), null.astype("u1").tobytes(), counts.astype("<i8").tobytes(),
                     offsets.astype("<i8").tobytes(), words.astype("<u8").tobytes()])


def from_file(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(doc, null, counts, ids) of a file; a file of another kind or cut short raises."""
    if raw[:8] != MAGIC:
        raise ValueError("not a token file")
    _, docs, total, block, blocks = np.frombuffer(raw, "<i8", 5, 8).tolist()
    at = 48
    parts = []
    for kind, n in (("<i8", docs), ("u1", docs), ("<i8", docs), ("<i8", blocks + 1)):
        parts.append(np.frombuffer(raw, kind, n, at))
        at += parts[-1].nbytes
    words = np.frombuffer(raw, "<u8", int(parts[3][-1]), at)
    return parts[0], parts[1].astype(bool), parts[2], unpack(words, parts[3], total, block)


def _put(folder: str, name: str, content: bytes) -> str:
    """Writes a file under another name first, so that a lost task leaves no half file under its own."""
    system, path = pafs.FileSystem.from_uri(folder)
    system.create_dir(path, recursive=True)
    draft = f"{path}/_{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as f:
        f.write(content)
    try:
        system.move(draft, f"{path}/{name}")
    except OSError:                 # stores that do not rename onto the file of an earlier attempt
        system.delete_file(f"{path}/{name}")
        system.move(draft, f"{path}/{name}")
    return f"{folder}/{name}"


def write_files(df: DataFrame, folder: str, tokenizer: str, end_id: int, doc: str = "doc_id", text: str = "text",
                file_ids: int = FILE_IDS) -> DataFrame:
    """Writes the ids of all texts, each with ``end_id`` after it, in ascending order of ``doc``.

    Null ids come first; rows of one id are ordered by their text. Null and
    empty texts have the end id only. Texts are range-partitioned before they
    are encoded, each partition writes files of about ``file_ids`` ids (a
    longer text has a file of its own). A folder without a scheme is in the session's
    default store. Returns the written manifest: part, file (number in the part), name, docs, ids.
    """
    folder = qualified(df.sparkSession, folder)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        codec = word_ids(tokenizer)
        docs: list[np.ndarray] = []
        nulls: list[np.ndarray] = []
        held: list[np.ndarray] = []
        lengths: list[np.ndarray] = []
        size, number = 0, 0

        def flush():
            counts, ids = np.concatenate(lengths), np.concatenate(held)
            name = f"part-{part:06d}-{number:04d}.s8b"
            _put(folder, name, to_file(np.concatenate(docs), np.concatenate(nulls), counts, ids))
            return pa.RecordBatch.from_pydict({"part": [part], "file": [number], "name": [name], "docs": [len(counts)], "ids": [len(ids)]},
                                              schema=pa.schema([("part", pa.int32()), ("file", pa.int32()), ("name", pa.string()),
                                                                ("docs", pa.int64()), ("ids", pa.int64())]))

        for rows in text_slices(batches, "text", min(STEP_BYTES, 4 * file_ids)):
            ids, offsets = codec.encode(rows.column("text"))
            ids = np.insert(ids, offsets[1:], end_id).astype(np.uint32)
            if held and size + len(ids) > file_ids:
                yield flush()
                docs, nulls, held, lengths, size, number = [], [], [], [], 0, number + 1
            docs.append(rows.column("doc").fill_null(0).to_numpy())
            nulls.append(rows.column("doc").is_null().to_numpy(zero_copy_only=False))
            held.append(ids)
            lengths.append(np.diff(offsets) + 1)
            size += len(ids)
        if held:
            yield flush()

    rows = df.select(F.col(doc).cast("bigint").alias("doc"), F.col(text).alias("text"))
    ordered = rows.repartitionByRange(F.col("doc")).sortWithinPartitions("doc", "text")
    return written(ordered.mapInArrow(frugal(encoded), "part int, file int, name string, docs bigint, ids bigint"), "token-manifest")


def read_files(spark: SparkSession, folder: str, manifest: DataFrame, doc: str = "doc_id") -> DataFrame:
    """(doc, start, n_tokens, ids_crc32) of every text, from the files named in the manifest.

    A missing, cut or foreign file raises, and one that does not hold the manifest's number of texts and ids.
    ``start``: ids of all texts before.
    """
    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("name"), batch.column("content")):
                docs, nulls, counts, ids = from_file(content.as_buffer())
                ids = ids.astype("<u4", copy=False)
                ends = np.cumsum(counts)
                crc = [zlib.crc32(ids[e - n:e]) for e, n in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(docs)), pa.array([len(docs)] * len(docs), pa.int64()),
                                                  pa.array([len(ids)] * len(docs), pa.int64()), pa.array(docs, mask=nulls), pa.array(ends - counts),
                                                  pa.array(counts), pa.array(crc, pa.int64())],
                                                 ["name", "docs", "ids", "doc", "local", "n_tokens", "ids_crc32"])

    ordered = Window.orderBy("part", "file").rowsBetween(Window.unboundedPreceding, -1)   # one row a file
    bases = manifest.select("name", F.col("docs").alias("all_docs"), F.col("ids").alias("all_ids"), F.coalesce(F.sum("ids").over(ordered), F.lit(0)).alias("base"))
    if manifest.isEmpty():
        return bases.select(F.lit(None).cast("bigint").alias(doc), F.col("base").alias("start"),
                            F.col("base").alias("n_tokens"), F.col("base").alias("ids_crc32"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*.s8b").load(qualified(spark, folder)) \
        .select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    lost = bases.join(files.select("name"), "name", "left_anti").first()          # names only, no content is read
    if lost is not None:
        raise FileNotFoundError(f"{folder}/{lost['name']} is in the manifest but not there")
    rows = files.mapInArrow(frugal(decoded), "name string, docs bigint, ids bigint, doc bigint, local bigint, n_tokens bigint, ids_crc32 bigint")
    whole = (F.col("docs") == F.col("all_docs")) & (F.col("ids") == F.col("all_ids"))
    start = F.when(whole, F.col("base") + F.col("local")).otherwise(F.raise_error(F.concat(F.lit("not the texts of the manifest: "), F.col("name"))).cast("bigint"))
    return rows.join(bases, "name").select(F.col("doc").alias(doc), start.alias("start"), "n_tokens", "ids_crc32")
