"""Importance resampling towards a target corpus by hashed n-gram features (operator 13).

Features are a text's words and pairs of neighbouring words; a feature's
bucket is the CRC-32 of its bytes modulo ``BUCKETS``. Words repeat by Zipf's law, so
the work is split into head and tail: the most frequent words with their CRC
states and the most frequent pairs of the first among them with their buckets
are broadcast (``HEAD_WORDS`` words of at most ``WORD_BYTES`` bytes, ``HEAD_PAIRS``
pairs: some megabytes whatever the corpus); any other feature takes its CRC
directly from the bytes, a pair from the state behind its first word on. Both
ways give the same exact bucket, so the tables save work and never decide a
result. Counts of words, pairs and buckets go over all texts.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikipassages.llm.common import cached, frugal, text_slices, written
from wikipassages.llm.words import Words, text_bytes, words_from

BUCKETS = 10_000
HEAD_WORDS = 1 << 15
PAIR_WORDS = 512
HEAD_PAIRS = 1 << 16
WORD_BYTES = 64
#: Distinct words a task holds before it hands their counts on.
HELD = 200_000

#: Bytes that separate words, after lower-casing: ASCII but digits and letters.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())


def _lower() -> np.ndarray:
    out = np.arange(256, dtype=np.uint8)
    out[65:91] += 32
    return out


def _crc_table() -> np.ndarray:
    """The CRC-32 of zlib, byte by byte: reflected polynomial 0xEDB88320."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = (out >> np.uint32(1)) ^ np.where(out & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    return out


def lower_words(column: pa.Array) -> Words:
    data, docs = text_bytes(column)
    return words_from(cached(("lower",), _lower)[data], docs, SEPARATORS)


def crc_from(state: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 after further bytes ``data[start:end]``, from the CRCs ``state`` (0 for none); one step for each byte of
    the longest range, ranges over ``WORD_BYTES`` by zlib one at a time."""
    table = cached(("crc table",), _crc_table)
    out = state.astype(np.uint32) ^ np.uint32(0xFFFFFFFF)
    length = end - start
    order = np.argsort(-np.minimum(length, WORD_BYTES + 1), kind="stable")
    sizes = length[order]
    first = np.searchsorted(-sizes, -WORD_BYTES)            # ranges before it are longer
    for i in order[:first]:
        out[i] = zlib.crc32(data[start[i]:end[i]].tobytes(), int(state[i])) ^ 0xFFFFFFFF
    order, sizes = order[first:], sizes[first:]
    at, register = start[order], out[order]
    for k in range(int(sizes[0]) if len(sizes) else 0):
        m = np.searchsorted(-sizes, -k)                       # ranges with a byte number k
        register[:m] = table[(register[:m] ^ data[at[:m] + k]) & np.uint32(255)] ^ (register[:m] >> np.uint32(8))
    out[order] = register
    return out ^ np.uint32(0xFFFFFFFF)


def word_array(words: Words) -> pa.LargeBinaryArray:
    """The words as one Arrow array."""
    length = words.end - words.start
    offsets = np.zeros(len(length) + 1, np.int64)
    np.cumsum(length, out=offsets[1:])
    places = np.arange(offsets[-1]) + np.repeat(words.start - offsets[:-1], length)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(words.data[places])])


@dataclass
class Head:
    """The broadcast tables: words by falling frequency with their CRC states, pairs of the first words with their buckets."""
    words: list[bytes]
    states: np.ndarray          # CRC-32 of each word
    spaced: np.ndarray          # CRC-32 of each word and a space
    pairs: np.ndarray           # ascending: number of the first word * PAIR_WORDS + number of the second
    pair_buckets: np.ndarray

    @classmethod
    def of(cls, words: list[bytes], pairs: list[int] = ()) -> Head:
        states = np.array([zlib.crc32(w) for w in words], np.uint32)
        spaced = np.array([zlib.crc32(b" ", int(s)) for s in states], np.uint32)
        pairs = np.sort(np.array(pairs, np.int64))
        buckets = [zlib.crc32(words[p % PAIR_WORDS], int(spaced[p // PAIR_WORDS])) % BUCKETS for p in pairs.tolist()]
        return cls(words, states, spaced, pairs, np.array(buckets, np.int64))

    def parts(self) -> tuple:
        """Plain arrays and lists, for a broadcast."""
        return self.words, self.states, self.spaced, self.pairs, self.pair_buckets

    def numbers(self, words: Words) -> np.ndarray:
        """The number of each word in the table, by its bytes; -1 if it is not there."""
        found = pc.index_in(word_array(words), value_set=pa.array(self.words, pa.large_binary()))
        return pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def buckets(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Bucket of each word, bucket of each pair, and the number of the pair's first word."""
        number = self.numbers(words)
        state, spaced = np.zeros(len(number), np.uint32), np.zeros(len(number), np.uint32)
        known = number >= 0
        state[known], spaced[known] = self.states[number[known]], self.spaced[number[known]]
        tail = np.flatnonzero(~known)
        state[tail] = crc_from(np.zeros(len(tail), np.uint32), words.data, words.start[tail], words.end[tail])
        space = np.frombuffer(b" ", np.uint8)
        spaced[tail] = crc_from(state[tail], space, np.zeros(len(tail), np.int64), np.ones(len(tail), np.int64))
        first = _pair_starts(words)
        key = _pair_keys(number, first)
        at = np.minimum(np.searchsorted(self.pairs, key), max(len(self.pairs) - 1, 0))
        frequent = self.pairs[at] == key if len(self.pairs) else np.zeros(len(key), bool)
        pair = np.zeros(len(first), np.int64)
        pair[frequent] = self.pair_buckets[at[frequent]]
        rest = first[~frequent]
        pair[~frequent] = crc_from(spaced[rest], words.data, words.start[rest + 1], words.end[rest + 1]) % np.uint32(BUCKETS)
        return (state % np.uint32(BUCKETS)).astype(np.int64), pair, first


def _pair_starts(words: Words) -> np.ndarray:
    """Numbers of the words that have a next word in the same text."""
    inside = np.ones(len(words.start), bool)
    last = words.first[1:][words.counts() > 0] - 1
    inside[last] = False
    return np.flatnonzero(inside)


def _pair_keys(number: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Key of each pair whose words are both among the first ``PAIR_WORDS``; -1 for the others."""
    a, b = number[first], number[first + 1]
    ok = (a >= 0) & (a < PAIR_WORDS) & (b >= 0) & (b < PAIR_WORDS)
    return np.where(ok, a * PAIR_WORDS + b, -1)


# ---------------------------------------------------------------- the head, counted over all texts
def most_frequent(counts: DataFrame, most: int) -> list:
    """At most ``most`` keys of highest count above 1 (columns: key, ``n``), by falling count.

    Counts are graded in eighths of a power of two; all keys of the highest grades that fit are taken, so only
    the sizes of the grades and the result come to the driver, not the best of every task.
    """
    key = counts.columns[0]
    graded = written(counts.where("n > 1").withColumn("grade", F.floor(8 * F.log2("n")).cast("int")), "counts")
    lowest, taken = None, 0
    for r in sorted(graded.groupBy("grade").count().collect(), key=lambda r: -r["grade"]):
        taken += r["count"]
        if taken > most:
            break
        lowest = r["grade"]
    if lowest is None:
        return []
    rows = graded.where(F.col("grade") >= lowest).select(key, "n").collect()
    return [r[key] for r in sorted(rows, key=lambda r: (-r["n"], r[key]))]


def frequent_words(docs: DataFrame, text: str = "text", most: int = HEAD_WORDS) -> list[bytes]:
    """Words of highest count over all texts, ``most`` at most, of at most ``WORD_BYTES`` bytes."""
    def folded(parts: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(parts).group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"])

    def counted(batches):
        held = []
        for piece in text_slices(batches, text):
            array = word_array(lower_words(piece.column(text)))
            counts = array.filter(pc.less_equal(pc.binary_length(array), WORD_BYTES)).value_counts()
            held.append(pa.table({"word": counts.field(0).cast(pa.binary()), "n": counts.field(1)}))
            if sum(len(t) for t in held) > HELD:
                held = [folded(held)]
                if len(held[0]) > HELD // 2:
                    yield from held.pop().to_batches(1 << 14)
        if held:
            yield from folded(held).to_batches(1 << 14)

    rows = docs.select(text).mapInArrow(frugal(counted), "word binary, n long")
    return [bytes(w) for w in most_frequent(rows.groupBy("word").agg(F.sum("n").alias("n")), most)]


def frequent_pairs(docs: DataFrame, words: list[bytes], text: str = "text", most: int = HEAD_PAIRS) -> list[int]:
    """Pairs of highest count over all texts among the first ``PAIR_WORDS`` of ``words``, ``most`` at most, as keys."""
    head = Head.of(words[:PAIR_WORDS])

    def counted(batches):
        total = np.zeros(PAIR_WORDS * PAIR_WORDS, np.int64)
        for piece in text_slices(batches, text):
            w = lower_words(piece.column(text))
            key = _pair_keys(head.numbers(w), _pair_starts(w))
            total += np.bincount(key[key >= 0], minlength=len(total))
        seen = np.flatnonzero(total)
        yield from pa.table({"pair": seen, "n": total[seen]}).to_batches(1 << 14)

    rows = docs.select(text).mapInArrow(frugal(counted), "pair long, n long")
    return most_frequent(rows.groupBy("pair").agg(F.sum("n").alias("n")), most)


def head_of(docs: DataFrame, text: str = "text") -> Head:
    words = frequent_words(docs, text)
    return Head.of(words, frequent_pairs(docs, words, text))


# ---------------------------------------------------------------- buckets and weights
def bucket_totals(docs: DataFrame, head: Head, text: str = "text") -> DataFrame:
    """``bucket, n``: features of all texts in each bucket that has any."""
    shared = docs.sparkSession.sparkContext.broadcast(head.parts())

    def counted(batches):
        total = np.zeros(BUCKETS, np.int64)
        for piece in text_slices(batches, text):
            single, pair, _ = Head(*shared.value).buckets(lower_words(piece.column(text)))
            total += np.bincount(single, minlength=BUCKETS) + np.bincount(pair, minlength=BUCKETS)
        seen = np.flatnonzero(total)
        yield from pa.table({"bucket": seen.astype(np.int32), "n": total[seen]}).to_batches()

    return docs.select(text).mapInArrow(frugal(counted), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame) -> DataFrame:
    """``bucket, gain`` for every bucket: floor(1000 * log of the smoothed target share over the smoothed raw share)."""
    every = raw.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    counts = every.join(raw.select("bucket", F.col("n").alias("s")), "bucket", "left").join(
        target.select("bucket", F.col("n").alias("t")), "bucket", "left").na.fill(0)

    def total(df):
        return F.coalesce(df.select(F.sum("n")).scalar(), F.lit(0)).cast("double") + BUCKETS
    ratio = (F.col("t") + 1).cast("double") * total(raw) / ((F.col("s") + 1).cast("double") * total(target))
    return counts.select("bucket", F.floor(1000 * F.log(ratio)).cast("long").alias("gain"))


def weighed(docs: DataFrame, head: Head, gains: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_features, weight`` of every row: the floored mean of its features' gains, 0 without features."""
    shared = docs.sparkSession.sparkContext.broadcast((head.parts(), gains))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))

    def summed(batches):
        parts, gain = shared.value
        tables = Head(*parts)
        for piece in text_slices(batches, "text"):
            w = lower_words(piece.column("text"))
            single, pair, first = tables.buckets(w)
            sums = np.zeros(len(w.start) + 1, np.int64)
            per_word = gain[single]
            per_word[first] += gain[pair]
            np.cumsum(per_word, out=sums[1:])
            total, n_words = sums[w.first[1:]] - sums[w.first[:-1]], w.counts().astype(np.int64)
            n = n_words + np.maximum(n_words - 1, 0)
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([piece.column("key"), pa.array(n_words), pa.array(n), pa.array(weight)],
                                             ["key", "n_words", "n_features", "weight"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(frugal(summed), f"key {kind}, n_words long, n_features long, weight long").withColumnRenamed("key", key)


def drawn(scored: DataFrame, eligible, percent: int, key: str = "doc_id") -> DataFrame:
    """``scored`` with ``rank``: 1, 2, 3... by falling ``score``, ties by ``key``, of the best ``percent`` % of eligible rows.

    Ranges of the order are sorted apart and numbered from the sizes of those before, so no task holds all rows.
    """
    order = [F.desc("score"), F.asc(key)]
    ranged = written(scored.where(eligible).repartitionByRange(*order).sortWithinPartitions(*order)
                     .withColumn("__at", F.monotonically_increasing_id()), "draw-order")
    part = F.shiftright("__at", 33)
    ends = {r["p"]: r["n"] for r in ranged.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}   # a row a partition
    before, starts = 0, []
    for p in sorted(ends):
        starts.append((p, before))
        before += ends[p]
    starts = scored.sparkSession.createDataFrame(starts, "__p long, __before long")
    place = F.col("__before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    ranked = ranged.join(starts, part == F.col("__p")).withColumn("rank", F.when(place <= percent * before // 100, place))
    rest = scored.where(~F.coalesce(eligible, F.lit(False))).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*rest.columns).union(rest)


def resampled(docs: DataFrame, target: DataFrame, percent: int = 25, min_words: int = 20, seed: int = 7,
              key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_words, n_features, weight, score, rank`` of every row of ``docs``; ``rank`` is null for rows not drawn.

    A row's score is its weight plus Gumbel noise from the hash of ``seed`` and its key, so that the best scores are
    a draw without replacement in proportion to the weights. Rows with fewer than ``min_words`` words are never
    drawn. A null text has no words; a null key hashes as an empty one and ranks first among equal scores; rows of equal
    key and score take neighbouring ranks. Further columns are not read. An empty table gives no rows, an empty target gains by the smoothing alone.
    """
    docs, target = docs.select(key, text), target.select(text)
    head = head_of(docs, text)
    gains = bucket_gains(written(bucket_totals(docs, head, text), "raw-buckets"), written(bucket_totals(target, head, text), "target-buckets"))
    table = np.zeros(BUCKETS, np.int64)
    for r in gains.collect():                       # one number for each bucket, whatever the corpus
        table[r["bucket"]] = r["gain"]
    noise = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256), 1, 8), 16, 10)
    gumbel = F.floor(-1000 * F.log(-F.log((noise.cast("double") + 0.5) / 4294967296.0))).cast("long")
    scored = written(weighed(docs, head, table, key, text).withColumn("score", F.col("weight") + gumbel), "weights")
    return drawn(scored, F.col("n_words") >= min_words, percent, key)


def sample(docs: DataFrame, ranks: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose key was drawn, as they are (rows that share a key come together, a null key never)."""
    return docs.join(ranks.where(F.col("rank").isNotNull()).select(key).distinct(), key, "left_semi")
