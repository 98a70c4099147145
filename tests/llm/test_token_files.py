import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from tokenizers import Tokenizer

from wikipassages.llm import packing, simple8b
from wikipassages.llm.word_ids import WordIds

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_word_ids_equal_library(library):
    r = random.Random(2)
    parts = ["a", "'s", "'S", " ", "\n", "é", "É", "12", "!", "'", "re", "\x0b", "²", "ª", "ß", "İ", "世", "́", "\xa0", "<|endoftext|>", "_", "\xad",
             "¿", "ĳ", "A", ".", ",", "×", "»", "?"]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(3000)] + [None, "", "Word. " * 20_000]
    for memory in (1_500_000, 50):
        codec = WordIds(PATH, memory)
        assert codec.per_word
        for lo in range(0, len(texts), 97):
            ids, offsets = codec.encode(pa.array(texts[lo:lo + 97], pa.string()))
            for text, a, b in zip(texts[lo:lo + 97], offsets, offsets[1:]):
                assert ids[a:b].tolist() == library(text), text


def test_simple8b_round_trips():
    r = np.random.default_rng(1)
    for n in (0, 1, 2, 60, 1023, 1024, 1025, 5000):
        for high in (1, 2, 60, 49_408, 2 ** 31, 2 ** 60, 2 ** 63):
            ids = r.integers(0, high, n, dtype=np.uint64)
            if high > 2 ** 60 and n > 3:
                ids[::3], ids[1] = np.uint64(2 ** 64 - 1), np.uint64(14 << 60)
            for block in (1, 7, 64, 1024):
                words, offsets = simple8b.pack(ids, block)
                assert (simple8b.unpack(words, offsets, n, block) == ids).all()


def test_simple8b_layout():
    """Three ids of 20 bits go into one word, the first lowest; an escape's id is the next word."""
    words, offsets = simple8b.pack(np.array([2 ** 19, 1, 2 ** 20 - 1, 2 ** 63], np.uint64))
    assert words.tolist() == [(11 << 60) | 2 ** 19 | 1 << 20 | (2 ** 20 - 1) << 40, 14 << 60, 2 ** 63] and offsets.tolist() == [0, 3]


def test_foreign_and_cut_files_raise():
    raw = simple8b.to_file(np.array([1]), np.array([False]), np.array([3]), np.array([1, 2, 3], np.uint32))
    assert simple8b.from_file(raw)[3].tolist() == [1, 2, 3]
    with pytest.raises(ValueError):
        simple8b.from_file(b"X" + raw[1:])
    with pytest.raises(ValueError):
        simple8b.from_file(raw[:-1])


ROWS = [(5, "The cat, sat."), (None, "no id"), (3, None), (9, ""), (5, "a second five"), (5, "a second five"), (1, "long text " * 3000), (7, "世界 x")]


def test_files_in_ascending_order(spark, tmp_path, library):
    df = spark.createDataFrame([(d, t, 1, "y") for d, t in ROWS], "doc_id long, text string, part int, name string").repartition(3)
    folder = f"file://{tmp_path}/tokens"
    manifest = simple8b.write_files(df, folder, PATH, 2, file_ids=50)
    out = sorted([tuple(r) for r in simple8b.read_files(spark, folder, manifest).collect()], key=lambda r: r[1])
    expected, at = [], 0
    for doc, text in sorted(ROWS, key=lambda r: (-1 if r[0] is None else r[0], r[1] or "")):
        ids = np.array(library(text) + [2], "<u4")
        expected.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert out == expected
    assert manifest.count() > 1 and manifest.agg({"ids": "sum"}).first()[0] == at


def test_lost_and_foreign_files_raise(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    folder = f"{tmp_path}/plain"                                   # without a scheme: the session's default store
    manifest = simple8b.write_files(df, folder, PATH, 2, file_ids=50)
    assert simple8b.read_files(spark, folder, manifest).count() == len(ROWS)
    names = [r["name"] for r in manifest.orderBy("part", "file").collect()]
    (tmp_path / "plain" / names[0]).rename(tmp_path / "aside")
    with pytest.raises(FileNotFoundError, match=names[0]):
        simple8b.read_files(spark, folder, manifest)
    other = spark.createDataFrame([(1, "short"), (2, "texts"), (3, "here"), (4, "and there")], "doc_id long, text string").coalesce(1)
    strange = simple8b.write_files(other, f"{tmp_path}/other", PATH, 2, file_ids=10_000).first()["name"]
    (tmp_path / "other" / strange).rename(tmp_path / "plain" / names[0])
    with pytest.raises(Exception, match="not the texts of the manifest"):
        simple8b.read_files(spark, folder, manifest).collect()


def test_no_texts_no_files(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    manifest = simple8b.write_files(df, f"{tmp_path}/none", PATH, 2)
    assert simple8b.read_files(spark, f"{tmp_path}/none", manifest).count() == 0


def best_fit(lengths, capacity):
    """Sequences that best-fit decreasing opens, one piece at a time."""
    gaps, opened = [], 0
    for length in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gap = min(fitting)
            gaps.remove(gap)
        else:
            gap, opened = capacity, opened + 1
        gaps.append(gap - length)
    return opened


@pytest.mark.parametrize("capacity", [10, 64, 2048])
def test_sweep_equals_one_by_one(capacity):
    r = random.Random(capacity)
    for _ in range(60):
        lengths = [r.randint(1, capacity if r.random() < 0.5 else max(1, capacity // 8)) for _ in range(r.randint(0, 200))]
        plan = packing.sweep({n: lengths.count(n) for n in set(lengths)}, capacity)
        sequences = {}
        for n in set(lengths):
            lines = [p for p in plan if p[0] == n]
            for rank in range(lengths.count(n)):
                line = [p for p in lines if p[1] <= rank][-1]
                i = rank - line[1]
                sequences.setdefault(line[3] + i // line[2], []).append((line[4] + i % line[2] * n, n))
        for places in sequences.values():
            at = 0
            for offset, n in sorted(places):
                assert offset == at
                at += n
            assert at <= capacity
        assert len(sequences) == best_fit(lengths, capacity)


def test_packing_of_texts(spark, library):
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    pieces = packing.cut_pieces(df, PATH, 0, 64).withColumnRenamed("doc", "doc_id")
    rows = packing.packed(pieces.selectExpr("*", "1 as before", "2 as offset"), 64, ["doc_id", "piece"]).collect()
    texts = sorted(library(t) + [0] for _, t in ROWS)
    lengths = [min(64, len(t) - i) for t in texts for i in range(0, len(t), 64)]
    assert sorted(r["length"] for r in rows) == sorted(lengths)
    sequences = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"] and r["start"] == 64 * r["piece"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= 64
    assert len(sequences) == best_fit(lengths, 64)
    assert packing.packed(pieces.limit(0), 64, ["doc_id"]).count() == 0


def test_bad_lengths_raise(spark):
    for bad in ("5000L", "0L", "CAST(NULL AS BIGINT)"):
        with pytest.raises(Exception):
            packing.packed(spark.sql(f"SELECT 1L AS doc_id, {bad} AS length"), 64, ["doc_id"]).collect()
