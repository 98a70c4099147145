"""The registered queries over the smallest whole tables: columns, rows and, where no SQL twin exists, brute force."""

import hashlib
import json
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from wikipassages.llm import bpe, oracle, queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_byte_bpe": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op2_url_rules": "page_id bigint, host string, path string, rule string, verdict string, mined_rule string",
    "op3_embedding_copies": "vec_id bigint, n_links bigint, component_id bigint, kept boolean",
    "op4_quality_rules": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
                         "base_failed boolean, kept boolean",
    "op5_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_passages": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op7_near_copies": "doc_id bigint, n_shingles bigint, component_id bigint, kept boolean",
    "op8_best_fit": "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint",
    "op9_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op10_class_lm": "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double",
    "op11_personal_data": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint",
    "op12_filter_audit": "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, unique_fails bigint, "
                         "good_lost bigint, toxic_lost bigint, shapley bigint",
    "op13_importance_resampling": "doc_id bigint, n_features bigint, weight bigint, score bigint, rank bigint",
}


def test_names():
    assert set(queries.QUERIES) == set(COLUMNS)
    assert set(oracle.ORACLE) <= set(COLUMNS)


@pytest.fixture(scope="module")
def results(spark):
    held = {}

    def of(name):
        if name not in held:
            df = queries.QUERIES[name](spark, SF)
            assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == COLUMNS[name]
            held[name] = df.collect()
        return held[name]
    return of


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def test_op1_equals_library(results, texts):
    codec = bpe.TreeCodec(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    rows = results("op1_byte_bpe")
    assert len(rows) == len(texts)
    for r in rows:
        ids = codec.core.encode_ordinary(texts[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_op8_and_op9_equal_library(results, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    ids = {d: library.encode(t, add_special_tokens=False).ids for d, t in texts.items()}
    files, at = {r["doc_id"]: r for r in results("op9_token_files")}, 0
    assert len(files) == len(texts)
    for doc in sorted(ids):
        raw = np.array(ids[doc] + [2], "<u4")
        assert tuple(files[doc])[1:] == (at, len(raw), zlib.crc32(raw.tobytes()))
        at += len(raw)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in results("op8_best_fit"):
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for doc, tokens in ids.items():
        raw = np.array(tokens + [0], "<u4")
        cut = [raw[i:i + 2048] for i in range(0, len(raw), 2048)]
        got = sorted(pieces[doc], key=lambda r: r["piece"])
        assert [(r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got] == \
            [(k, 2048 * k, len(c), zlib.crc32(c.tobytes())) for k, c in enumerate(cut)]
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 2048
    assert len(sequences) <= 1.02 * (sum(len(t) + 1 for t in ids.values()) / 2048) + 1


def test_op11_holds_the_plain_patterns(results, texts):
    from wikipassages.llm import pii
    from test_pii import plain_base
    rows = {r["doc_id"]: r for r in results("op11_personal_data")}
    assert rows.keys() == texts.keys()
    for doc, text in texts.items():
        base = [f"{pii.KINDS[kind]}:{start}:{end}" for start, kind, end in plain_base(text)]
        assert rows[doc]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        every = rows[doc]["spans"].split(",") if rows[doc]["spans"] else []
        assert set(base) <= set(every) and len(every) == len(base) + rows[doc]["n_added"]
        assert [rows[doc][f"n_{k}"] for k in pii.KINDS] == [sum(b.startswith(k) for b in base) for k in pii.KINDS]


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_sql_twins(results, name):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "labels", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cursor = con.execute(oracle.ORACLE[name])
    columns = [c[0] for c in cursor.description]
    expected = sorted(json.dumps(dict(zip(columns, row)), sort_keys=True) for row in cursor.fetchall())
    assert sorted(json.dumps(r.asDict(), sort_keys=True) for r in results(name)) == expected


@pytest.mark.parametrize("name", ["op2_url_rules", "op5_toxicity", "op10_class_lm"])
def test_whole_tables(results, spark, name):
    table = {"op2_url_rules": "pages"}.get(name, "documents")
    assert len(results(name)) == spark.read.parquet(f"{SF}/{table}.parquet").count()
