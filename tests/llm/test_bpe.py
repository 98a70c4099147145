import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from wikipassages.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
PARTS = ["a", "b", " ", "  ", "\n", "'", "s", "'re", "'ll", "1", "22", "é", "ß", "世界", "!", "...", "e", "th", "the", "́", "\t", "T", "🙂", " '"]


@pytest.mark.parametrize("leaf_chars,leaf_bytes", [(3, 3), (37, 16), (4096, 512)])
def test_tree_encoding_equals_library(leaf_chars, leaf_bytes):
    codec = bpe.TreeCodec(PATH, PATTERN, leaf_chars, leaf_bytes)
    r = random.Random(leaf_chars)
    texts = ["".join(r.choice(PARTS) for _ in range(r.randint(0, 60))) for _ in range(600)]
    texts += ["".join(r.choice("abehtr") for _ in range(1500)) for _ in range(10)] + [" " * 50, "'" * 40, "x" * 5000, "\n" * 9 + "a"]
    for text in texts:
        ids = codec.encode(text)
        assert ids == codec.core.encode_ordinary(text), text
        assert codec.decode(ids) == text.encode()


def test_columns_handle_nulls_long_texts_and_own_names(spark):
    long = "word and " * 60_000 + "y" * 30_000
    rows = [(1, None, 5), (2, "", 5), (2, "", 5), (3, long, 5), (4, "Don't  stop", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    out = bpe.encoded(df, PATH, PATTERN).withColumn("raw", bpe.decode(F.col("ids"), PATH, PATTERN)).collect()
    assert len(out) == 5
    codec = bpe.TreeCodec(PATH, PATTERN)
    for row in out:
        assert row["ids"] == codec.core.encode_ordinary(row["text"] or "")
        assert bytes(row["raw"]) == (row["text"] or "").encode()
    assert bpe.encoded(df.limit(0), PATH, PATTERN).count() == 0


def test_unknown_id_raises(spark):
    df = spark.createDataFrame([([1, 60_000],)], "ids array<int>")
    with pytest.raises(Exception, match="no such token id"):
        df.select(bpe.decode(F.col("ids"), PATH, PATTERN)).collect()
