import random

import pytest

import corpus_pipeline
from wikipassages.llm import stages


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """Clean documents, exact and near copies, a passage in many documents, junk, toxic texts, nulls."""
    r = random.Random(12)
    words = ["".join(r.choice("aeioudbglmnrst") for _ in range(r.randint(2, 9))) for _ in range(3000)]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows, labels, kinds = [], [], {}

    def add(kind, body, quality=None, toxic=0):
        doc = len(rows)
        rows.append((doc, body, "en", f"s{doc % 3}", None if body is None else len(body), "extra"))
        kinds.setdefault(kind, []).append(doc)
        if quality is not None:
            labels.append((doc, quality, toxic))

    for i in range(700):
        add("clean", text(r.randint(80, 160)), 1 if i % 2 else None)
    for i in range(250):
        body = text(100).split()
        for _ in range(8):
            body[r.randrange(100)] = r.choice(["zkraffer", "qvolling"])
        add("toxic", " ".join(body), 1 if i % 2 else None, 1)
    for doc in range(20):
        add("copy", rows[doc][1])
    for doc in range(20, 40):
        near = rows[doc][1].split()
        near[len(near) // 2] = "changedword"
        add("near", " ".join(near))
    passage = text(60)
    for _ in range(10):
        add("passage", text(60) + " " + passage + " " + text(60))
    add("short", "a b c")
    add("empty", "")
    add("null", None)
    add("repeats", "one two three " * 60)
    path = tmp_path_factory.mktemp("corpus")
    names = "doc_id long, text string, lang string, source string, n_chars long, __doc string"
    spark.createDataFrame(rows, names).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), {r[0]: r for r in rows}, kinds, passage


def test_stages_on_planted_cases(spark, corpus):
    path, rows, kinds, passage = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet")
    results = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, path)
        if name != "best_fit":
            assert out.columns == docs.columns
        results.append({r["doc_id"]: r for r in out.collect()})
        docs = spark.createDataFrame(list(results[-1].values()), out.schema) if name != "best_fit" else docs
    toxic, quality, near, cut, _ = results
    assert len(set(kinds["toxic"]) & set(toxic)) <= 5
    assert len(set(kinds["clean"]) - set(toxic)) <= 5
    assert set(toxic) >= set(kinds["passage"] + kinds["short"] + kinds["null"])
    assert not set(kinds["short"] + kinds["empty"] + kinds["null"] + kinds["repeats"]) & set(quality)
    assert set(quality) == set(toxic) - set(kinds["short"] + kinds["empty"] + kinds["null"] + kinds["repeats"])
    assert set(near) == set(quality) - set(kinds["copy"]) - set(kinds["near"])
    holders = sorted(set(kinds["passage"]) & set(near))
    assert passage in cut[holders[0]]["text"]
    for doc in holders[1:]:
        assert passage not in cut[doc]["text"] and len(cut[doc]["text"].split()) == 120 and cut[doc]["n_chars"] == len(cut[doc]["text"])
    for doc in set(kinds["clean"]) & set(near):
        assert cut[doc] == near[doc]


def test_run_packs_what_the_stages_keep(spark, corpus):
    out = corpus_pipeline.run(spark, corpus[0])
    assert set(out.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    places = {}
    for r in out.collect():
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        at = 0
        for offset, n in sorted(p):
            assert offset == at
            at += n
        assert at <= stages.CAPACITY


def test_empty_documents(spark, corpus, tmp_path):
    docs = spark.read.parquet(f"{corpus[0]}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{corpus[0]}/labels.parquet").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_keep_different_texts_of_one_id(spark):
    r = random.Random(2)
    text = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(60))
    a, b, c = text(), text(), text()
    docs = spark.createDataFrame([(1, a), (1, b), (1, a), (2, c), (3, c + " end")], "doc_id long, text string")
    kept = sorted((x["doc_id"], x["text"]) for x in stages.drop_near_copies(spark, docs, "").collect())
    assert kept == sorted([(1, a), (1, b), (2, c)])
