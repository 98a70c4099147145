"""Paging by cursor against rank ranges; count files under their inputs' names."""

import pytest

from wikipassages.operators import search as Q
from wikipassages.sources import lines as L


def test_pages_by_cursor(spark):
    rows = [(q, f"d{i:02d}", round(1.0 / (1 + i // 3), 3)) for q, n in ((1, 23), (2, 10), (3, 4)) for i in range(n)]
    scores = spark.createDataFrame(rows, "query_id int, doc_id string, score double").repartition(3)
    cursor, seen = Q.cursor_after(Q.rank_hits(scores, 1, 0)), []
    for page in range(1, 5):
        got = Q.page_after(scores, cursor)
        want = {(r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in Q.page_of_hits(scores, page).collect()}
        rows = got.collect()
        assert {(r["query_id"], r["rank"], r["doc_id"], r["score"]) for r in rows} == want
        for r in rows:
            total = {1: 23, 2: 10, 3: 4}[r["query_id"]]
            assert r["hits_on_page"] == min(10, total - 10 * (page - 1)) and r["more"] == (total > 10 * page)
        seen += rows
        cursor = spark.createDataFrame(Q.cursor_after(got).union(cursor).groupBy("query_id").agg(
            Q.F.max(Q.F.struct("last_rank", "last_score", "last_doc")).alias("c")).select("query_id", "c.*").collect(),
            "query_id int, last_rank int, last_score double, last_doc string")
    assert len(seen) == 37


def test_next_page_scores_once(spark):
    """Both pages come from one pass over the scores; ties, short and empty second pages as by rank ranges."""
    rows = [(q, f"d{i:02d}", round(1.0 / (1 + i // 4), 7)) for q, n in ((1, 25), (2, 10), (3, 4), (4, 20), (5, 21)) for i in range(n)]
    passed = spark.sparkContext.accumulator(0)

    def seen(score):
        passed.add(1)
        return score

    scores = spark.createDataFrame(rows, "query_id int, doc_id string, score double").repartition(3)
    counted = scores.withColumn("score", Q.F.udf(seen, "double").asNondeterministic()("score"))
    got = Q.next_page(counted).collect()
    assert passed.value == len(rows)
    want = Q.page_after(scores, Q.cursor_after(Q.rank_hits(scores))).collect()
    assert sorted(got) == sorted(want) and {r["query_id"]: r["more"] for r in got} == {1: True, 4: False, 5: True}


def test_count_files(spark, tmp_path):
    rows = [("en part-0", 1, 5), ("en part-0", 3, 1), ("sk.txt", 2, 7)]
    counts = spark.createDataFrame(rows, "source_file string, redirs_count int, freq long")
    folder = str(tmp_path / "out")
    assert L.write_count_files(counts, folder) == ["en part-0redirsCount.txt", "sk.txtredirsCount.txt"]
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if not p.name.startswith(".")) == ["en part-0redirsCount.txt", "sk.txtredirsCount.txt"]
    assert (tmp_path / "out" / "en part-0redirsCount.txt").read_text() == "1\t5\n3\t1\n"
    got = {(r["file"], r["redirs_count"], r["freq"]) for r in L.read_count_files(spark, folder).collect()}
    assert got == {(f"{s}redirsCount.txt", c, f) for s, c, f in rows}
    with pytest.raises(FileExistsError):
        L.write_count_files(counts, folder)
