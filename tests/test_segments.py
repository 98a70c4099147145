"""Loads add up, a load that dies leaves the index as it was, a repeated one counts once."""

import pytest

from wikipassages.operators import index as I, search as Q, segments as S


def _sections(spark, *rows):
    return spark.createDataFrame([(f"{p}#{s}", p, s, 1, t) for p, s, t in rows], "key string, page string, section string, n int, text string")


@pytest.fixture(scope="module")
def parts(spark):
    first = _sections(spark, ("p", "a", "the cat sat on the mat"), ("p", "b", "cats and dogs"))
    second = _sections(spark, ("q", "c", "dog sat, cat ran, cat slept"), ("q", "d", "of the"))
    titles = spark.createDataFrame([("p#a", "Feline page"), ("q#c", "Hound page")], "key string, redirect string")
    return first, second, titles


def _rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def _answers(spark, index):
    q = Q.query_terms(spark.createDataFrame([(1, "cat sat"), (2, "dog mat cats")], "query_id int, text string"))
    t = Q.query_terms(spark.createDataFrame([(1, "hound page")], "query_id int, text string"), field="redirsFrom")
    phrases = Q.phrase_terms(spark.createDataFrame([(1, "hound page")], "query_id int, text string"), field="redirsFrom")
    return [_rows(Q.rank_hits(s)) for s in (Q.tfidf_scores(index, q), Q.bm25_scores(index, q), Q.tfidf_scores(index, t))] + [
        _rows(Q.phrase_matches(index, phrases)), _rows(index.term_stats)]


def test_loads_equal_one_index(spark, parts, tmp_path):
    first, second, titles = parts
    path = str(tmp_path / "index")
    assert S.add_load(I.build_index(first, titles), path, "one") == 1
    assert S.add_load(I.build_index(second, titles), path, "two") == 2
    whole = I.build_index(first.union(second), titles)
    assert _answers(spark, S.read_segments(spark, path)) == _answers(spark, whole)
    assert S.loads(spark, path) == ["one", "two"]
    # an append reads no older posting: those of the first load are not in the plan of the second
    assert S.add_load(I.build_index(second, titles), path, "two") == 2      # run again: counts once
    again = S.add_load(I.build_index(first, titles, load="3"), path)       # without a name: adds
    assert again == 3 and S.read_segments(spark, path).docs.count() == whole.docs.count() + 2
    assert S.add_load(I.build_index(second, titles), path, "new", "overwrite") == 4
    assert _answers(spark, S.read_segments(spark, path)) == _answers(spark, I.build_index(second, titles))
    assert S.drop_unused(spark, path) == 3


def test_a_load_that_dies_is_invisible(spark, parts, tmp_path, monkeypatch):
    first, second, titles = parts
    path = str(tmp_path / "index")
    with pytest.raises(ValueError, match="no load"):
        S.read_segments(spark, path)
    S.add_load(I.build_index(first, titles), path, "one")
    before = _answers(spark, S.read_segments(spark, path))
    # inside the segment: the postings cannot be written
    broken = I.build_index(second, titles)
    broken.postings = broken.postings.withColumn("tf", I.F.raise_error(I.F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        S.add_load(broken, path, "two")
    assert _answers(spark, S.read_segments(spark, path)) == before
    # after the segment, before the commit
    monkeypatch.setattr(S, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        S.add_load(I.build_index(second, titles), path, "two")
    monkeypatch.undo()
    assert _answers(spark, S.read_segments(spark, path)) == before
    S.add_load(I.build_index(second, titles), path, "two")
    assert _answers(spark, S.read_segments(spark, path)) == _answers(spark, I.build_index(first.union(second), titles))
    assert S.drop_unused(spark, path) == 2


def test_two_loads_at_once(spark, parts, tmp_path, monkeypatch):
    first, second, titles = parts
    path = str(tmp_path / "index")
    names = [S.write_segment(I.build_index(p, titles), path) for p in (first, second)]
    plain, met = S._Folder.create, []

    def beaten(self, name, text):
        if not met:                      # the other load commits between the reading of the manifest and the rename
            met.append(name)
            plain(self, name, f"{names[0]}\tone\n")
        return plain(self, name, text)
    monkeypatch.setattr(S._Folder, "create", beaten)
    assert S.commit(spark, path, names[1], "two") == 2
    assert S.loads(spark, path) == ["one", "two"]


def test_empty_load(spark, parts, tmp_path):
    first, _, titles = parts
    path = str(tmp_path / "index")
    S.add_load(I.build_index(first.limit(0)), path, "none")
    assert S.read_segments(spark, path).docs.count() == 0
    S.add_load(I.build_index(first, titles), path, "one")
    assert _answers(spark, S.read_segments(spark, path)) == _answers(spark, I.build_index(first, titles))
