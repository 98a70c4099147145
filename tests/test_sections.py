"""T1 against a recursive reference on random texts; T2/T4 pinned; the dump example end to end."""

import random
import re

from pyspark.sql import functions as F

from wikipassages.operators import sections as S
from wikipassages.plans.primary import run_primary, run_primary_records
from wikipassages.sources import dump

LEVELS = [re.compile(r"(?<!=)={%d}\s*([^=]+)\s*={%d}(?!=)" % (n, n), re.ASCII) for n in (2, 3, 4, 5, 6)]


def recursive_sections(text, level=0):
    """Plain recursive split: a level is searched only inside the level above."""
    if level >= len(LEVELS):
        return []
    out, found = [], list(LEVELS[level].finditer(text))
    for k, m in enumerate(found):
        body = text[m.end():found[k + 1].start() if k + 1 < len(found) else len(text)]
        out += recursive_sections(body, level + 1) + [(m.group(0), body)]
    return out


def random_text(rng):
    pieces = ["=", "==", "===", "====", "=====", "======", " ", "a", "bc", "\n", "x y", "\t"]
    return "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60)))


def test_nested_sections_match_recursive_version(spark):
    rng = random.Random(7)
    texts = [random_text(rng) for _ in range(400)] + ["no headings", "== A ==\n==== deep ====\nx"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = {}
    for r in S.nested_sections(df).collect():
        got.setdefault(r["id"], []).append((r["heading"], r["sec_text"]))
    for i, t in enumerate(texts):
        assert sorted(got.get(i, [])) == sorted(recursive_sections(t)), repr(t)


def test_deeper_level_directly_under_level_two_is_not_found(spark):
    df = spark.createDataFrame([(1, "lead == A == x ==== D ==== y")], "id int, text string")
    rows = S.nested_sections(df).collect()
    assert [(r["heading"], r["sec_text"]) for r in rows] == [("== A ==", " x ==== D ==== y")]


def staged_sections(pages):
    """The split level by level, each inside the bodies of the level above: one regex pass for each level."""
    def split(piece, pattern):
        hits = F.regexp_extract_all(piece, F.lit(pattern), 0)
        return F.zip_with(hits, F.slice(F.split(piece, pattern, -1), 2, F.size(hits)), lambda h, b: F.struct(h.alias("h"), b.alias("b")))
    patterns = {n: r"(?<!=)={%d}\s*([^=]+)\s*={%d}(?!=)" % (n, n) for n in range(2, 7)}
    df = pages.withColumn("l2", split(F.col("text"), patterns[2]))
    for n in range(3, 7):
        df = df.withColumn(f"l{n}", F.flatten(F.transform(f"l{n - 1}", lambda s: split(s["b"], patterns[n]))))
    return df.select("id", F.posexplode(F.concat(*[f"l{n}" for n in range(2, 7)])).alias("i", "s")).select("id", "i", "s.h", "s.b")


def test_one_scan_equals_the_staged_split(spark):
    rng = random.Random(11)
    marks = ["=" * n for n in (1, 2, 2, 3, 3, 4, 5, 6, 7)]
    texts = ["".join(rng.choice(["x", " ", "\n", "žš", "𝒳"]) + (m := rng.choice(marks)) + rng.choice(["t", " ", "u\n"]) + rng.choice([m, m, m, "=="])
                     for _ in range(rng.randint(0, 25))) for _ in range(500)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(-1, None), (-2, "")], "id int, text string")
    got = {tuple(r) for r in S.nested_sections(df).select("id", "sec_ord", "heading", "sec_text").collect()}
    assert got == {tuple(r) for r in staged_sections(df).collect()}
    assert len({h.count("=") for _, _, h, _ in got}) == 5


def test_many_headings_on_one_page(spark):
    text = "".join("=" * (2 + i % 3) + f" h{i} " + "=" * (2 + i % 3) + "body\n" for i in range(6000))
    rows = S.nested_sections(spark.createDataFrame([(1, text)], "id int, text string")).collect()
    assert sorted((r["heading"], r["sec_text"]) for r in rows) == sorted(recursive_sections(text)) and len(rows) == 6000


def test_no_headings_no_sections(spark):
    df = spark.createDataFrame([(1, "just text = not a heading")], "id int, text string")
    assert S.nested_sections(df).count() == 0


def test_flat_sections_eat_one_char_and_pass_pages_through(spark):
    df = spark.createDataFrame([("P", "P", "lead x== A ==body a == B==body b"), ("Q", "Q", "plain")],
                               "key string, title string, text string")
    rows = sorted((r["key"], r["text"]) for r in S.flat_sections(df).collect())
    assert rows == [("P#A", "body a"), ("P#B", "body b"), ("Q", "plain")]


def test_flat_section_at_text_start_keeps_its_name(spark):
    df = spark.createDataFrame([("P", "P", "== A ==x")], "key string, title string, text string")
    assert [(r["key"], r["text"]) for r in S.flat_sections(df).collect()] == [("P#A", "x")]


def test_explode_redirect_targets(spark):
    df = spark.createDataFrame([("R", "R", "#REDIRECT [[P#S]]"), ("P#S", "P#S", "text")],
                               "key string, title string, text string")
    rows = sorted((r["key"], r["title"]) for r in S.explode_redirect_targets(df).collect())
    assert rows == [("P#S", "P#S"), ("P#S", "R")]


DUMP = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/">
  <siteinfo><sitename>Test</sitename></siteinfo>
  <page>
    <title>AT&amp;T</title>
    <revision><model>wikitext</model><text xml:space="preserve">lead == A ==
body a
=== A1 ===
body a1
==== A11 ====
deep
== B ==
body b</text></revision>
  </page>
  <page>
    <title>R</title>
    <redirect title="AT&amp;T" />
    <revision><model>wikitext</model><text xml:space="preserve">#REDIRECT [[AT&amp;T#A1]]</text></revision>
  </page>
  <page>
    <title>Style</title>
    <revision><model>css</model><text>== A1 ==
css</text></revision>
  </page>
  <page>
    <title>Broken</title><revision><text>unclosed
  </page>
</mediawiki>
"""


def test_dump_example_end_to_end(spark, tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(DUMP, encoding="utf-8")
    pages = dump.read_dump(spark, str(path))
    assert pages.count() == 3
    rows = run_primary(pages).redirected.collect()
    assert [(r["key"], r["page"], r["section"], r["n"], r["text"]) for r in rows] == [
        ("at&t#a1", "at&t", "a1", 1, " body a1 ==== A11 ==== deep ")]


def test_dump_bz2_and_corrupt_records(spark, tmp_path):
    import bz2
    path = tmp_path / "dump.xml.bz2"
    path.write_bytes(bz2.compress(DUMP.encode("utf-8")))
    records = dump.read_dump_records(spark, str(path))
    parsed = dump.parse_pages(records, keep_corrupt=True)
    assert dump.corrupt_pages(parsed).count() == 1
    rows = run_primary_records(records).redirected.collect()
    assert [(r["key"], r["n"]) for r in rows] == [("at&t#a1", 1)]


def test_xml_reader_path_gives_same_pages(spark, tmp_path):
    path = tmp_path / "dump.xml"
    path.write_text(DUMP.replace("""  <page>
    <title>Broken</title><revision><text>unclosed
  </page>
""", ""), encoding="utf-8")
    a = sorted(tuple(r) for r in dump.read_dump(spark, str(path)).collect())
    b = sorted(tuple(r) for r in dump.read_dump_xml_reader(spark, str(path)).collect())
    assert a == b


def test_revisions_become_rows(spark):
    xml = ("<page><title>T</title><revision><model>wikitext</model><text>one</text></revision>"
           "<revision><model>wikitext</model><text>two</text></revision></page>")
    df = spark.createDataFrame([(xml,)], "xml string")
    assert sorted(r["text"] for r in dump.parse_page_revisions(df).collect()) == ["one", "two"]
