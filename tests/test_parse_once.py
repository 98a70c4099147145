"""Each record's XML is parsed once in a plan, whatever is filtered afterwards."""

import pytest

from wikipassages.operators import links
from wikipassages.operators import redirects as R
from wikipassages.plans import staged
from wikipassages.sources import dump

RECORDS = [
    "<page><title>A</title><revision><model>wikitext</model><text>lead\n== S ==\nx</text></revision></page>",
    '<page><title>R</title><redirect title="A" /><revision><model>wikitext</model><text>#REDIRECT [[A#S]]</text></revision></page>',
    "<page><title>Two</title><revision><model>wikitext</model><text>one</text></revision><revision><model>wikitext</model><text>two</text></revision></page>",
    '<page><title>Bare</title><redirect/><revision><model>wikitext</model><text/></revision></page>',
    "<page><title>Broken</title><revision><text>no end</revision></page>",
]


@pytest.fixture
def records(spark):
    return spark.createDataFrame([(r,) for r in RECORDS], "xml string").repartition(2)


def _parses(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("from_xml(")


def test_one_parse_in_each_branch(records):
    pages = dump.parse_pages(records)
    assert _parses(pages) == 1
    assert _parses(R.section_redirects(R.wikitext_pages(pages))) == 1
    assert _parses(R.section_texts(R.wikitext_pages(pages))) == 1
    assert _parses(links.linking_pages(pages)) == 1
    assert _parses(staged.merged_sections(staged.page_records(dump.parse_page_revisions(records)))) == 1
    assert _parses(dump.dead_letters(records)) == 1


def test_first_revision_empty_text_and_bare_redirect(records):
    pages = {r["title"]: r for r in dump.parse_pages(records).collect()}
    assert pages["Two"]["text"] == "one"
    assert [r["text"] for r in dump.parse_page_revisions(records).where("title = 'Two'").collect()] == ["one", "two"]
    assert pages["Bare"]["redirect"] == "" and pages["Bare"]["text"] is None
    assert pages["A"]["redirect"] is None and "Broken" not in pages


def test_pages_without_text_neither_link_nor_are_linked(records):
    pages = dump.parse_pages(records)
    assert {r["title"] for r in links.linking_pages(pages).collect()} == {"R"}


def test_dead_letters_keep_the_record(records):
    assert [r["record"] for r in dump.dead_letters(records).collect()] == [RECORDS[-1]]


def test_storage_folder(spark, tmp_path, monkeypatch):
    from wikipassages import session

    class Context:
        def __init__(self, master, current=None):
            self.master, self.current = master, current

        def getCheckpointDir(self):
            return self.current

        def setCheckpointDir(self, folder):
            self.current = folder

    class Session:
        def __init__(self, context, setting=None):
            self.sparkContext, self.setting = context, setting
            self.conf = self

        def get(self, key, default=None):
            return self.setting or default

    assert session.ensure_checkpoint_dir(Session(Context("yarn", "hdfs://a/b"))) == "hdfs://a/b"
    assert session.ensure_checkpoint_dir(Session(Context("yarn"), "hdfs://s")) == "hdfs://s"
    assert session.ensure_checkpoint_dir(Session(Context("yarn", "hdfs://s/1-2-3"), "hdfs://s")) == "hdfs://s"
    for master in ("yarn", "spark://h:7077", "local-cluster[2,1,1024]", "k8s://h"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            session.ensure_checkpoint_dir(Session(Context(master)))
    assert session.ensure_checkpoint_dir(Session(Context("local[4]")))


def test_written_stages_can_be_dropped(spark):
    import os

    from wikipassages import session
    session.materialize(spark, "to-drop", lambda: spark.range(3)).count()
    path = session._MATERIALIZED[(spark.sparkContext.applicationId, "to-drop")]
    kept = dict(session._MATERIALIZED)
    session._MATERIALIZED.clear()
    session._MATERIALIZED[(spark.sparkContext.applicationId, "to-drop")] = path
    assert session.drop_materialized(spark) == 1 and not os.path.exists(path.removeprefix("file:"))
    session._MATERIALIZED.update({k: v for k, v in kept.items() if k[1] != "to-drop"})
