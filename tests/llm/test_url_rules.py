import math
import random
import re
from itertools import combinations

from pyspark.sql import functions as F

from wikipassages.llm import url_rules
from wikipassages.llm.queries import URL_RULES

ROWS = [(i, f"http://spam{i % 3}.bad.org/buy/{i}?ref=x", True) for i in range(30)] \
    + [(i, f"HTTP://ok{i % 3}.good.org/read/{i}#top", False) for i in range(30, 90)] \
    + [(91, "http://spam1.bad.org/read/1", False), (92, None, True), (93, "", None), (94, "no-scheme/x", False)]


def _tokens(url):
    url = url or ""
    m = re.match(r"(?s)^(.*?)://([^/?#]*)([^?#]*)", url)
    scheme, host, path = m.groups() if m else ("", "", "")
    out = ["s=" + scheme.lower()] if scheme else []
    out += ["h=" + x for x in re.sub("[A-Z]", lambda c: c[0].lower(), host).split(".") if x]
    out += ["p=" + x for x in re.split(r"[/.]", path.lower()) if x]
    out += ["q=" + x for x in re.findall(r"[?&]([^=&#?]+)", url.lower()) if x]
    f = re.search(r"(?s)#(.*)$", url.lower())
    return set(out + (["f=" + f[1]] if f and f[1] else []))


def _mined_by_force(rows, min_support, min_confidence):
    """All token sets with the support and confidence asked for, from every subset of every url."""
    baskets = [(_tokens(u), bad) for _, u, bad in rows if bad is not None and _tokens(u)]
    count = {}
    for tokens, bad in baskets:
        for k in range(1, len(tokens) + 1):
            for s in combinations(sorted(tokens), k):
                n, b = count.get(s, (0, 0))
                count[s] = (n + 1, b + bad)
    least = min_support * len(baskets)
    return [set(s) for s, (n, b) in count.items() if b >= least and b / n >= min_confidence]


def test_verdicts_equal_all_subsets(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, bad boolean")
    rules = url_rules.mine(df, "url", "bad", 0.1, 0.9)
    assert rules.count() > 0
    forced = _mined_by_force(ROWS, 0.1, 0.9)
    new = ROWS + [(100, "http://spam0.bad.org/other", None), (101, "http://x.org/buy/1", None), (101, "http://x.org/buy/1", None)]
    pages = spark.createDataFrame([(i, u, "clash") for i, u, _ in new], "page_id long, url string, mined string")
    out = url_rules.judged(pages, "url", [], rules).collect()
    assert len(out) == len(new)
    for row in out:
        expected = "block" if any(s <= _tokens(row["url"]) for s in forced) else "allow"
        assert row["verdict"] == expected, row
        assert row["mined"] == "clash"


def test_given_rules(spark):
    cases = {
        "https://a.com/": ("com/", "allow"), "http://example.com/en/1": ("example.com/en/", "block"), "http://b.EXAMPLE.com/en/": ("example.com/en/", "block"),
        "http://www.example.com/en/x": ("www.example.com/en/", "allow"), "http://m.www.example.com/en/x": ("www.example.com/en/", "allow"),
        "http://x.net/es/1": ("net/es/", "block"), "http://x.net/fr/": ("net/fr/", "block"), "http://x.net/de/": (None, "allow"),
        "http://notexample.com/en/": ("com/", "allow"), "http://a.com?x=/": (None, "allow"), "a.com/": (None, "allow"), "": (None, "allow")}
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(cases)] + [(99, None)], "page_id long, url string")
    none = spark.createDataFrame([], "antecedent array<string>, posted string, confidence double, support double")
    out = {r["url"]: r for r in url_rules.judged(pages, "url", URL_RULES, none).collect()}
    for url, (rule, verdict) in cases.items():
        assert (out[url]["rule"], out[url]["verdict"]) == (rule, verdict), url
    assert (out[None]["host"], out[None]["path"], out[None]["verdict"]) == ("", "", "allow")
    assert out["http://b.EXAMPLE.com/en/"]["host"] == "b.example.com" and out["http://a.com?x=/"]["path"] == ""


def test_empty_tables_and_no_unwanted_rows(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, bad boolean")
    empty = url_rules.mine(df.limit(0), "url", "bad", 0.1, 0.9)
    assert empty.count() == 0
    assert url_rules.judged(df.select("page_id", "url").limit(0), "url", URL_RULES, empty).count() == 0
    assert url_rules.mine(df.withColumn("bad", F.lit(False)), "url", "bad", 0.1, 0.9).count() == 0


def test_copies_of_a_long_url_are_one_item(spark):
    url = "http://h.org/" + "/".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(i, url, True) for i in range(50)] + [(i, f"http://h.org/{i}", False) for i in range(50)], "page_id long, url string, bad boolean")
    rules = url_rules.mine(df, "url", "bad", 0.1, 0.9)
    assert rules.count() == 1


def test_no_python_in_the_plans(spark):
    df = spark.createDataFrame(ROWS, "page_id long, url string, bad boolean")
    rules = url_rules.mine(df, "url", "bad", 0.1, 0.9)
    plan = url_rules.judged(df, "url", URL_RULES, rules)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|MapInArrow|ArrowEval", plan)


def _proven_by_force(rules, rows, level):
    """Antecedents borne out by the rows, each distinct url with the mean of its labels."""
    labels = {}
    for _, url, bad in rows:
        if url is not None and bad is not None and _tokens(url):
            labels.setdefault(url, []).append(bad)
    share = {u: sum(b) / len(b) for u, b in labels.items()}
    usual = sum(share.values()) / len(share)
    out = set()
    for rule in rules:
        of = [s for u, s in share.items() if set(rule) <= _tokens(u)]
        if of and sum(of) / len(of) - math.sqrt(math.log(len(rules) / level) / (2 * len(of))) > usual:
            out.add(rule)
    return out


def test_only_rules_that_other_labels_bear_out_stay(spark):
    rng = random.Random(5)

    def rows(first, n):
        out = []
        for i in range(first, first + n):
            spam = rng.random() < 0.3
            words = "/".join(rng.choice("abcdefghij") + str(rng.randint(0, 9)) for _ in range(3))
            out.append((i, f"http://host{i % 7}.org/{'buy/' if spam else ''}{words}", rng.random() < (0.95 if spam else 0.3)))
        return out
    mined_from, others = rows(0, 400), rows(1000, 400) + [(5000, None, True), (5001, "", True), (5002, "http://x.org/a0", None)]
    others += others[:30]                                                   # repeated urls count once
    schema = "page_id long, url string, bad boolean"
    rules = url_rules.mine(spark.createDataFrame(mined_from, schema), "url", "bad", 0.005, 0.6)
    before = {tuple(r["antecedent"]) for r in rules.collect()}
    after = url_rules.proven(rules, spark.createDataFrame(others, schema), "url", "bad", 0.05)
    kept = {tuple(r["antecedent"]) for r in after.collect()}
    assert kept == _proven_by_force(before, others, 0.05)
    assert after.columns == rules.columns and ("p=buy",) in kept and len(kept) < len(before) / 2
    nothing = spark.createDataFrame([(1, None, True), (2, "http://x.org/", None)], schema)
    assert url_rules.proven(rules, nothing, "url", "bad", 0.05).count() == 0
    assert url_rules.proven(rules.limit(0), spark.createDataFrame(others, schema), "url", "bad", 0.05).count() == 0


def test_rules_by_chance_go(spark):
    rng = random.Random(6)
    rows = [(i, f"http://h{rng.randint(0, 40)}.org/p{rng.randint(0, 40)}?q{rng.randint(0, 9)}=1", rng.random() < 0.4) for i in range(900)]
    schema = "page_id long, url string, bad boolean"
    rules = url_rules.mine(spark.createDataFrame(rows[:600], schema), "url", "bad", 0.002, 0.6)
    assert rules.count() > 50
    assert url_rules.proven(rules, spark.createDataFrame(rows[600:], schema), "url", "bad", 0.05).count() == 0
