"""Base rules against plain patterns, the field against enumeration of all paths, and its finds on unseen examples."""

import itertools
import math
import random
import re

import pytest

from wikipassages.llm import pii

#: The contract's patterns as they stand.
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def plain_base(text):
    def passes(kind, s):
        digits = re.sub("[^0-9]", "", s)
        if kind == pii.IP:
            return all(int(p) <= 255 for p in s.split("."))
        if kind == pii.CARD:
            total = sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1]))
            return 14 <= len(digits) <= 19 and total % 10 == 0
        return kind == pii.EMAIL or 10 <= len(digits) <= 15
    return sorted((m.start(), kind, m.end()) for kind, p in enumerate(PATTERNS) for m in re.finditer(p, text) if passes(kind, m.group()))


def test_base_rules_equal_the_patterns():
    rng = random.Random(5)
    texts = ["", "a@b.c", "@b.c", "a@@b.c", "a@b.c@d.e.f", "x@y", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.256", "001.02.3.4", "4111 1111 1111 1111",
             "4111-1111  1111-1111", "+1 (826) 555-4081 190.137.223.204", "é+49 30 1234567é", "+1", "4" * 300 + "@a.b", "1 " * 400]
    texts += ["".join(rng.choice("ab1234590.@+-() é") for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    texts += [t for t, _ in pii.generated(500, seed=21)]
    for t in texts:
        assert pii.base_spans(t) == plain_base(t), t


def test_long_runs_stay_linear():
    for t in ("a" * 300_000, "1" * 300_000, "1 " * 150_000, "+1 " * 100_000, "a.1" * 100_000, "@" * 300_000):
        pii.spans_of(t, pii.Field({}))


@pytest.fixture(scope="module")
def model():
    return pii.train(pii.generated(800))


def all_paths(zone):
    """Every path of a zone as a list of (first edge, end edge, label, features)."""
    def go(at, path):
        if at == len(zone.bounds) - 1:
            yield list(path)
            return
        steps = [(at, at + 1, 0, [zone.outside[at]])]
        steps += [(i, j, kind + 1, names) for j, ending in enumerate(zone.ending) for i, kind, names in ending if i == at]
        for s in steps:
            path.append(s)
            yield from go(s[1], path)
            path.pop()
    yield from go(0, [])


def test_best_path_and_expected_counts_by_enumeration(model):
    tried = 0
    for text in ["5 4444-333-22 1.2.3.4 5", "+1 826 555-4081", "212-555-0199 11 12", "a.b (at) c.de.fg"] + [t for t, _ in pii.generated(60, seed=8)]:
        for zone in pii.zones(text, []):
            paths = list(itertools.islice(all_paths(zone), 20_001))
            if len(paths) > 20_000:
                continue
            scored = []
            for path in paths:
                names, label = [], 0
                for _, _, b, fs in path:
                    names += [*fs, f"step {label} {b}"]
                    label = b
                scored.append((sum(model.weights.get(f, 0.0) for f in names), names, path))
            total = math.log(sum(math.exp(s) for s, *_ in scored))
            best = max(scored, key=lambda x: x[0])
            got = model.best(zone)
            want = [(zone.bounds[i], b - 1, zone.bounds[j]) for i, j, b, _ in best[2] if b]
            assert got == want or abs(sum(s == best[0] for s, *_ in scored)) > 1
            log_total, counts = model.expected(zone)
            assert abs(log_total - total) < 1e-6
            expected = {}
            for s, names, _ in scored:
                for f in names:
                    expected[f] = expected.get(f, 0.0) + math.exp(s - total)
            assert all(abs(counts.get(f, 0.0) - v) < 1e-6 for f, v in expected.items())
            tried += 1
    assert tried > 20


def test_finds_on_unseen_examples(model):
    hits = wanted = wrong = 0
    for text, spans in pii.generated(600, seed=77):
        got = {s for zone in pii.zones(text, []) for s in model.best(zone)}
        hits, wanted, wrong = hits + len(got & set(spans)), wanted + len(spans), wrong + len(got - set(spans))
    assert hits >= 0.98 * wanted and wrong <= 0.02 * wanted


def test_what_the_rules_lose(model):
    text = "+1 (826) 555-4081 190.137.223.204 4111111111111111 5500005555555559 or jo.doe (at) mail.example [dot] com"
    base, every = pii.spans_of(text, model)
    assert [text[a:b] for a, _, b in base] == ["190.137.223.204"]
    assert {(pii.KINDS[k], text[a:b]) for a, k, b in every} == {
        ("phone", "+1 (826) 555-4081"), ("ip", "190.137.223.204"), ("card", "4111111111111111"), ("card", "5500005555555559"),
        ("email", "jo.doe (at) mail.example [dot] com")}
    assert pii.masked("a 1.2.3.4 b", [(2, pii.IP, 9)]) == "a [ip] b"


def test_tables(spark, model):
    rows = [(1, None, "k"), (2, "", "k"), (3, "mail é a@b.co, 10.0.0.1", "k"), (3, "mail é a@b.co, 10.0.0.1", "k"), (None, "4111 1111 1111 1111", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `row` string")
    out = pii.found(docs, model).select("doc_id", "text", "row", "pii.*", pii.joined(pii.F.col("pii.spans")).alias("line")).collect()
    assert len(out) == 5
    by = {(r["doc_id"], r["text"]): r for r in out}
    assert by[1, None]["line"] == "" and by[2, ""]["n_email"] == 0
    assert by[3, rows[2][1]]["line"] == "email:7:13,ip:15:23" and by[3, rows[2][1]]["row"] == "k"
    assert by[None, rows[4][1]]["n_card"] == 1
    assert pii.found(docs.limit(0), model).count() == 0
    assert pii.window_sample(docs.limit(0)) == []
    sample = pii.window_sample(docs)
    assert len(sample) == len(set(sample)) == 2
