"""Personal data by fixed rules and a semi-Markov conditional random field (operator 11).

The base rules find emails, IP addresses, card and phone numbers by their
form. They take the longest run and give up when it fails, so two cards in a
row or a phone number followed by an address are lost, and so are spellings
the patterns do not know. The field goes over what the rules left: candidate
segments of at most ``MOST_ATOMS`` atoms (runs of letters or of digits, single other
characters) are scored as wholes, with checksums, digit counts, shapes and neighbours as
features, every other atom stands alone, and dynamic programming over atoms and
kinds picks boundaries and kinds jointly. Spans of the base rules always stay;
the field adds spans that touch none of them.

The field is trained at each use, by maximum likelihood, on generated examples (a
fixed seed) and on at most ``MOST_WINDOWS`` windows of the corpus, labelled by
the base rules, with and without their spans. Everything else covers all texts.
"""

from __future__ import annotations

import heapq
import math
import random
import re
import zlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wikipassages.llm.common import frugal, text_slices, written

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)
#: Windows of the corpus that the field is fitted on, at most: half with base spans, half with digits but none.
MOST_WINDOWS = 1200
#: Atoms of a candidate segment, at most.
MOST_ATOMS = 24
PASSES = 6

# ---------------------------------------------------------------- base rules
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A run of digits is entered at its first digit only: from a later one a match would need the same rest.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"(?<![0-9])[0-9]++(?:[ -][0-9]++)*+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]|[\[({] ?at ?[\])}]", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in s.split("."))


def base_matches(text: str) -> list[tuple[int, int, int, bool]]:
    """(start, kind, end, whether it passes) of every leftmost match of each kind's pattern."""
    out = []
    at, after = text.find("@"), 0
    while at >= 0:
        left = at
        while left > after and text[left - 1] in _LOCAL:
            left -= 1
        right = _DOMAIN.match(text, at + 1) if left < at else None
        if right:
            out.append((left, EMAIL, right.end(), True))
            after = right.end()
        at = text.find("@", at + 1)
    out += [(m.start(), IP, m.end(), octets(m.group())) for m in _IP.finditer(text)]
    for m in _CARD.finditer(text):
        if m.end() - m.start() > 1:
            digits = only_digits(m.group()) if m.end() - m.start() <= 64 else ""
            out.append((m.start(), CARD, m.end(), 14 <= len(digits) <= 19 and luhn(digits)))
    out += [(m.start(), PHONE, m.end(), 10 <= len(only_digits(m.group())) <= 15) for m in _PHONE.finditer(text)]
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the matches that pass, by start and kind."""
    return sorted(m[:3] for m in base_matches(text) if m[3])


# ---------------------------------------------------------------- candidate segments
_NUMERIC = re.compile(r"[+(]?[0-9][0-9 ().+-]*")
_ATOM = re.compile(r"[^\W\d_]+|[0-9]+|.", re.S)
_AT = re.compile(r" ?[\[({] ?at ?[\])}] ?", re.I)
_NAME = re.compile(r"[A-Za-z0-9-]++(?:(?:\.| ?[\[({] ?dot ?[\])}] ?)[A-Za-z0-9-]++)++", re.I)
_ANY_DOT = re.compile(r"\.| ?[\[({] ?dot ?[\])}]", re.I)
_DIGITS = re.compile("[0-9]+")
_DOT = re.compile(r" ?[\[({] ?dot ?[\])}] ?", re.I)
_PLAIN_PHONE = re.compile(r"(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}")
_SHAPES = [re.compile(p) for p in (r"[0-9]+", r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}", r"[0-9]{4}([ -])[0-9]{6}\1[0-9]{5}")]


def _numeric_candidates(text: str, lo: int, hi: int):
    """Segments of a run of digits and separators: from a digit run, ``+`` or ``(`` to the end of a digit run."""
    runs = [(m.start(), m.end()) for m in _DIGITS.finditer(text, lo, hi)]
    for i, (first, first_end) in enumerate(runs):
        starts = [first]
        if first > 0 and text[first - 1] in "+(":
            starts.append(first - 1)
            if first > 1 and text[first - 2] == "+":
                starts.append(first - 2)
        digits = 0
        for j in range(i, min(i + MOST_ATOMS // 2, len(runs))):
            digits += runs[j][1] - runs[j][0]
            if digits > 19:
                break
            if digits < 4:
                continue
            end = runs[j][1]
            for start in starts:
                span = text[start:end]
                if start == first:
                    if j == i + 3 and span.count(".") == 3 and len(span) == digits + 3:
                        yield start, IP, end
                    if digits >= 14 and not span.strip("0123456789 -") and "  " not in span and "--" not in span:
                        yield start, CARD, end
                if 7 <= digits <= 15 and (span[0] == "+" or _PLAIN_PHONE.fullmatch(span)):
                    yield start, PHONE, end


def _email_candidates(text: str):
    for m in _AT.finditer(text):
        right = _NAME.match(text, m.end())
        if not right:
            continue
        left = m.start()
        while left > 0 and m.start() - left < 64 and text[left - 1] in _LOCAL:
            left -= 1
        ends = {right.end()} | {d.start() for d in _ANY_DOT.finditer(text, m.end(), right.end())}
        for start in {left, *(k for k in range(left, m.start()) if k == left or text[k - 1] in ".%+-")}:
            for end in ends:
                if start < m.start() and _NAME.fullmatch(text, m.end(), end):
                    yield start, EMAIL, end


def candidates(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of every candidate segment, by start."""
    out = list(_email_candidates(text))
    for m in _NUMERIC.finditer(text):
        if m.end() - m.start() >= 7:
            out += _numeric_candidates(text, m.start(), m.end())
    return sorted(out)


def _side(text: str, at: int) -> str:
    if not 0 <= at < len(text):
        return "edge"
    c = text[at]
    return "digit" if c.isdigit() else "letter" if c.isalpha() else "space" if c.isspace() else c if c in ".-+()/@#$%=\"" else "mark"


def features(text: str, start: int, kind: int, end: int) -> list[str]:
    """Names of the features of the whole segment ``text[start:end]`` as ``kind``."""
    span = text[start:end]
    left, right = _side(text, start - 1), _side(text, end)
    out = ["bias", f"left {left}", f"right {right}"]
    if left in ("space", ".", "-", "(") and _side(text, start - 2) == "digit":
        out.append("digit before")
    if right in ("space", ".", "-", ")") and _side(text, end + 1) == "digit":
        out.append("digit after")
    digits = only_digits(span)
    if kind == EMAIL:
        out += [f"labels {min(len(re.split(_DOT, span)) + span.count('.'), 4)}", f"last {span[-4:].isalpha() or span[-3:].isalpha()}"]
    elif kind == IP:
        out += [f"octets {octets(span)}", f"zero {any(p[0] == '0' and p != '0' for p in span.split('.'))}"]
    elif kind == CARD:
        shape = next((i for i, p in enumerate(_SHAPES) if p.fullmatch(span)), len(_SHAPES))
        checked = luhn(digits)
        out += [f"luhn {checked}", f"shape {shape}", f"luhn {checked} shape {shape}", f"digits {len(digits)}",
                f"luhn {checked} enough {len(digits) >= 14}"]
    else:
        plain = bool(_PLAIN_PHONE.fullmatch(span))
        groups = [len(g) for g in re.findall("[0-9]+", span)]
        out += [f"plus {span[0] == '+'}", f"digits {len(digits)}", f"plain {plain}", f"paired {span.count('(') == span.count(')')}",
                f"last group {min(groups[-1], 5)}", f"groups {min(len(groups), 6)}", f"parted {any(c in span for c in ' -')}",
                f"long group {max(groups) > 7}"]
    return [f"{KINDS[kind]}: {f}" for f in out]


def _atom_kind(atom: str) -> str:
    c = atom[0]
    return f"outside: digits {min(len(atom), 6)}" if c.isdigit() else "outside: letters" if c.isalpha() else "outside: +" if c == "+" else "outside: mark"


# ---------------------------------------------------------------- lattice
@dataclass
class Zone:
    """A stretch covered by overlapping candidates: its atoms, and the segments ending after each of them."""
    start: int
    bounds: list[int]                                     # places of the atoms' edges in the text
    outside: list[str]                                    # feature of each atom that stands alone
    ending: list[list[tuple[int, int, list[str]]]]          # by number of the edge: (first edge, kind, features)


def zones(text: str, fixed: list[tuple[int, int, int]]) -> list[Zone]:
    """Zones of ``text`` from the candidates that touch no span of ``fixed`` (ascending).

    Outside the zones every atom can only stand alone, so the best path of the whole text is made of those of its zones.
    """
    free, k, reach = [], 0, []
    for s, _, e in sorted(fixed):                           # merged stretches of the fixed spans
        if reach and s < reach[-1][1]:
            reach[-1][1] = max(reach[-1][1], e)
        else:
            reach.append([s, e])
    for c in candidates(text):
        while k < len(reach) and reach[k][1] <= c[0]:
            k += 1
        if k == len(reach) or reach[k][0] >= c[2]:
            free.append(c)
    out, group, end = [], [], -1
    for c in [*free, (len(text) + 1, 0, len(text) + 1)]:
        if group and c[0] >= end:
            lo = group[0][0]
            places = [lo]
            for m in _ATOM.finditer(text, lo, end):
                places.append(m.end())
            edge = {p: i for i, p in enumerate(places)}
            ending: list[list[tuple[int, int, list[str]]]] = [[] for _ in places]
            for s, kind, e in group:
                if s in edge and e in edge and edge[e] - edge[s] <= MOST_ATOMS:
                    ending[edge[e]].append((edge[s], kind, features(text, s, kind, e)))
            out.append(Zone(lo, places, [_atom_kind(text[a:b]) for a, b in zip(places, places[1:])], ending))
            group = []
        group.append(c)
        end = max(end, c[2]) if len(group) > 1 else c[2]
    return out


LABELS = len(KINDS) + 1          # label 0: outside, k + 1: kind k


@dataclass
class Field:
    """Weights by feature name; ``step a b``: label b right after label a."""
    weights: dict[str, float]

    def _arcs(self, zone: Zone) -> list[list[tuple[int, int, float]]]:
        """For each edge, the segments that end there: (first edge, label, score)."""
        w = self.weights.get
        arcs = [[(i, kind + 1, sum(w(f, 0.0) for f in names)) for i, kind, names in ending] for ending in zone.ending]
        for j, name in enumerate(zone.outside, 1):
            arcs[j].append((j - 1, 0, w(name, 0.0)))
        return arcs

    def _steps(self) -> list[list[float]]:
        return [[self.weights.get(f"step {a} {b}", 0.0) for b in range(LABELS)] for a in range(LABELS)]

    def best(self, zone: Zone) -> list[tuple[int, int, int]]:
        """(start, kind, end) of the segments of the best path."""
        steps, arcs = self._steps(), self._arcs(zone)
        value = [[-math.inf] * LABELS for _ in zone.bounds]
        back: list[list] = [[None] * LABELS for _ in zone.bounds]
        value[0][0] = 0.0
        for j in range(1, len(zone.bounds)):
            for i, label, score in arcs[j]:
                for a in range(LABELS):
                    v = value[i][a] + steps[a][label] + score
                    if v > value[j][label]:
                        value[j][label], back[j][label] = v, (i, a)
        j, label, out = len(zone.bounds) - 1, max(range(LABELS), key=value[-1].__getitem__), []
        while j > 0:
            i, a = back[j][label]
            if label:
                out.append((zone.bounds[i], label - 1, zone.bounds[j]))
            j, label = i, a
        return out[::-1]

    def expected(self, zone: Zone) -> tuple[float, dict[str, float]]:
        """Logarithm of the sum over all paths, and the expected count of each feature."""
        steps, arcs, n = self._steps(), self._arcs(zone), len(zone.bounds)
        forward = [[-math.inf] * LABELS for _ in range(n)]
        forward[0][0] = 0.0
        for j in range(1, n):
            into: list[list[float]] = [[] for _ in range(LABELS)]
            for i, label, score in arcs[j]:
                into[label].append(score + _log_sum([forward[i][a] + steps[a][label] for a in range(LABELS)]))
            forward[j] = [_log_sum(x) for x in into]
        total = _log_sum(forward[-1])
        counts: dict[str, float] = {}
        backward = [[-math.inf] * LABELS for _ in range(n)]
        backward[-1] = [0.0] * LABELS
        for j in range(n - 1, 0, -1):
            for (i, label, score), names in zip(arcs[j], [*(x[2] for x in zone.ending[j]), [zone.outside[j - 1]]]):
                for a in range(LABELS):
                    tail = steps[a][label] + score + backward[j][label]
                    backward[i][a] = _log_sum([backward[i][a], tail])
                    p = math.exp(forward[i][a] + tail - total)
                    if p > 0:
                        for f in (*names, f"step {a} {label}"):
                            counts[f] = counts.get(f, 0.0) + p
        return total, counts

    def path_counts(self, zone: Zone, spans: list[tuple[int, int, int]]) -> dict[str, float] | None:
        """Feature counts of the path with exactly these segments; none if the zone lacks one of them."""
        edge = {p: i for i, p in enumerate(zone.bounds)}
        starts = {edge.get(s): (kind, edge.get(e)) for s, kind, e in spans}
        if None in starts or any(e is None for _, e in starts.values()):
            return None
        counts: dict[str, float] = {}
        at, label = 0, 0
        while at < len(zone.bounds) - 1:
            if at in starts:
                kind, end = starts.pop(at)
                names = next((x[2] for x in zone.ending[end] if x[0] == at and x[1] == kind), None)
                if names is None:
                    return None
                step, at, label = f"step {label} {kind + 1}", end, kind + 1
            else:
                names, step, at, label = [zone.outside[at]], f"step {label} 0", at + 1, 0
            for f in (*names, step):
                counts[f] = counts.get(f, 0.0) + 1
        return None if starts else counts


def _log_sum(values: list[float]) -> float:
    top = max(values, default=-math.inf)
    return top if top == -math.inf else top + math.log(sum(math.exp(v - top) for v in values))


# ---------------------------------------------------------------- training
def generated(n: int, seed: int = 11) -> list[tuple[str, list[tuple[int, int, int]]]]:
    """``n`` texts of made-up words with spans of all kinds in known places, alone or side by side, and look-alikes."""
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choice("abcdefghilmnoprstuv") for _ in range(rng.randint(2, 9)))

    def digits(n: int) -> str:
        return "".join(rng.choice("0123456789") for _ in range(n))

    def card(valid: bool = True) -> str:
        n = rng.choice((14, 15, 16, 16, 16, 16, 19))
        body = rng.choice("3456") + digits(n - 2)
        check = next(c for c in "0123456789" if luhn(body + c))
        d = body + (check if valid else str((int(check) + rng.randint(1, 9)) % 10))
        sep = rng.choice(("", "", " ", "-"))
        cuts = (4, 10) if n == 15 else range(4, n, 4)
        return sep.join(d[a:b] for a, b in zip((0, *cuts), (*cuts, n))) if sep else d

    def phone() -> str:
        a, b, c = digits(3), digits(3), digits(4)
        return rng.choice((f"+1 ({a}) {b}-{c}", f"+{rng.randint(1, 99)} {a} {b} {c}", f"+{rng.randint(1, 99)}{a}{b}{c}", f"({a}) {b}-{c}",
                           f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"+{rng.randint(1, 99)}-{a}-{b}-{c}"))

    def address() -> str:
        at = rng.choice((" (at) ", " [at] ", "(at)", "[at]", " {at} "))
        dot = rng.choice((".", ".", " (dot) ", "[dot]"))
        name = rng.choice((word(), f"{word()}.{digits(2)}", f"{word()}_{word()}"))
        return name + at + dot.join([word(), *([word()] if rng.random() < 0.5 else []), rng.choice(("com", "org", "net", "de"))])

    def ip() -> str:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))

    def other() -> str:
        return rng.choice((card(False), card(False), digits(rng.randint(1, 13)), digits(rng.randint(20, 40)), f"{digits(1)}.{digits(1)}.{digits(2)}",
                           f"{rng.randint(256, 999)}.{digits(3)}.{digits(2)}.{digits(1)}", f"20{digits(2)}-0{rng.randint(1, 9)}-{rng.randint(10, 28)}",
                           f"{digits(3)}-{digits(4)}", f"{digits(1)},{digits(3)}.{digits(2)}", f"+{digits(2)}", f"({digits(3)})",
                           f"{digits(4)} {digits(4)}", f"{digits(5)}-{digits(4)}", f"{digits(2)}:{digits(2)}", f'"{digits(16)}e{digits(12)}"'))

    out = []
    for _ in range(n):
        text, spans = " ".join(word() for _ in range(rng.randint(1, 4))), []
        for _ in range(rng.choice((1, 1, 1, 2, 2, 3))):
            kind = rng.choice((EMAIL, IP, CARD, CARD, PHONE, PHONE, None, None, None))
            piece = (address, ip, card, phone)[kind]() if kind is not None else other()
            text += rng.choice((" ", " ", " ", ", ", ": ", " (")) if rng.random() < 0.9 else "\n"
            if kind is not None:
                spans.append((len(text), kind, len(text) + len(piece)))
            text += piece
            if rng.random() < 0.5:
                text += rng.choice((" ", ", ", ". ")) + word()
        out.append((text + rng.choice(("", ".", " " + word())), spans))
    return out


def train(examples: list[tuple[str, list[tuple[int, int, int]]]], passes: int = PASSES, rate: float = 0.5, shrink: float = 1e-3) -> Field:
    """The field of highest regularised likelihood: adaptive gradient steps over the examples' zones, in a fixed order."""
    data, model = [], Field({})
    for text, spans in examples:
        for zone in zones(text, []):
            inside = [s for s in spans if s[0] < zone.bounds[-1] and s[2] > zone.start]
            counts = model.path_counts(zone, inside)
            if counts is not None:
                data.append((zone, counts))
    weights, squares = model.weights, {}
    rng = random.Random(3)
    for _ in range(passes):
        rng.shuffle(data)
        for zone, counts in data:
            slope = {f: -v for f, v in model.expected(zone)[1].items()}
            for f, v in counts.items():
                slope[f] = slope.get(f, 0.0) + v
            for f, v in slope.items():
                g = v - shrink * weights.get(f, 0.0)
                if abs(g) > 1e-6:
                    squares[f] = squares.get(f, 1e-6) + g * g
                    weights[f] = weights.get(f, 0.0) + rate * g / math.sqrt(squares[f])
    return model


def window_sample(docs: DataFrame, text: str = "text", most: int = MOST_WINDOWS) -> list[str]:
    """Windows of whole words around digits or at-signs: of those with and those without base spans the ``most // 2``
    of smallest hash each, every window once. Windows in which a rule gave up on an overlong run are left out: the rules
    do not know what is in there."""
    half = most // 2

    def picked(batches):
        held: dict[bool, dict[str, int]] = {True: {}, False: {}}
        for piece in text_slices(batches, text):
            for t in piece.column(text).to_pylist():
                m = _TRIGGER.search(t) if t else None
                while m:
                    lo = t.rfind(" ", 0, max(m.start() - 30, 0)) + 1
                    hi = t.find(" ", min(m.end() + 60, len(t)))
                    window = t[max(lo, m.start() - 200):min(hi if hi >= 0 else len(t), m.end() + 200)]
                    matches = base_matches(window)
                    if not any(not ok and len(only_digits(window[s:e])) > (19 if kind == CARD else 15) for s, kind, e, ok in matches):
                        side = held[any(ok for *_, ok in matches)]
                        side[window] = zlib.crc32(window.encode())
                        if len(side) > 4 * half:
                            keep = heapq.nsmallest(half, side.items(), key=lambda x: (x[1], x[0]))
                            side.clear()
                            side.update(keep)
                    m = _TRIGGER.search(t, max(hi, m.end()) if hi >= 0 else len(t))
        rows = [(h, w, kind) for kind, side in held.items() for w, h in heapq.nsmallest(half, side.items(), key=lambda x: (x[1], x[0]))]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
                                          pa.array([r[2] for r in rows], pa.bool_())], ["hash", "sample", "spans"])

    found = written(docs.select(text).mapInArrow(frugal(picked), "hash long, sample string, spans boolean").distinct(), "pii-windows")
    out = []
    for side in (True, False):
        mine = found.where(F.col("spans") == side)
        # the smallest hashes by a quantile first: tasks then send few rows that do not make it
        share = min(1.0, half / max(mine.count(), 1))
        low = mine.select(F.percentile_approx("hash", share, 10_000)).scalar()
        out += [r["sample"] for r in mine.where(F.col("hash") <= low).orderBy("hash", "sample").limit(half).collect()]
    return out


def fit(docs: DataFrame, text: str = "text", most: int = MOST_WINDOWS, made: int = 1200) -> Field:
    """The field from ``made`` generated examples and at most ``most`` windows of ``docs``."""
    return train(generated(made) + [(w, _apart(base_spans(w))) for w in window_sample(docs, text, most)])


def _apart(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans without those that overlap an earlier one."""
    out: list[tuple[int, int, int]] = []
    for s in spans:
        if not out or s[0] >= out[-1][2]:
            out.append(s)
    return out


# ---------------------------------------------------------------- the operator
def spans_of(text: str, model: Field) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans and all spans of a text, each by start and kind."""
    if not _TRIGGER.search(text):
        return [], []
    base = base_spans(text)
    added = [s for zone in zones(text, base) for s in model.best(zone)]
    return base, sorted(base + added)


def found(docs: DataFrame, model: Field, text: str = "text", out: str = "pii") -> DataFrame:
    """``docs`` with a struct column ``out``: base counts ``n_email, n_ip, n_card, n_phone``, ``n_added``, ``base``
    and ``spans`` (arrays of kind, start, end in code points, end exclusive, by start and kind).

    A null text counts as empty; repeated rows give repeated results; an input column named ``out`` is replaced,
    any other name is kept as it is.
    """
    columns = [c for c in docs.columns if c != out]
    weights = dict(model.weights)
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        field = Field(weights)
        for piece in text_slices(batches, "text"):
            base, every = [], []
            for t in piece.column("text").to_pylist():
                b, a = spans_of(t or "", field)
                base.append(b)
                every.append(a)
            counts = [pa.array([sum(s[1] == kind for s in b) for b in base], pa.int64()) for kind in range(len(KINDS))]
            added = pa.array([len(a) - len(b) for a, b in zip(every, base)], pa.int64())
            lists = [pa.array([[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in spans] for spans in side], span) for side in (base, every)]
            yield pa.RecordBatch.from_arrays([piece.column("row"), pa.StructArray.from_arrays(
                [*counts, added, *lists], [*(f"n_{k}" for k in KINDS), "n_added", "base", "spans"])], ["row", "found"])

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    kinds = ", ".join(f"n_{k}: bigint" for k in KINDS)
    listed = "array<struct<kind: string, start: int, end: int>>"
    schema = f"row {rows.schema['row'].dataType.simpleString()}, found struct<{kinds}, n_added: bigint, base: {listed}, spans: {listed}>"
    return rows.mapInArrow(frugal(run), schema).select("row.*", F.col("found").alias(out))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span replaced by its kind in brackets; of overlapping spans the first, with the others' reach."""
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], f"[{KINDS[kind]}]"]
        at = max(at, end)
    return "".join(out) + text[at:]
