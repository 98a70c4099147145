"""Class-based n-gram scores of texts (operator 10).

P(word | previous) = P(class | previous class) * P(word | class), both
smoothed. Words above a relative frequency are sorted into classes by
exchange: a word moves to the class that raises the class bigrams'
likelihood most, given the counts of its neighbours' classes. All other
words begin in a class by their ending, where words never seen stay. The
exchange runs in bulk steps: counts are gathered over all training texts,
half of the words move at once, and a step that lowers the likelihood is the
last. Then every rarer training word is given its neighbours' classes by a
shuffle on the word, is moved by the same rule in one step, and its class is
joined back to each of its places in the texts. It may enter the classes that
hold exchanged words.

What every task holds is bounded by relative frequencies, not by the corpus:
at most 1 / ``CLASSED`` words are exchanged in memory and at most 1 / ``KEPT``
words' counts are looked up locally; the classes of all rarer words, and the
counts of those that are not looked up, are met in a join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wikipassages.llm import common
from wikipassages.llm.common import frugal, text_slices
from wikipassages.llm.words import Words, mix, words_of
from wikipassages.session import leaving_no_shuffles

#: Least share of the training tokens of words that are exchanged in memory (rarer ones: ``rare_moves``), and of words whose counts tasks hold.
CLASSED, KEPT = 2e-5, 5e-7
#: Classes that words are exchanged among, and classes by ending.
EXCHANGED, ENDINGS = 48, 48
#: Units (words) whose neighbour counts travel together.
BLOCK = 256
_FLUSH = 400_000
UNITS = "row bigint, train boolean, n_words bigint, n_local bigint, log_counts double, units binary, rest array<bigint>, rest_at array<array<int>>"
PLACED = "row bigint, train boolean, n_words bigint, n_local bigint, log_counts double, units binary, rest_known bigint, rest_logs double"
#: Neighbour classes (of a word, each once) that are weighed at a time.
_WEIGHED = 20_000
#: Parts of the texts whose rare words are placed one after the other, so that only one part's shuffles lie on disk.
PASSES = 4


def written(df: DataFrame, name: str) -> DataFrame:
    """``common.written``; what the stage shuffled goes when it is written."""
    with leaving_no_shuffles(df.sparkSession):
        return common.written(df, name)


def _word_columns(w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word, A-Z as a-z, and the class of its ending (last two bytes)."""
    prefix = w.prefix(seed=5, lower=True)
    ending = w.hash_ranges(prefix, np.maximum(w.start, w.end - 2), w.end)
    return w.hash_ranges(prefix, w.start, w.end), (mix(ending) % np.uint64(ENDINGS)).astype(np.int32)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word counts of a partition (hash, ending, n), combined as far as memory allows."""
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def merged():
        hashes, kinds, n = (np.concatenate(x) for x in zip(*held))
        found, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        return found, kinds[first], np.bincount(inverse, n, len(found)).astype(np.int64)

    def out(found, kinds, n):
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(kinds), pa.array(n)], ["hash", "ending", "n"])

    size = 0
    for part in text_slices(batches, "text"):
        w = words_of(part.column("text"))
        hashes, kinds = _word_columns(w)
        found, first, n = np.unique(hashes, return_index=True, return_counts=True)
        held.append((found, kinds[first], n))
        size += len(found)
        if size > 2 * _FLUSH:
            held = [merged()]
            size = len(held[0][0])
            if size > _FLUSH:
                yield out(*held.pop())
                size = 0
    if held:
        yield out(*merged())


@dataclass
class Vocabulary:
    """Counts of the training tokens; ``hashes`` (sorted) are the words whose counts tasks hold."""
    tokens: int          # N, ends included
    distinct: int        # V, the end included
    texts: int           # how often the end was seen
    hashes: np.ndarray
    counts: np.ndarray
    units: np.ndarray    # number of an exchanged word, else -1
    start: np.ndarray    # an exchanged word's class to begin with
    kinds: np.ndarray    # distinct words by class of ending, those not exchanged


def _vocabulary(table: DataFrame, texts: int) -> Vocabulary:
    totals = table.agg(F.sum("n"), F.count("*")).first()
    tokens, distinct = int(totals[0] or 0) + texts, int(totals[1]) + (texts > 0)
    kept = table.where(F.col("n") >= max(1.0, KEPT * tokens)).toArrow()          # at most 1 / KEPT rows
    hashes = kept.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    hashes, counts, ending = hashes[order], kept.column("n").to_numpy()[order], kept.column("ending").to_numpy()[order]
    exchanged = np.flatnonzero(counts >= max(1.0, CLASSED * tokens))
    units = np.full(len(hashes), -1, np.int32)
    units[exchanged] = np.arange(len(exchanged))
    kinds = np.zeros(ENDINGS, np.int64)
    for kind, n in table.groupBy("ending").agg(F.count("*")).collect():          # ENDINGS rows
        kinds[kind] = n
    kinds -= np.bincount(ending[exchanged], minlength=ENDINGS)
    return Vocabulary(tokens, distinct, texts, hashes, counts, units, (ending[exchanged] % EXCHANGED).astype(np.int32), kinds)


def _as_units(batches: Iterator[pa.RecordBatch], v: Vocabulary) -> Iterator[pa.RecordBatch]:
    """Each text as unit numbers (16 bits), the sums over words with local counts, and the words not exchanged with their places."""
    exchanged = int((v.units >= 0).sum())
    for part in text_slices(batches, "text"):
        w = words_of(part.column("text"))
        hashes, kinds = _word_columns(w)
        found, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(v.hashes, found), max(0, len(v.hashes) - 1))
        known = (v.hashes[at] == found) if len(v.hashes) else np.zeros(len(found), bool)
        unit = np.where(known, v.units[at] if len(v.hashes) else -1, -1)
        rare = (unit < 0)[inverse]
        unit = np.where(unit >= 0, unit, exchanged + kinds[first])[inverse]
        log_count = np.where(known, np.log10((v.counts[at] if len(v.hashes) else 0) + 1.0), 0.0)[inverse]
        local = known[inverse]
        text_of, n = w.doc_of_word(), part.num_rows
        sums = np.bincount(text_of, log_count, n).astype(np.float64)
        n_known = np.bincount(text_of, local, n).astype(np.int64)
        edges = (w.first * 2).astype(np.int32)
        units = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(edges), pa.py_buffer(unit.astype("<u2"))])
        rest = np.flatnonzero(rare)
        order = rest[np.lexsort((hashes[rest], text_of[rest]))]
        new = np.ones(len(order), bool)
        new[1:] = (hashes[order[1:]] != hashes[order[:-1]]) | (text_of[order[1:]] != text_of[order[:-1]])
        heads = np.flatnonzero(new)
        at = pa.array((order - w.first[text_of[order]]).astype(np.int32))
        places = pa.ListArray.from_arrays(pa.array(np.append(heads, len(order)).astype(np.int32)), at)
        lists = pa.array(np.searchsorted(text_of[order[heads]], np.arange(n + 1)).astype(np.int32))
        yield pa.RecordBatch.from_arrays([
            part.column("row"), part.column("train"), pa.array(np.diff(w.first)), pa.array(n_known), pa.array(sums), units,
            pa.ListArray.from_arrays(lists, pa.array(hashes[order[heads]].view(np.int64))),
            pa.ListArray.from_arrays(lists, places)],
            ["row", "train", "n_words", "n_local", "log_counts", "units", "rest", "rest_at"])


def _unit_arrays(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]] if column.buffers()[2] else np.zeros(0, np.uint8)
    return data.view("<u2").astype(np.int64), (offsets - offsets[0]) // 2


def _sequences(column: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts' units with ``end`` after each, the unit before each (``end`` before the first), and n + 1 offsets."""
    units, offsets = _unit_arrays(column)
    flat = np.insert(units, offsets[1:], end)
    return flat, np.append(end, flat[:-1]), offsets + np.arange(len(offsets))


def _neighbours(rows: DataFrame, classes: np.ndarray, n_classes: int) -> DataFrame:
    """(block, counts): for each block of units a matrix, units by following and preceding class."""
    n_units = len(classes)
    blocks = -(-n_units // BLOCK)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((blocks * BLOCK, 2, n_classes), np.int32)
        flat_total = total.reshape(-1)
        seen = False
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                unit, before, _ = _sequences(batch.column("units").slice(lo, 500), n_units - 1)
                flat_total += np.bincount(before * 2 * n_classes + classes[unit], minlength=len(flat_total)).astype(np.int32)
                flat_total += np.bincount((unit * 2 + 1) * n_classes + classes[before], minlength=len(flat_total)).astype(np.int32)
                seen = True
        if seen:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(blocks)), pa.array(
                [zlib.compress(total[b * BLOCK:(b + 1) * BLOCK].tobytes(), 1) for b in range(blocks)], pa.binary())], ["block", "counts"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, total = None, None
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("counts")):
                counts = np.frombuffer(zlib.decompress(raw.as_py()), np.int32).astype(np.int64)
                if block != at and at is not None:
                    yield pa.RecordBatch.from_pydict({"block": [at], "counts": [total.tobytes()]})
                total = counts if block != at else total + counts
                at = block
        if at is not None:
            yield pa.RecordBatch.from_pydict({"block": [at], "counts": [total.tobytes()]})

    parts = rows.mapInArrow(frugal(counted), "block bigint, counts binary")
    return written(parts.repartition("block").sortWithinPartitions("block").mapInArrow(frugal(summed), "block bigint, counts binary"), "neighbours")


def _class_matrix(table: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """Class bigrams (previous, following): n_classes squared numbers from one matrix for each block."""
    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_classes, n_classes), np.int64)
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("counts")):
                counts = np.frombuffer(raw.as_py(), np.int64).reshape(BLOCK, 2, n_classes)[:, 0]
                mine = classes[block * BLOCK:(block + 1) * BLOCK]
                np.add.at(total, mine, counts[:len(mine)])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_classes ** 2)), pa.array(total.reshape(-1))], ["cell", "n"])

    return _from_cells(table.mapInArrow(frugal(folded), "cell bigint, n bigint"), n_classes)


def _from_cells(parts: DataFrame, n_classes: int) -> np.ndarray:
    out = np.zeros(n_classes ** 2, np.int64)
    for cell, n in parts.groupBy("cell").agg(F.sum("n").alias("n")).where("n > 0").collect():      # at most n_classes squared rows
        out[cell] = n
    return out.reshape(n_classes, n_classes)


def _class_bigrams(rows: DataFrame, classes: np.ndarray, n_classes: int) -> np.ndarray:
    """The same from the texts' units."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_classes ** 2, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                unit, before, _ = _sequences(batch.column("units").slice(lo, 500), len(classes) - 1)
                total += np.bincount(classes[before] * n_classes + classes[unit], minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], ["cell", "n"])

    return _from_cells(rows.mapInArrow(frugal(counted), "cell bigint, n bigint"), n_classes)


def _xlogx(x: np.ndarray) -> np.ndarray:
    x = np.maximum(x, 0).astype(np.float64)
    return x * np.log(np.maximum(x, 1))


def likelihood(matrix: np.ndarray) -> float:
    """Of the class bigrams, up to what does not depend on the classes."""
    return float(_xlogx(matrix).sum() - _xlogx(matrix.sum(0)).sum() - _xlogx(matrix.sum(1)).sum())


def _moves(table: DataFrame, matrix: np.ndarray, classes: np.ndarray, n_exchanged: int, parity: int) -> list:
    """(unit, class, gain, tokens, old class) of the exchanged words of this half that gain by moving."""
    n_classes = len(matrix)
    after, before = matrix.sum(1), matrix.sum(0)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, raw in zip(batch.column("block").to_pylist(), batch.column("counts")):
                counts = np.frombuffer(raw.as_py(), np.int64).reshape(BLOCK, 2, n_classes)
                found = []
                for i in range(BLOCK):
                    unit = block * BLOCK + i
                    if unit >= n_exchanged or (unit * 2654435761 >> 7) % 2 != parity:
                        continue
                    own, (succ, pred) = classes[unit], counts[i]
                    n = int(succ.sum())
                    leave = (_xlogx(matrix[own] - succ) - _xlogx(matrix[own])).sum() + (_xlogx(matrix[:, own] - pred) - _xlogx(matrix[:, own])).sum() \
                        - (_xlogx(after[own] - n) - _xlogx(after[own])) - (_xlogx(before[own] - n) - _xlogx(before[own]))
                    m = matrix[:EXCHANGED]
                    enter = (_xlogx(m + succ) - _xlogx(m)).sum(1) + (_xlogx(matrix[:, :EXCHANGED] + pred[:, None]) - _xlogx(matrix[:, :EXCHANGED])).sum(0) \
                        - (_xlogx(after[:EXCHANGED] + n) - _xlogx(after[:EXCHANGED])) - (_xlogx(before[:EXCHANGED] + n) - _xlogx(before[:EXCHANGED]))
                    enter[own] = -leave
                    # empty classes are all alike: words do not all choose the first
                    k = int(np.argmax(np.roll(enter, unit % EXCHANGED)) - unit) % EXCHANGED
                    if k != own and enter[k] + leave > 1e-9:
                        found.append({"unit": unit, "to": k, "gain": float(enter[k] + leave), "n": n, "own": int(own)})
                if found:
                    yield pa.RecordBatch.from_pylist(found, pa.schema([("unit", pa.int64()), ("to", pa.int64()), ("gain", pa.float64()),
                                                                       ("n", pa.int64()), ("own", pa.int64())]))

    return table.mapInArrow(frugal(best), "unit bigint, to bigint, gain double, n bigint, own bigint").collect()   # at most 1 / CLASSED rows


def _accepted(moves: list, matrix: np.ndarray, share: float = 0.25) -> list[tuple[int, int]]:
    """The moves of largest gain, as long as no class changes by more than ``share`` of its tokens (one move is always free).

    Gains hold for one move at a time; so they stay about right together.
    """
    size, changed = matrix.sum(1), np.zeros(len(matrix))
    out = []
    for m in sorted(moves, key=lambda m: (-m["gain"], m["unit"])):
        ends = (m["own"], m["to"])
        if all(changed[c] == 0 or changed[c] + m["n"] <= share * size[c] for c in ends):
            out.append((m["unit"], m["to"]))
            for c in ends:
                changed[c] += m["n"]
    return out


@dataclass
class Classes:
    of_unit: np.ndarray       # class of each unit: exchanged words, endings, classes of moved rare words, end
    log_step: np.ndarray      # log10 P(class | previous class)
    log_inside: np.ndarray    # log10 of what a class's words share out, for each class
    matrix: np.ndarray        # class bigrams (previous, following)
    words: np.ndarray         # distinct training words of each class


def _classes(of_unit: np.ndarray, matrix: np.ndarray, words: np.ndarray) -> Classes:
    n_classes, tokens = len(matrix), matrix.sum(0)
    unigram = (tokens + 1) / (tokens.sum() + n_classes)
    step = (matrix + n_classes * unigram[None, :]) / (matrix.sum(1, keepdims=True) + n_classes)
    # a class shares its tokens and one more for each word, and one for words never seen
    inside = np.log10(tokens + words + 1.0)
    inside[-1] = 0.0
    return Classes(of_unit, np.log10(step), inside, matrix, words)


def exchange(rows: DataFrame, v: Vocabulary, sweeps: int) -> Classes:
    """Classes after at most ``sweeps`` bulk exchange steps over ``rows`` (units of all training texts)."""
    n_exchanged = int((v.units >= 0).sum())
    n_classes = EXCHANGED + ENDINGS + 1
    classes = np.concatenate([v.start, EXCHANGED + np.arange(ENDINGS), np.arange(EXCHANGED), [n_classes - 1]]).astype(np.int64)
    table = _neighbours(rows, classes, n_classes)
    matrix = _class_matrix(table, classes, n_classes)
    for sweep in range(sweeps):
        moved = classes.copy()
        for unit, to in _accepted(_moves(table, matrix, classes, n_exchanged, sweep % 2), matrix):
            moved[unit] = to
        if (moved == classes).all():
            continue
        new_table = _neighbours(rows, moved, n_classes)
        new_matrix = _class_matrix(new_table, moved, n_classes)
        if likelihood(new_matrix) <= likelihood(matrix):
            break
        classes, table, matrix = moved, new_table, new_matrix
    words = np.bincount(classes[:n_exchanged], minlength=n_classes)
    words[EXCHANGED:EXCHANGED + ENDINGS] += v.kinds
    return _classes(classes, matrix, words)


def _contexts(batches: Iterator[pa.RecordBatch], c: Classes) -> Iterator[pa.RecordBatch]:
    """(hash, own, before, after) of the words not exchanged: the classes beside their places, a byte each."""
    for batch in batches:
        for lo in range(0, batch.num_rows, 2000):
            part = batch.slice(lo, 2000)
            unit, before, offsets = _sequences(part.column("units"), len(c.of_unit) - 1)
            words = pc.list_value_length(part.column("rest")).to_numpy(zero_copy_only=False)
            lists = part.column("rest_at").flatten()
            times = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            if not len(lists):
                continue
            at = np.repeat(np.repeat(offsets[:-1], words), times) + lists.flatten().to_numpy()
            hashes = np.repeat(part.column("rest").flatten().to_numpy(), times)
            order = np.argsort(hashes, kind="stable")
            at, hashes = at[order], hashes[order]
            heads = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
            edges = pa.py_buffer(np.append(heads, len(hashes)).astype(np.int32))
            sides = [pa.Array.from_buffers(pa.binary(), len(heads), [None, edges, pa.py_buffer(c.of_unit[x].astype(np.uint8))])
                     for x in (before[at], unit[at + 1])]
            yield pa.RecordBatch.from_arrays([pa.array(hashes[heads]), pa.array(c.of_unit[unit[at[heads]]].astype(np.int32)), *sides],
                                             ["hash", "own", "before", "after"])


def _weighed(word: np.ndarray, beside: np.ndarray, own: np.ndarray, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each word's counts beside the class columns of ``matrix`` add when it enters a class (row), and when it leaves its own."""
    n_classes = len(matrix)
    found, n = np.unique(word * n_classes + beside, return_counts=True)
    word, beside = found // n_classes, found % n_classes
    kinds, kind = np.unique(n * n_classes + beside, return_inverse=True)
    m = matrix[:EXCHANGED, kinds % n_classes]
    enters = (_xlogx(m + kinds // n_classes) - _xlogx(m)).T
    m = matrix[own[word], beside]
    leave = np.bincount(word, _xlogx(m - n) - _xlogx(m), len(own))
    enter = np.zeros((len(own), EXCHANGED))
    heads = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
    lo = 0
    while lo < len(heads):
        hi = max(lo + 1, int(np.searchsorted(heads, heads[lo] + _WEIGHED)))
        end = heads[hi] if hi < len(heads) else len(word)
        enter[word[heads[lo:hi]]] = np.add.reduceat(enters[kind[heads[lo]:end]], heads[lo:hi] - heads[lo])
        lo = hi
    return enter, leave


def _best(rows: pa.Table, matrix: np.ndarray) -> pa.RecordBatch:
    """(hash, n, own, to) of whole words: the class with tokens that each gains most by moving to (-1: none), by the gains of ``_moves``."""
    hashes, first, word = np.unique(rows.column("hash").to_numpy(), return_index=True, return_inverse=True)
    own = rows.column("own").to_numpy()[first].astype(np.int64)
    sides = [rows.column(x).combine_chunks() for x in ("after", "before")]
    word = np.repeat(word, pc.binary_length(sides[0]).to_numpy(zero_copy_only=False))
    beside = [np.frombuffer(b"".join(x.to_pylist()), np.uint8).astype(np.int64) for x in sides]
    n = np.bincount(word, minlength=len(hashes))
    enter, leave = np.zeros((len(hashes), EXCHANGED)), np.zeros(len(hashes))
    for m, classes in ((matrix, beside[0]), (matrix.T, beside[1])):
        more, less = _weighed(word, classes, own, m)
        total = m.sum(1)
        of_class = _xlogx(total[:EXCHANGED] + n[:, None]) - _xlogx(total[:EXCHANGED])
        enter += more - of_class
        leave += less - (_xlogx(total[own] - n) - _xlogx(total[own]))
    # words that enter an empty class in one step, each as if alone, need have nothing in common
    enter[:, matrix.sum(0)[:EXCHANGED] == 0] = -np.inf
    to = np.argmax(enter, axis=1)
    to = np.where(enter[np.arange(len(to)), to] + leave > 1e-9, to, -1)
    return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(n), pa.array(own.astype(np.int32)), pa.array(to.astype(np.int32))], ["hash", "n", "own", "to"])


def _bests(batches: Iterator[pa.RecordBatch], matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    """``_best`` of rows sorted by word; the last word of a batch waits for the next."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*held, batch])
        hashes = rows.column("hash").to_numpy()
        cut = int(np.searchsorted(hashes, hashes[-1]))
        if cut:
            yield _best(rows.slice(0, cut), matrix)
        held = rows.slice(cut).to_batches()
    if held:
        yield _best(pa.Table.from_batches(held), matrix)


def rare_moves(training: DataFrame, c: Classes) -> DataFrame:
    """(hash, n, own, to) of every training word that is not exchanged in memory: its count, class by ending, and better class or -1."""
    beside = training.select("units", "rest", "rest_at").mapInArrow(frugal(lambda b: _contexts(b, c)), "hash bigint, own int, before binary, after binary")
    return written(beside.repartition("hash").sortWithinPartitions("hash").mapInArrow(
        frugal(lambda b: _bests(b, c.matrix)), "hash bigint, n bigint, own int, to int"), "lm-rare")


def _placed(batches: Iterator[pa.RecordBatch], first: int) -> Iterator[pa.RecordBatch]:
    """Rows whose moved words are units of their new classes, which are numbered on from ``first``."""
    names = [x.split()[0] for x in PLACED.split(", ")]
    for batch in batches:
        flat, offsets = _unit_arrays(batch.column("units"))
        moved = batch.column("moved")
        words = pc.fill_null(pc.list_value_length(moved), 0).to_numpy(zero_copy_only=False)
        each = moved.flatten()
        lists = pc.struct_field(each, "at")
        times = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
        flat = flat.astype("<u2")
        if len(each):
            at = np.repeat(np.repeat(offsets[:-1], words), times) + lists.flatten().to_numpy()
            flat[at] = first + np.repeat(pc.struct_field(each, "to").to_numpy(), times)
        units = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer((offsets * 2).astype(np.int32)), pa.py_buffer(flat)])
        yield pa.RecordBatch.from_arrays([units if x == "units" else batch.column(x) for x in names], names)


def place_rare(units: DataFrame, v: Vocabulary, c: Classes) -> tuple[DataFrame, DataFrame, Classes]:
    """``units`` with rest_known and rest_logs (of words whose counts tasks do not hold); the rows to be scored; and their classes.

    All rare words move at once; if that lowers the likelihood they stay in the classes by their ending.
    """
    moves = rare_moves(units.where("train"), c)
    here, beyond = F.size("at"), F.col("n") < max(1.0, KEPT * v.tokens)
    first = int((v.units >= 0).sum()) + ENDINGS
    placed = None
    for part in range(PASSES):
        mine = units.where(F.pmod("row", F.lit(PASSES)) == part)
        rest = mine.select("row", F.explode(F.arrays_zip("rest", "rest_at")).alias("r")).select("row", F.col("r.rest").alias("hash"), F.col("r.rest_at").alias("at")) \
            .join(moves, "hash").groupBy("row").agg(
                F.sum(F.when(beyond, here).otherwise(0)).alias("rest_known"), F.sum(F.when(beyond, here * F.log10(F.col("n") + 1.0)).otherwise(0.0)).alias("rest_logs"),
                F.collect_list(F.when(F.col("to") >= 0, F.struct("to", "at"))).alias("moved"))
        done = written(mine.drop("rest", "rest_at").join(rest, "row", "left").mapInArrow(frugal(lambda b: _placed(b, first)), PLACED), "lm-placed")
        placed = done if placed is None else placed.union(done)
    matrix = _class_bigrams(placed.where("train").select("units"), c.of_unit, len(c.matrix))
    if likelihood(matrix) <= likelihood(c.matrix):
        return placed, units, c
    words = c.words.copy()
    for own, to, n in moves.where("to >= 0").groupBy("own", "to").agg(F.count("*")).collect():      # at most ENDINGS * EXCHANGED rows
        words[own] -= n
        words[to] += n
    return placed, placed, _classes(c.of_unit, matrix, words)


def _scored(batches: Iterator[pa.RecordBatch], c: Classes) -> Iterator[pa.RecordBatch]:
    n_classes, end = len(c.log_step), len(c.of_unit) - 1
    log_step = c.log_step.reshape(-1)
    for batch in batches:
        out = []
        for lo in range(0, batch.num_rows, 500):
            unit, before, offsets = _sequences(batch.column("units").slice(lo, 500), end)
            now = c.of_unit[unit]
            each = np.append(0, np.cumsum(log_step[c.of_unit[before] * n_classes + now] - c.log_inside[now]))
            out.append(each[offsets[1:]] - each[offsets[:-1]])
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.concatenate(out) if out else np.zeros(0))], ["row", "log_classes"])


def scored(df: DataFrame, train: str, text: str = "text", sweeps: int = 6) -> DataFrame:
    """``df`` with n_tokens, n_known, train_tokens, base_score and score (replaced if there).

    Learns from the rows where the boolean column ``train`` is true (null:
    not). Tokens: words, A-Z as a-z, and one end for each text; null and empty
    texts are their end alone. base_score: add-one unigrams; score: the class
    model; both log10 of the whole text's probability. Without training rows
    every class is as likely as any other. Every row is scored, repeated ones each.
    """
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kept = df.drop(*names, "__row")
    rows = written(kept.withColumn("__row", F.monotonically_increasing_id()), "lm-rows")
    texts = rows.select(F.col("__row").alias("row"), F.coalesce(train, F.lit(False)).alias("train"), F.col(text).alias("text"))
    counts = texts.where("train").select("text").mapInArrow(frugal(_counted), "hash bigint, ending int, n bigint") \
        .groupBy("hash").agg(F.first("ending").alias("ending"), F.sum("n").alias("n"))
    counts = written(counts, "word-counts")
    v = _vocabulary(counts, texts.where("train").count())
    units = written(texts.mapInArrow(frugal(lambda b: _as_units(b, v)), UNITS), "lm-units")
    classes = exchange(units.where("train").select("units"), v, sweeps)
    units, placed, classes = place_rare(units, v, classes)
    by_class = placed.select("row", "units").mapInArrow(frugal(lambda b: _scored(b, classes)), "row bigint, log_classes double")
    all_logs = F.col("log_counts") + F.coalesce("rest_logs", F.lit(0.0))
    end_known = int(v.texts > 0)
    out = units.drop("train", "units").join(by_class, "row").select(
        F.col("row").alias("__row"), (F.col("n_words") + 1).alias("n_tokens"),
        (F.col("n_local") + F.coalesce("rest_known", F.lit(0)) + end_known).cast("bigint").alias("n_known"),
        F.lit(v.tokens).cast("bigint").alias("train_tokens"),
        (all_logs + float(np.log10(v.texts + 1.0)) - (F.col("n_words") + 1) * float(np.log10(v.tokens + v.distinct + 1.0))).alias("base_score"),
        (all_logs + F.col("log_classes")).alias("score"))
    return rows.join(out, "__row").drop("__row")
