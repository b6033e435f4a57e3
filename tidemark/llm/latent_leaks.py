"""Benchmark leaks by latent semantic retrieval and longest common subsequences.

Passages of all documents are TF-IDF rows over the words of the benchmark, reduced by a
randomised SVD whose sums Spark gathers. Windows of the documents whose latent direction
has a high enough cosine with that of a passage of an item are candidates; an item whose
passages have hardly any share in the latent space is looked for by its rarest words
instead, of which any leak holds some. Around candidates, the longest common subsequence
with the item, over all its words and over its answer, decides, so that paraphrases count
and shared phrases do not.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tidemark.llm.frames import map_arrow, map_texts
from tidemark.sources.tables import staged

CELL = 32  # words; a window is two neighbouring cells
PIECE = 48  # words of an item's passage, at most
RANK, SPARE = 128, 8
#: Windows from this cosine on are compared; passages that keep less than the share of their
#: length in the latent space have no direction to go by.
LEAST_COSINE, LEAST_KEPT = 0.25, 0.3
#: Passages whose cosines are worked out at a time.
TARGETS = 1024
#: A leak holds this share of the item's words in order, or the lower share and the answer's.
LEAST_WHOLE, LEAST_PART, LEAST_ANSWER = 0.8, 0.5, 0.8
#: Characters of benchmark text that one search holds in memory, on average; more takes several.
BLOCK_CHARS = 500_000
#: Words that a task turns into vectors at a time.
SLICE_WORDS = 30_000

_MARKS = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: Registers of a count of different passages.
REGISTERS = 64
_COLUMNS = 256  # rows of the vocabulary in one partial sum


def words_of(text: str) -> list[bytes]:
    """Lower-cased words between ASCII white space, without ASCII marks."""
    return text.lower().encode("utf-8", "surrogatepass").translate(None, _MARKS).split()


class Item(NamedTuple):
    key: object
    words: list[int]
    answer: list[int]


def answer_of(text: str) -> list[bytes]:
    """The last sentence or line of three words or more, else the whole text."""
    parts = [words_of(p) for p in text.replace("\n", ". ").split(". ")]
    return next((p for p in reversed(parts) if len(p) >= 3), words_of(text))


def common(words: list[int], masks: dict[int, int], size: int) -> int:
    """Length of the longest common subsequence with the item behind ``masks``."""
    full = (1 << size) - 1
    row = full
    for word in words:
        mask = masks.get(word)
        if mask:
            hit = row & mask
            row = ((row + hit) | (row - hit)) & full
    return size - row.bit_count()


def masks_of(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for n, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << n
    return masks


def coded(docs: DataFrame, key: str, text: str, number: dict[bytes, int]) -> DataFrame:
    """``key`` and ``ids``: each word's number in the vocabulary, 0 for others, as bytes."""
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def make():
        get = shared.value.get

        def work(keys: list, texts: list[str]) -> dict[str, list]:
            return {key: keys, "ids": [np.array([get(w, 0) for w in words_of(t)], "<u4").tobytes() for t in texts]}

        return work

    return map_texts(docs, key, text, "ids binary", make)


class Cells(NamedTuple):
    """The words of some documents laid out one after another."""

    ids: np.ndarray
    begins: np.ndarray  # first word of each document, and the end
    cell: np.ndarray  # of each word; cells are numbered on over all documents
    firsts: np.ndarray  # first cell of each document, and the end


def _laid_out(rows: list[bytes], cell: int) -> Cells:
    parts = [np.frombuffer(r, "<u4") for r in rows]
    sizes = np.array([len(p) for p in parts], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes)))
    counts = -(-sizes // cell)
    firsts = np.concatenate(([0], np.cumsum(counts)))
    inside = np.arange(begins[-1]) - np.repeat(begins[:-1], sizes)
    ids = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
    return Cells(ids, begins, np.repeat(firsts[:-1], sizes) + inside // cell, firsts)


def _word_slices(rows: list[bytes]) -> Iterator[tuple[int, int]]:
    begin = size = 0
    for i, row in enumerate(rows):
        size += len(row) // 4
        if size >= SLICE_WORDS:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(rows):
        yield begin, len(rows)


def _sums(
    codes: DataFrame, make: Callable[[], tuple[Callable, Callable]], kind: str, fold: np.ufunc = np.add
) -> dict[int, np.ndarray]:
    """Vectors by number, added up (or folded) over all documents: in each task, then by Spark
    in two steps.

    ``make`` gives a function to take in rows of ids and one that returns {number: vector}.
    The result is as large as the vocabulary, whatever the input.
    """
    schema = _parse_datatype_string("number int, vector binary")
    arrow = to_arrow_schema(schema)

    def out(found: dict[int, np.ndarray]) -> pa.RecordBatch:
        rows = {"number": list(found), "vector": [v.astype(kind).tobytes() for v in found.values()]}
        return pa.RecordBatch.from_pydict(rows, schema=arrow)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take, give = make()
        for batch in batches:
            rows = batch.column("ids").to_pylist()
            for begin, end in _word_slices(rows):
                take(rows[begin:end])
        yield out(give())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(vector, kind)
                total[number] = fold(total[number], part) if number in total else part
        yield out(total)

    parts = map_arrow(codes, first, schema)
    salted = parts.repartition(F.col("number"), F.pmod(F.spark_partition_id(), F.lit(16)))
    once = map_arrow(salted, add, schema)
    twice = map_arrow(once.repartition("number"), add, schema)
    return {r.number: np.frombuffer(r.vector, kind) for r in twice.collect()}


def _hashed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def _distinct(registers: np.ndarray) -> np.ndarray:
    """How many different values HyperLogLog registers have seen, row by row, about."""
    size = registers.shape[1]
    raw = 0.709 * size**2 / np.exp2(-registers.astype(float)).sum(1)
    empty = (registers == 0).sum(1)
    few = size * np.log(size / np.maximum(empty, 1))
    return np.where((raw <= 2.5 * size) & (empty > 0), few, raw)


def passage_counts(codes: DataFrame, size: int) -> tuple[np.ndarray, float]:
    """In how many different passages of two cells each word occurs, and how many there are.

    Both are HyperLogLog counts over all passages, so that copies count once however many
    there are; they err by some percent, of which the IDF takes the logarithm.
    """

    def make():
        registers = np.zeros((size + 1) * REGISTERS, np.uint8)

        def take(rows: list[bytes]) -> None:
            laid = _laid_out(rows, 2 * CELL)
            if not len(laid.ids):
                return
            starts = np.flatnonzero(np.concatenate(([True], laid.cell[1:] != laid.cell[:-1])))
            inside = np.arange(len(laid.ids)) - np.repeat(starts, np.diff(np.append(starts, len(laid.ids))))
            each = _hashed(laid.ids.astype(np.uint64) << np.uint64(7) | inside.astype(np.uint64))
            passage = np.add.reduceat(each, starts)
            known = laid.ids > 0
            pairs = np.unique((laid.cell[known] - laid.cell[0]) * (size + 1) + laid.ids[known])
            at, word = np.divmod(pairs, size + 1)
            # word 0 stands for all passages
            at, word = np.concatenate((np.arange(len(passage)), at)), np.concatenate((np.zeros(len(passage), int), word))
            value = _hashed(passage[at] + word.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            leading = 53 - np.frexp((value >> np.uint64(11)).astype(float))[1]
            place = word * REGISTERS + (value % np.uint64(REGISTERS)).astype(np.int64)
            np.maximum.at(registers, place, (leading + 1).astype(np.uint8))

        def give() -> dict[int, np.ndarray]:
            parts = {n: registers[n * REGISTERS : (n + _COLUMNS) * REGISTERS] for n in range(0, size + 1, _COLUMNS)}
            return {n: part for n, part in parts.items() if part.any()}

        return take, give

    registers = np.zeros(((size + 1) * REGISTERS,), np.uint8)
    for n, part in _sums(codes, make, "u1", np.maximum).items():
        registers[n * REGISTERS : n * REGISTERS + len(part)] = part
    found = _distinct(registers.reshape(-1, REGISTERS))
    return found[1:], float(found[0])


def _rows(cells: np.ndarray, ids: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the TF-IDF rows, each of length 1, by row."""
    useful = (ids > 0) & (idf[ids] > 0)
    pairs, times = np.unique(cells[useful] * len(idf) + ids[useful], return_counts=True)
    row, column = np.divmod(pairs, len(idf))
    value = times * idf[column]
    starts = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else row
    slot = np.cumsum(np.concatenate(([0], row[1:] != row[:-1]))) if len(row) else row
    length = np.sqrt(np.add.reduceat(value**2, starts)) if len(row) else value
    return slot, column, (value / length[slot] if len(row) else value).astype(np.float32)


def _sketched(slot: np.ndarray, column: np.ndarray, value: np.ndarray, test: np.ndarray):
    """Rows times the test matrix, its Gram matrix, and the rows' transpose times it."""
    if not len(slot):
        return np.zeros((test.shape[1],) * 2), {}
    starts = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
    y = np.add.reduceat(test[column] * value[:, None], starts)
    order = np.argsort(column, kind="stable")
    at = column[order]
    heads = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    back = np.add.reduceat(y[slot[order]] * value[order, None], heads)
    return y.T.astype(float) @ y, (at[heads], back)


def latent_space(codes: DataFrame, items: list[Item], idf: np.ndarray) -> np.ndarray:
    """A direction in the latent space for each word (row 0: none), times its IDF.

    One pass of randomised SVD: with Y = A T for a random T, Spark adds up Y'Y and A'Y;
    the rest needs only these. The benchmark's own passages are rows of A too, weighted to
    the energy of all documents, so that a text which leaked once has a direction.
    """
    columns = RANK + SPARE
    test = np.random.default_rng(9).standard_normal((len(idf), columns)).astype(np.float32)
    shared = codes.sparkSession.sparkContext.broadcast((test, idf))

    def make():
        test, idf = shared.value
        gram, back = np.zeros((columns, columns)), np.zeros((len(idf), columns), np.float32)
        energy = np.zeros(1)

        def take(rows: list[bytes]) -> None:
            laid = _laid_out(rows, 2 * CELL)
            parts = _rows(laid.cell, laid.ids, idf)
            own, sums = _sketched(*parts, test)
            gram.__iadd__(own)
            if sums:
                back[sums[0]] += sums[1]
                energy[0] += parts[0][-1] + 1

        def give() -> dict[int, np.ndarray]:
            used = {n: back[n : n + _COLUMNS].ravel() for n in range(0, len(idf), _COLUMNS) if back[n : n + _COLUMNS].any()}
            return used | {-1: np.concatenate((energy, gram.ravel()))}

        return take, give

    sums = _sums(codes, make, "<f8")
    head = sums.pop(-1, np.zeros(1 + columns * columns))
    gram = head[1:].reshape(columns, columns).copy()
    back = np.zeros((len(idf), columns))
    for n, part in sums.items():
        back[n : n + _COLUMNS] = part.reshape(-1, columns)
    pieces = [piece for item in items for piece in _pieces(item.words)]
    slot = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
    parts = _rows(slot, np.concatenate([*map(np.array, pieces), np.zeros(0, np.int64)]).astype(np.int64), idf)
    own, extra = _sketched(*parts, test)
    if extra:
        weight = max(head[0], 1.0) / (parts[0][-1] + 1)
        gram += weight * own
        back[extra[0]] += weight * extra[1]
    # Y = Q R, so Q'A = inverse(R)' (A'Y)'; directions without energy are left out
    values, vectors = np.linalg.eigh(gram)
    sound = values > values.max(initial=0) * 1e-9
    half = back @ (vectors[:, sound] / np.sqrt(values[sound]))
    strength, turn = np.linalg.eigh(half.T @ half)
    best = np.argsort(-strength)[:RANK]
    best = best[strength[best] > strength.max(initial=0) * 1e-9]
    space = half @ (turn[:, best] / np.sqrt(strength[best]))
    return (space * idf[:, None]).astype(np.float32)


def _pieces(words: list[int]) -> list[list[int]]:
    """Passages of at most ``PIECE`` words of nearly one length."""
    n = max(1, -(-len(words) // PIECE))
    return [words[len(words) * i // n : len(words) * (i + 1) // n] for i in range(n)]


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 1e-6)


def _probe(words: list[int], counts: Sequence[int], least: float) -> tuple[list[int], int]:
    """The rarest of ``words``, and how many of them any text holds that has the share ``least``.

    Such a text lacks at most ``lacking`` of the words, so of more than that some are there,
    whichever are chosen; rare ones are only quicker to look for.
    """
    need = math.ceil(least * len(words) - 1e-9)
    lacking = len(words) - need
    times = Counter(words)
    chosen, held = [], 0
    for word in sorted(times, key=lambda w: (counts[w], w)):
        if held >= lacking + max(min(3, need), need // 4):
            break
        chosen.append(word)
        held += times[word]
    return chosen, held - lacking


def weak_items(items: list[Item], space: np.ndarray, idf: np.ndarray) -> list[int]:
    """Items with a passage that the latent space hardly knows; ``space`` holds words times IDF."""
    weak = []
    for n, item in enumerate(items):
        for piece in _pieces(item.words):
            ids, times = np.unique(piece, return_counts=True)
            whole = np.linalg.norm(times * idf[ids])
            if np.linalg.norm(times @ space[ids]) < LEAST_KEPT * whole or not whole:
                weak.append(n)
                break
    return weak


class Search:
    """Windows near an item's passages, then exact shares, for rows of ids. The items ``weak``
    are looked for by stretches that hold enough of their rarest words."""

    def __init__(self, items: list[Item], space: np.ndarray, counts: Sequence[int], weak: Sequence[int] = ()):
        self.items, self.space = items, space
        known = sorted({*range(len(items))}.difference(weak))
        passages = [(n, p) for n in known for p in _pieces(items[n].words)]
        self.item_of_target = np.array([n for n, _ in passages], np.int64)
        sums = [space[np.array(p, np.int64)].sum(0) for _, p in passages]
        self.targets = _unit(np.stack(sums)) if sums else np.zeros((0, space.shape[1]), space.dtype)
        self.masks = [(masks_of(i.words), masks_of(i.answer)) for i in items]
        self.times = [(Counter(i.words), Counter(i.answer)) for i in items]
        every = []
        for n, item in enumerate(items):
            every.append((n, *_probe(item.words, counts, LEAST_WHOLE)))
            every.append((n, *_probe(item.answer, counts, LEAST_ANSWER)))
        # an answer that is the whole item has the same words again
        probes = [p for n, p in enumerate(every) if not n % 2 or items[p[0]].answer != items[p[0]].words]
        self.item_of = np.array([n for n, _, _ in probes], np.int64)
        self.hits = np.array([hits for _, _, hits in probes], np.int64)
        self.reach = np.array([2 * len(item.words) for item in items], np.int64)
        self.weak = np.zeros(len(items), bool)
        self.weak[list(weak)] = True
        words = np.array([w for _, chosen, _ in probes for w in chosen], np.int64)
        owner = np.repeat(np.arange(len(probes)), [len(chosen) for _, chosen, _ in probes])
        # small numbers are sorted faster
        self.owners = owner[np.argsort(words, kind="stable")].astype(np.min_scalar_type(len(probes)))
        self.degrees = np.bincount(words, minlength=len(space))
        self.begins = np.cumsum(self.degrees) - self.degrees

    def _stretches(self, laid: Cells, row_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Item, first and last word (of all laid out) of the stretches that hold as many words of
        one of the item's probes as any leak does."""
        degrees = self.degrees[laid.ids]
        held = np.flatnonzero(degrees)
        degrees = degrees[held]
        at = np.repeat(held, degrees)
        nth = np.arange(len(at)) - np.repeat(np.cumsum(degrees) - degrees, degrees)
        probe = self.owners[self.begins[laid.ids[at]] + nth]
        order = np.argsort(probe, kind="stable")
        probe, at = probe[order].astype(np.int64), at[order]
        if not len(at):
            return probe, at, at
        last = np.arange(len(at)) + self.hits[probe] - 1
        inside = last < len(at)
        last = np.minimum(last, len(at) - 1)
        item, end = self.item_of[probe], at[last]
        close = inside & (probe[last] == probe) & (row_of[end] == row_of[at]) & (end - at < self.reach[item])
        return item[close], at[close], end[close]

    def _windows(self, laid: Cells) -> np.ndarray:
        """The latent direction of the window that begins at each cell."""
        inside = np.arange(len(laid.ids)) - np.repeat(laid.begins[:-1], np.diff(laid.begins))
        slots = np.zeros((CELL, laid.firsts[-1]), np.int64)  # word 0, which has no direction, fills cells up
        slots[inside % CELL, laid.cell] = laid.ids
        cells = np.zeros((laid.firsts[-1], self.space.shape[1]), self.space.dtype)
        for words in slots:
            cells += self.space[words]
        row_of = np.repeat(np.arange(len(laid.firsts) - 1), np.diff(laid.firsts))
        follows = row_of[1:] == row_of[:-1]
        cells[:-1][follows] += cells[1:][follows].copy()
        return _unit(cells)

    def near(
        self, laid: Cells, row: np.ndarray, item: np.ndarray, first: np.ndarray, last: np.ndarray
    ) -> np.ndarray:
        """The highest cosine of a window with a passage of the item, for each stretch of words
        ``first`` to ``last`` and the windows in whose reach it lies; -1 for items without passages."""
        if not len(self.targets) or not len(item):
            return np.full(len(item), -1.0)
        windows = self._windows(laid)
        reach, begin = self.reach[item], laid.begins[row]
        low = np.maximum(0, -((2 * CELL + reach - 1 - (last - begin)) // CELL))
        high = np.minimum(np.diff(laid.firsts)[row] - 1, (first - begin + reach) // CELL)
        sizes = high - low + 1
        starts = np.cumsum(sizes) - sizes
        window = np.arange(sizes.sum()) + np.repeat(laid.firsts[row] + low - starts, sizes)
        owner = np.repeat(item, sizes)
        best = np.full(len(window), -1.0, windows.dtype)
        for block in range(0, len(self.targets), TARGETS):
            cosines = windows @ self.targets[block : block + TARGETS].T
            of = self.item_of_target[block : block + TARGETS]
            heads = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            cosines = np.maximum.reduceat(cosines, heads, axis=1)
            column = np.full(len(self.items), -1)
            column[of[heads]] = np.arange(len(heads))
            own = np.flatnonzero(column[owner] >= 0)
            best[own] = np.maximum(best[own], cosines[window[own], column[owner[own]]])
        return np.maximum.reduceat(best, starts)

    def shares(self, words: list[int], n: int) -> tuple[float, float] | None:
        """The highest shares of all words and of the answer in one stretch that is a leak.

        A stretch has twice the item's length, so that a share stands close together.
        """
        item, (whole, answer) = self.items[n], self.masks[n]
        size, step = len(item.words), max(1, len(item.words) // 2)

        every, (times, of_answer) = whole.keys(), self.times[n]

        def enough(here: set[int]) -> bool:
            # no subsequence is longer than the words that both have
            held = sum([times[w] for w in here])
            if held < LEAST_PART * size:
                return False
            return held >= LEAST_WHOLE * size or sum([of_answer[w] for w in here]) >= LEAST_ANSWER * len(item.answer)

        # no stretch has more of the item's words than all of them
        if not enough(every & set(words)):
            return None

        def share(near: list[int]) -> tuple[float, float]:
            here = every & set(near)
            if not enough(here):
                return 0.0, 0.0
            near = [w for w in near if w in here]
            return common(near, whole, size) / size, common(near, answer, len(item.answer)) / len(item.answer)

        def leak(of: tuple[float, float]) -> bool:
            return of[0] >= LEAST_WHOLE or of[0] >= LEAST_PART and of[1] >= LEAST_ANSWER

        # each stretch that begins in a step lies in a wider one, whose shares are no lower
        wide = [(share(words[at : at + 2 * size + step]), at) for at in range(0, len(words), step)]
        best = None
        for bound, at in sorted((w for w in wide if leak(w[0])), reverse=True):
            for begin in range(at, min(at + step, len(words))):
                if best is not None and best >= bound:
                    break
                if begin == at or words[begin] in whole:
                    own = share(words[begin : begin + 2 * size])
                    if leak(own) and (best is None or own > best):
                        best = own
        return best

    def matches(self, rows: list[bytes]) -> list[tuple[int, int, float, float, float]]:
        """(row, item, best cosine of a window, shares of all words and of the answer) of the leaks."""
        laid = _laid_out(rows, CELL)
        row_of = np.repeat(np.arange(len(rows)), np.diff(laid.begins))
        item, first, last = self._stretches(laid, row_of)
        row = row_of[first]
        cosine = self.near(laid, row, item, first, last)
        weak = self.weak[item]
        cosine[weak] = 0.0
        kept = weak | (cosine >= LEAST_COSINE)
        row, item, cosine = row[kept], item[kept], cosine[kept]
        place = first[kept] - laid.begins[row]
        places: dict[tuple[int, int], list[int]] = {}
        cosines: dict[tuple[int, int], float] = {}
        for r, n, p, near in zip(row.tolist(), item.tolist(), place.tolist(), cosine.tolist(), strict=True):
            places.setdefault((r, n), []).append(p)
            cosines[r, n] = max(near, cosines.get((r, n), -1.0))
        result = []
        lists: dict[int, list[int]] = {}
        for (row, n), at in places.items():
            ranges = _joined(at, 2 * len(self.items[n].words))
            if row not in lists:
                lists[row] = np.frombuffer(rows[row], "<u4").tolist()
            found = [self.shares(lists[row][begin:end], n) for begin, end in ranges]
            best = max((f for f in found if f), default=None)
            if best:
                result.append((row, n, cosines[row, n], *best))
        return result


def _joined(places: list[int], reach: int) -> list[tuple[int, int]]:
    """Ranges of words that hold every stretch of ``reach`` words around a place, overlaps joined."""
    ranges: list[list[int]] = []
    for place in sorted(set(places)):
        begin, end = max(0, place - reach + 1), place + reach
        if ranges and begin <= ranges[-1][1]:
            ranges[-1][1] = end
        else:
            ranges.append([begin, end])
    return [(b, e) for b, e in ranges]


def _leaks_of(docs: DataFrame, rows: list, key: str, text: str, item_key: str, schema) -> DataFrame | None:
    number: dict[bytes, int] = {}
    items = []
    for item, content in rows:
        ids = [number.setdefault(w, len(number) + 1) for w in words_of(content or "")]
        if ids:
            items.append(Item(item, ids, [number[w] for w in answer_of(content)]))
    if not items:
        return None
    codes = staged(coded(docs, key, text, number), "codes")
    counts, passages = passage_counts(codes, len(number))
    idf = np.concatenate(([0.0], np.log1p(passages / np.maximum(counts, 1))))
    idf = idf.astype(np.float32)
    space = latent_space(codes, items, idf)
    weak = weak_items(items, space, idf)
    shared = docs.sparkSession.sparkContext.broadcast((items, space, [0, *counts.tolist()], weak))
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, space, counts, weak = shared.value
        search = Search(items, space, counts, weak)
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for begin, end in _word_slices(texts):
                found = search.matches(texts[begin:end])
                columns = [[keys[begin + f[0]] for f in found], [items[f[1]].key for f in found]]
                columns += [[round(f[n], 6) for f in found] for n in (2, 3, 4)]
                yield pa.RecordBatch.from_pydict(dict(zip(arrow.names, columns, strict=True)), schema=arrow)

    return map_arrow(codes, run, schema)


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Pairs of ``key`` and ``item_key`` where the document holds the item, with ``cosine``,
    ``lcs_share`` and ``answer_share``. Candidates come by their cosine, those of items without a
    direction by rare words; then ``cosine`` is 0.

    The benchmark is searched in blocks of bounded size, each against all documents, and
    each block's vocabulary bounds what is broadcast or gathered. Null or blank texts on
    either side match nothing; repeated documents or items give repeated pairs; other
    columns are not read. The item's key is called ``item_key`` even if both keys share a name.
    """
    size = benchmark.select(F.sum(F.length(item_text))).first()[0] or 0
    blocks = max(1, -(-int(size) // BLOCK_CHARS))
    kinds = docs.schema[key].dataType.simpleString(), benchmark.schema[item_key].dataType.simpleString()
    name = item_key if item_key != key else "item_key"
    schema = _parse_datatype_string(
        f"`{key}` {kinds[0]}, `{name}` {kinds[1]}, cosine double, lcs_share double, answer_share double"
    )
    result = docs.sparkSession.createDataFrame([], schema)
    for block in range(blocks):
        own = benchmark.where(F.pmod(F.xxhash64(item_text), F.lit(blocks)) == block)
        rows = own.select(item_key, item_text).orderBy(item_key, item_text).collect()
        found = _leaks_of(docs, [tuple(r) for r in rows], key, text, name, schema)
        if found is not None:
            result = result.union(found) if block else found
    return result


def without_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they are."""
    leaks = find_leaks(docs, benchmark, key, text).select(key).distinct()
    return docs.join(leaks, key, "left_anti").select(*docs.columns)
