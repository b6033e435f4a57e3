"""Bytes inside strings that occur twice, by suffix sorting.

A string of the least length contains anchors, k-mers with the smallest hash of a window,
at the same places wherever it stands. Texts are cut into contexts: the starts of strings
with one anchor, and all bytes those strings cover. Contexts whose anchor occurs once hold
nothing; equal contexts hold only repeats and are kept once; different contexts with
the same anchor are compared by the suffix array of their cells, built group by group
in linear time from the longest Lyndon prefixes of the suffixes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tidemark.llm.frames import map_arrow, slices
from tidemark.session import scratch_dir
from tidemark.sources.files import drop_folder
from tidemark.sources.tables import staged

LENGTH = 200
KMER = 32
CELL = 24  # bytes of a suffix sorter's symbol
#: Characters whose anchors are found at a time, and bytes of one piece of a longer text.
SLICE = 600_000
PIECE = 1 << 20
#: Bytes of contexts that are sorted together, unless one anchor alone has more.
BLOCK = 1 << 18
#: Anchors with more different contexts than this are compared string by string instead.
MOST = 20_000

_MASK = np.uint64((1 << 21) - 1)
_BYTES = np.random.default_rng(6).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(size, _BASE, np.uint64)
    down = np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(32))


class Hashes:
    """Hashes of any part of some bytes."""

    def __init__(self, data: np.ndarray):
        size = 1 << max(16, len(data).bit_length())
        up, self.down = _powers(size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[data] * up[: len(data)], out=self.sums[1:])

    def of(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[begin]) * self.down[begin])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbouring values."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    rows = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, 1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def contexts_of(data: np.ndarray, ends: np.ndarray, length: int = LENGTH, kmer: int = KMER):
    """Arrays of the contexts in texts laid out one after another up to ``ends``.

    (text, first start, starts, place of the anchor after the first start, hash of the
    anchor, hash of the whole). At most 2 ** 21 bytes.
    """
    begins = np.concatenate(([0], ends[:-1]))
    counts = np.maximum(ends - begins - length + 1, 0)
    total = int(counts.sum())
    if not total:
        return (np.zeros(0, np.int64),) * 6
    hashes = Hashes(data)
    places = np.arange(len(data) - kmer + 1)
    grams = hashes.of(places, places + kmer)
    least = _least((grams & ~_MASK) | places.astype(np.uint64), length - kmer + 1)
    text = np.repeat(np.arange(len(ends)), counts)
    start = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts) + begins[text]
    anchor = (least[start] & _MASK).astype(np.int64)
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])))
    first = np.flatnonzero(new)
    sizes = np.diff(np.concatenate((first, [total])))
    text, start, anchor = text[first], start[first], anchor[first]
    whole = hashes.of(start, start + sizes - 1 + length) + sizes.astype(np.uint64)
    return text, start - begins[text], sizes, anchor - start, grams[anchor].view(np.int64), whole.view(np.int64)


def _utf8(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


def byte_slices(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of ``texts`` of less than 2 * PIECE bytes, if each text has less."""
    begin = size = 0
    for i, text in enumerate(texts):
        if i > begin and size + len(text) > 2 * PIECE - 1:
            yield begin, i
            begin, size = i, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def contexts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``at``, ``size``, ``off``, ``kmer``, ``whole`` of every context."""
    kind = docs.schema[key].dataType.simpleString()
    schema = _parse_datatype_string(f"`{key}` {kind}, at int, size int, off int, kmer long, whole long")
    arrow = to_arrow_schema(schema)

    def rows(keys: pa.Array, texts: list[bytes], shift: int = 0) -> pa.RecordBatch:
        data = np.frombuffer(b"".join(texts), np.uint8)
        found = contexts_of(data, np.cumsum([len(t) for t in texts]))
        made = [keys.take(pa.array(found[0])), *(pa.array(x) for x in found[1:])]
        if shift:
            made[1] = pa.array(found[1] + shift)
        return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(made, arrow, strict=True)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in slices(texts, SLICE):
                short = [i for i in range(begin, end) if len(texts[i]) <= PIECE // 4]
                if short:
                    own = [_utf8(texts[i]) for i in short]
                    for a, b in byte_slices(own):
                        yield rows(batch.column(0).take(pa.array(short[a:b])), own[a:b])
                for i in set(range(begin, end)) - set(short):
                    data = _utf8(texts[i])
                    for at in range(0, max(1, len(data) - LENGTH + 1), PIECE):
                        yield rows(batch.column(0).slice(i, 1), [data[at : at + PIECE + LENGTH - 1]], at)

    return map_arrow(docs.select(docs[key], docs[text].cast("string")), run, schema)


def suffix_array(text: list[int]) -> list[int]:
    """Suffixes of ``text`` in order; its last symbol must be its smallest and occur once.

    First, groups of suffixes with one prefix are taken in descending order. The group's
    prefix is appended to that of the last suffix before each member that is in a lower
    group: those move up, the further the more members follow them. In the end a group's
    prefix is the longest Lyndon word its suffixes start with. Then, in ascending order, each
    suffix places the one before it and those that this one leads back to, which fills every
    group in order without sorting it.
    """
    n = len(text)
    symbols = sorted(set(text))
    number = {s: i for i, s in enumerate(symbols)}
    group = [number[s] for s in text]
    members: list[list[int]] = [[] for _ in symbols]
    for i, g in enumerate(group):
        members[g].append(i)
    below = list(range(-1, len(symbols) - 1))
    above = [*range(1, len(symbols)), -1]
    done = [False] * len(symbols)
    previous = [-1] * n
    now = len(symbols) - 1
    while now >= 0:
        done[now] = True
        follow: dict[int, int] = {}
        own = [i for i in members[now] if group[i] == now]
        own.sort()
        members[now] = own
        for i in own:
            j = i - 1
            while j >= 0 and done[group[j]]:
                j = previous[j]
            previous[i] = j
            if j >= 0:
                follow[j] = follow.get(j, 0) + 1
        if follow:
            moved: dict[tuple[int, int], list[int]] = {}
            for j, times in follow.items():
                moved.setdefault((group[j], times), []).append(j)
            # of one group those with fewer followers stay lower
            for old, times in sorted(moved, reverse=True):
                new = len(members)
                part = moved[old, times]
                members.append(part)
                done.append(False)
                for j in part:
                    group[j] = new
                upper = above[old]
                below.append(old)
                above.append(upper)
                above[old] = new
                if upper >= 0:
                    below[upper] = new
        lowest = now
        now = below[now]
    start = [0] * len(members)
    at, g = 0, lowest
    while g >= 0:
        start[g] = at
        at += len(members[g])
        g = above[g]
    order = [-1] * n
    order[0] = n - 1
    placed = [False] * n
    placed[n - 1] = True
    for k in range(n):
        j = order[k] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            order[start[g]] = j
            start[g] += 1
            placed[j] = True
            j = previous[j]
    return order


def repeated_starts(parts: list[bytes], anchors: np.ndarray, offs: np.ndarray, sizes: np.ndarray, length: int = LENGTH):
    """For each context whether each of its strings occurs in another one with its anchor.

    Cells lie at distances from the anchor that are multiples of ``CELL``. Strings that start
    as far from their anchor and agree up to the next cell are neighbours of those they are
    equal to, in the order of the suffixes that start with that cell.
    """
    lengths = np.array([len(p) for p in parts], np.int64)
    begins = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(parts) + bytes(CELL), np.uint8)
    shift = offs % CELL  # the first cell of each context
    cells = -(-(lengths - shift) // CELL)
    owner = np.repeat(np.arange(len(parts)), cells)
    first = np.cumsum(cells) - cells
    place = (np.arange(cells.sum()) - first[owner]) * CELL + (begins + shift)[owner]
    grid = data[place[:, None] + np.arange(CELL)]
    # bytes after the end of a context belong to the next one
    grid[np.arange(CELL) >= ((begins + lengths)[owner] - place)[:, None]] = 0
    keys = np.ascontiguousarray(grid).view(">u8")
    ranked = np.lexsort(keys.T[::-1])
    apart = np.concatenate(([False], (keys[ranked[1:]] != keys[ranked[:-1]]).any(1)))
    symbol = np.empty(len(ranked), np.int64)
    symbol[ranked] = np.cumsum(apart) + 2
    text = np.zeros(len(ranked) + len(parts) + 1, np.int64)
    spot = np.arange(len(ranked)) + owner  # a 1 ends each context
    text[:] = 1
    text[spot] = symbol
    text[-1] = 0
    rank = np.empty(len(text), np.int64)
    rank[suffix_array(text.tolist())] = np.arange(len(text))
    counts = sizes
    context = np.repeat(np.arange(len(parts)), counts)
    start = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    cell = -(-(start - shift[context]) // CELL)
    cell = np.maximum(cell, 0)
    begin = begins[context] + start
    head = begins[context] + shift[context] + cell * CELL
    hashes = Hashes(data)
    group = np.unique(anchors, return_inverse=True)[1][context] * (4 * LENGTH) + (start - offs[context]) + 2 * LENGTH
    heads = hashes.of(begin, head)
    follows = rank[spot[first[context] + cell]]
    order = np.lexsort((follows, heads, group))
    strings = hashes.of(begin, begin + length)
    same = (group[order[1:]] == group[order[:-1]]) & (strings[order[1:]] == strings[order[:-1]])
    again = np.zeros(len(order), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    return context, start, again


def _runs(context: np.ndarray, start: np.ndarray, again: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Context, first start and number of the runs of repeated strings."""
    rows = np.flatnonzero(again)
    if not len(rows):
        return rows, rows, rows
    new = np.concatenate(([True], (np.diff(rows) > 1) | (np.diff(context[rows]) > 0)))
    heads = np.flatnonzero(new)
    return context[rows[heads]], start[rows[heads]], np.diff(np.concatenate((heads, [len(rows)])))


def removable(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_bytes``, ``spans`` (start, end of the bytes removed) and ``kept``, the others.

    Every byte of a string of ``LENGTH`` bytes that starts at another place too, of the same
    text or another one, is removed; places are judged on the texts as given. A null, empty
    or shorter text loses nothing. Keys must be unique, but a row that stands there twice is
    taken for two texts with all their long strings repeated. Other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    plain = docs.select(docs[key].alias("_key"), docs[text].cast("string").alias("_text"))
    folder = scratch_dir(docs.sparkSession, "contexts")
    found = contexts(plain, "_key", "_text")
    found.write.parquet(folder)
    every = docs.sparkSession.read.schema(found.schema).parquet(folder)
    twice = every.groupBy("kmer").agg(F.count("*").alias("n")).where("n > 1").select("kmer")
    near = staged(every.join(twice, "kmer"), "contexts-again")
    drop_folder(docs.sparkSession, folder)  # most anchors occur once; nothing reads this again
    different = staged(
        near.groupBy("kmer", "whole").agg(F.count("*").alias("n"), F.min(F.struct("_key", "at", "size", "off")).alias("one")),
        "contexts-different",
    )
    equal = near.join(different.where("n > 1").select("kmer", "whole"), ["kmer", "whole"]).select("_key", "at", "size")
    several = different.groupBy("kmer").agg(F.count("*").alias("m")).where("m > 1")
    open_ = different.join(several, "kmer").select(
        F.col("one._key").alias("_key"),
        F.struct("one.at", "one.size", "one.off", "kmer", "n", (F.col("m") > MOST).alias("many")).alias("part"),
    )
    wanted = open_.groupBy("_key").agg(F.collect_list("part").alias("parts"))
    cut_schema = _parse_datatype_string(
        f"_key {kind}, at int, size int, off int, kmer long, n long, many boolean, bytes binary"
    )
    cut_arrow = to_arrow_schema(cut_schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the contexts to compare; of the strings themselves where there are many."""
        for batch in batches:
            keys, texts, parts = (batch.column(n).to_pylist() for n in range(3))
            for k, t, own in zip(keys, texts, parts, strict=True):
                data = _utf8(t or "")
                rows = []
                for p in own:
                    at, size = p["at"], p["size"]
                    if p["many"]:
                        rows += [(k, s, 1, at + p["off"] - s, p["kmer"], p["n"], True, data[s : s + LENGTH]) for s in range(at, at + size)]
                    else:
                        rows.append((k, at, size, p["off"], p["kmer"], p["n"], False, data[at : at + size - 1 + LENGTH]))
                yield pa.RecordBatch.from_pydict(dict(zip(cut_arrow.names, zip(*rows, strict=True), strict=True)), schema=cut_arrow)

    texts = plain.join(wanted, "_key").select("_key", "_text", "parts")
    pieces = map_arrow(texts, cut, cut_schema)
    found_schema = _parse_datatype_string(f"_key {kind}, at int, size int")
    found_arrow = to_arrow_schema(found_schema)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if size >= BLOCK and row["kmer"] != block[-1]["kmer"]:
                    yield compared(block)
                    block, size = [], 0
                block.append(row)
                size += len(row["bytes"])
        if block:
            yield compared(block)

    def compared(block: list[dict]) -> pa.RecordBatch:
        columns = {name: np.array([row[name] for row in block], np.int64) for name in ("at", "size", "off", "kmer", "n")}
        runs = _runs(*repeated_starts([row["bytes"] for row in block], columns["kmer"], columns["off"], columns["size"]))
        new = columns["n"][runs[0]] == 1  # the strings of equal contexts are known
        context, start, count = (x[new] for x in runs)
        rows = [[block[c]["_key"] for c in context.tolist()], columns["at"][context] + start, count]
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, found_arrow, strict=True)], schema=found_arrow)

    dealt = pieces.where("not many").repartition("kmer").sortWithinPartitions("kmer")
    found = map_arrow(dealt, compare, found_schema)
    strings = pieces.where("many").withColumn("kmer", F.xxhash64("kmer", "off", "bytes"))
    again = strings.groupBy("kmer", "off", "bytes").agg(F.count("*").alias("m"), F.max("n").alias("n")).where("m > 1 or n > 1")
    many = strings.select("_key", "at", "size", "kmer", "off", "bytes").join(again.select("kmer", "off", "bytes"), ["kmer", "off", "bytes"])
    spans = equal.union(found).union(many.select("_key", "at", "size"))
    by_text = spans.groupBy("_key").agg(F.collect_list(F.struct("at", "size")).alias("parts"))
    out_schema = _parse_datatype_string(f"`{key}` {kind}, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")
    out_arrow = to_arrow_schema(out_schema)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, whole = batch.column(0).to_pylist(), [t or "" for t in batch.column(1).to_pylist()]
            for begin, end in slices(whole):
                rows = []
                for k, t, own in zip(keys[begin:end], whole[begin:end], batch.column(2)[begin:end].to_pylist(), strict=True):
                    data = _utf8(t)
                    spans = merged(own or [], len(data))
                    rows.append((k, len(data), [{"start": s, "end": e} for s, e in spans], without(data, spans)))
                yield pa.RecordBatch.from_pydict(dict(zip(out_arrow.names, zip(*rows, strict=True), strict=True)), schema=out_arrow)

    texts = plain.join(by_text, "_key", "left").select("_key", "_text", "parts")
    return map_arrow(texts, finish, out_schema)


def merged(parts: list[dict], size: int) -> list[tuple[int, int]]:
    """Spans covered by the strings that start in ``parts``; touching ones are one span."""
    spans: list[list[int]] = []
    for at, count in sorted((p["at"], p["size"]) for p in parts):
        end = min(at + count - 1 + LENGTH, size)
        if spans and at <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([at, end])
    return [(s, e) for s, e in spans]


def without(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at, kept = 0, []
    for start, end in spans:
        kept.append(data[at:start])
        at = end
    return b"".join(kept) + data[at:]
