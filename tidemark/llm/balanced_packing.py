"""Packing of documents into training windows by multiway differencing.

A document's ids are cut into whole windows; what remains of it is an item. Items are
gathered in blocks of a bounded number of ids, and each block is dealt out to as few windows
as hold it by Karmarkar and Karp's differencing: the two partial partitions with the largest
imbalance are merged, the fullest windows of one with the emptiest of the other. Windows come
out nearly equal; where one exceeds its capacity their number rises, or, where a further
window would be too much padding, the excess is cut off and goes where there is room. What a
task has left below one window is packed once more together with the rest of other tasks.
"""

from __future__ import annotations

import heapq
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tidemark.llm.frames import map_arrow, ship, slices
from tidemark.llm.trie_bpe import Vocabulary
from tidemark.sources.tables import staged

CAPACITY = 4096
#: Windows of a block: with ids of four bytes, 4 MB.
BLOCK_WINDOWS = 256
#: Share of a block's windows that may be added before excess is cut off instead.
SPARE = 1 / 256
#: Items below so many ids are bundled before they are dealt out.
LEAST_ITEM = 32
#: Tasks whose rests are packed together: with less than a window each, 16 MB of ids.
RESTS = 1024
#: Bytes of chunks, words and their ids, with overhead, that a Python worker keeps.
KEPT_BYTES = 160 << 20
_ENTRY_BYTES = 220


class Merges:
    """A vocabulary's merges over many words at once: in each round every word merges the pair
    that comes first in the list, wherever it stands in the word."""

    _BITS = 22

    def __init__(self, vocab: Vocabulary):
        self.inner, self.final = (
            np.array([known[letter] for letter in vocab.letters], dtype=np.int64) for known in (vocab.inner, vocab.final)
        )
        whole = {n: i for i, n in enumerate(vocab.made) if n >= 0}
        self.none = len(vocab.rank)
        self.whole = np.array([whole.get(n, 0) for n in range(self.none + 1)], dtype=np.int64)
        pairs = np.fromiter(vocab.rank.keys(), np.int64, self.none)
        ranks = np.fromiter(vocab.rank.values(), np.int64, self.none)
        # each pair has its own slot in one of a few tables
        self.tables: list[tuple[np.uint64, np.ndarray, np.ndarray]] = []
        odd = 0x9E3779B97F4A7C15
        while len(pairs):
            times = np.uint64(odd)
            slots = self._slots(pairs, times)
            _, first = np.unique(slots, return_index=True)
            kept = np.full(1 << self._BITS, -1, dtype=np.int64)
            rank = np.full(1 << self._BITS, self.none, dtype=np.int32)
            kept[slots[first]], rank[slots[first]] = pairs[first], ranks[first]
            self.tables.append((times, kept, rank))
            pairs, ranks = np.delete(pairs, first), np.delete(ranks, first)
            odd = odd * 0xD6E8FEB86659FD93 % (1 << 64) | 1

    def _slots(self, pairs: np.ndarray, times: np.uint64) -> np.ndarray:
        return ((pairs.view(np.uint64) * times) >> np.uint64(64 - self._BITS)).view(np.int64)

    def _ranks(self, pairs: np.ndarray) -> np.ndarray:
        found = np.full(len(pairs), self.none, dtype=np.int32)
        for times, kept, rank in self.tables:
            slots = self._slots(pairs, times)
            hit = kept[slots] == pairs
            found[hit] = rank[slots[hit]]
        return found

    def encode(self, words: list[str]) -> list[bytes]:
        """Ids of each word as little-endian unsigned 32-bit integers."""
        spelled = [w.encode() for w in words]
        lengths = np.fromiter(map(len, spelled), np.int64, len(words))
        letters = np.frombuffer(b"".join(spelled), dtype=np.uint8)
        ids = self.inner[letters]
        ends = np.cumsum(lengths)
        ids[ends - 1] = self.final[letters[ends - 1]]
        owner = np.repeat(np.arange(len(words)), lengths)
        done_ids, done_owner = [], []
        while len(ids):
            inside = owner[:-1] == owner[1:]
            ranks = np.full(len(ids), self.none, dtype=np.int32)
            ranks[:-1][inside] = self._ranks(ids[:-1][inside] << 32 | ids[1:][inside])
            starts = np.flatnonzero(np.concatenate(([True], ~inside)))
            least = np.minimum.reduceat(ranks, starts)
            sizes = np.diff(np.append(starts, len(ids)))
            least_here = np.repeat(least, sizes)
            over = least_here == self.none
            done_ids.append(ids[over])
            done_owner.append(owner[over])
            first = (ranks == least_here) & ~over
            # of equal letters in a row every other one begins a pair
            at = np.flatnonzero(first)
            run = np.arange(len(at))
            fresh = np.concatenate(([True], np.diff(at) > 1)) if len(at) else np.zeros(0, bool)
            at = at[(run - np.maximum.accumulate(np.where(fresh, run, 0))) % 2 == 0]
            ids[at] = self.whole[ranks[at]]
            left = ~over
            left[at + 1] = False
            ids, owner = ids[left], owner[left]
        ids, owner = np.concatenate(done_ids), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        flat = ids[order].astype("<u4").tobytes()
        cuts = (4 * np.cumsum(np.bincount(owner, minlength=len(words)))).tolist()
        return [flat[begin:end] for begin, end in zip([0, *cuts], cuts, strict=False)]


class Encoder:
    """Ids of texts as bytes, by the distinct chunks and words of each slice; what it keeps of
    them from slice to slice is bounded by size."""

    def __init__(self, tokenizer: str):
        self.vocab = Vocabulary(tokenizer)
        self.merges = Merges(self.vocab)
        self.special = {i: array("I", [i]).tobytes() for i in self.vocab.special.values()}
        self.chunks: dict[str | int, bytes] = dict(self.special)
        self.words: dict[str, bytes] = {}
        self.held = 0

    def _learn(self, new: set[str]) -> None:
        if not new:
            return
        find, known, chunks = self.vocab.word.findall, self.words, self.chunks
        parts = [find(c) for c in new]
        words = list(set(chain.from_iterable(parts)).difference(known))
        if words:
            made = self.merges.encode(words)
            known.update(zip(words, made, strict=True))
            self.held += sum(map(len, words)) + sum(map(len, made)) + _ENTRY_BYTES * len(words)
        whole = [known[p[0]] if len(p) == 1 else b"".join([known[w] for w in p]) for p in parts]
        chunks.update(zip(new, whole, strict=True))
        self.held += sum(map(len, new)) + sum(map(len, whole)) + _ENTRY_BYTES * len(whole)

    def _forget(self) -> None:
        """Keep the earliest quarter of the chunks, the most common ones."""
        self.words = {}
        self.chunks = self.special | dict(islice(self.chunks.items(), len(self.chunks) // 4))
        self.held = sum(len(c) + len(i) + _ENTRY_BYTES for c, i in self.chunks.items() if isinstance(c, str))

    def encode(self, texts: list[str]) -> list[bytes]:
        split = [self.vocab.chunks(t) for t in texts]
        self._learn(set().union(*split).difference(self.chunks))
        ids = self.chunks
        found = [b"".join([ids[c] for c in part]) for part in split]
        if self.held > KEPT_BYTES:
            self._forget()
        return found


@lru_cache(maxsize=1)
def encoder(tokenizer: str) -> Encoder:
    """Outlives a task where Python workers are used again."""
    return Encoder(tokenizer)


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window, below ``k``, of each item, by multiway differencing of their sizes.

    A partial partition is the sums of its non-empty windows, largest first, and the tree node
    of each; merging adds a node for every two windows put together.
    """
    order = np.argsort(-sizes, kind="stable")
    heap = [(-int(sizes[i]), n, sizes[i : i + 1], np.array([i])) for n, i in enumerate(order.tolist())]
    joined: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    nodes = turn = len(sizes)
    while len(heap) > 1:
        _, _, sums, tops = heapq.heappop(heap)
        _, _, others, beside = heapq.heappop(heap)
        both = len(sums) + len(others) - k
        if both > 0:
            # the fullest windows of each take empty ones of the other, the others meet crosswise
            made = np.arange(nodes, nodes + both)
            nodes += both
            mine, yours = len(sums) - both, len(others) - both
            joined.append((made, tops[mine:], beside[yours:][::-1]))
            sums = np.concatenate([sums[:mine], sums[mine:] + others[yours:][::-1], others[:yours]])
            tops = np.concatenate([tops[:mine], made, beside[:yours]])
        else:
            sums, tops = np.concatenate([sums, others]), np.concatenate([tops, beside])
        down = np.argsort(-sums, kind="stable")
        sums, tops = sums[down], tops[down]
        imbalance = int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)
        heapq.heappush(heap, (-imbalance, turn, sums, tops))
        turn += 1
    window = np.zeros(nodes, dtype=np.int64)
    if heap:
        window[heap[0][3]] = np.arange(len(heap[0][3]))
    for made, left, right in reversed(joined):
        window[left] = window[right] = window[made]
    return window[: len(sizes)]


def _bundles(sizes: np.ndarray) -> np.ndarray:
    """The bundle of each item: items below LEAST_ITEM in a row share one until it is large."""
    small = sizes < LEAST_ITEM
    found = np.empty(len(sizes), dtype=np.int64)
    found[~small] = np.arange(np.count_nonzero(~small))
    numbers = (np.cumsum(sizes[small]) - sizes[small]) // LEAST_ITEM
    found[small] = np.count_nonzero(~small) + np.unique(numbers, return_inverse=True)[1]
    return found


def pack(sizes: Sequence[int], capacity: int = CAPACITY, spare: float = SPARE) -> list[list[tuple[int, int, int]]]:
    """Windows of pieces (item, begin, length) of items with these sizes, none above ``capacity``."""
    if not len(sizes):
        return []
    sizes = np.asarray(sizes, dtype=np.int64)
    bundle = _bundles(sizes)
    large = np.bincount(bundle, weights=sizes).astype(np.int64)
    least = -(-int(sizes.sum()) // capacity)
    k, most = least, least + int(least * spare)
    while True:
        window = differencing(large, k)
        if np.bincount(window, weights=large).max() <= capacity or k >= most:
            break
        k += 1
    windows: list[list[tuple[int, int, int]]] = [[] for _ in range(k)]
    for item, (w, size) in enumerate(zip(window[bundle].tolist(), sizes.tolist(), strict=True)):
        windows[w].append((item, 0, size))
    return _trim(windows, capacity)


def _trim(windows: list[list[tuple[int, int, int]]], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Cut what exceeds a window off its last pieces, and put it where there is room."""
    excess, rooms = [], []
    for pieces in windows:
        over = sum(p[2] for p in pieces) - capacity
        if over < 0:
            rooms.append((pieces, -over))
        while over > 0:
            item, begin, length = pieces.pop()
            cut = min(over, length)
            if cut < length:
                pieces.append((item, begin, length - cut))
            excess.append((item, begin + length - cut, cut))
            over -= cut
    for item, begin, length in excess:
        while length:
            pieces, room = rooms.pop()
            part = min(room, length)
            pieces.append((item, begin, part))
            begin, length, room = begin + part, length - part, room - part
            if room:
                rooms.append((pieces, room))
    return windows


class _Rows:
    """Columns of pieces; a piece without a sequence carries its ids on."""

    def __init__(self):
        self.columns: list[list] = [[] for _ in range(8)]

    def add(self, key, start: int, ids: bytes, tokens: int, sequence: int | None, offset: int | None) -> None:
        crc = zlib.crc32(ids) if sequence is not None else None
        row = (key, start, len(ids) // 4, crc, tokens, sequence, offset, ids if sequence is None else None)
        for column, value in zip(self.columns, row, strict=True):
            column.append(value)

    def taken(self, schema: pa.Schema) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(self.columns, schema, strict=False)]
        self.__init__()
        return pa.RecordBatch.from_arrays(arrays, schema=schema)


#: An item: the document's key, where it starts there, its ids, the document's number of ids.
_Item = tuple[object, int, bytes, int]


def _sequences(items: list[_Item], capacity: int, sequence: Iterator[int], rows: _Rows) -> None:
    for pieces in pack([len(item[2]) // 4 for item in items], capacity):
        number, offset = next(sequence), 0
        for at, begin, length in pieces:
            key, start, ids, tokens = items[at]
            rows.add(key, start + begin, ids[4 * begin : 4 * (begin + length)], tokens, number, offset)
            offset += length


def _first(items: list[_Item], tokens: int) -> tuple[list[_Item], list[_Item]]:
    """Items of exactly so many ids in all, and the rest; at most one item is cut."""
    for n, (key, start, ids, whole) in enumerate(items):
        size = len(ids) // 4
        if size >= tokens:
            head = [(key, start, ids[: 4 * tokens], whole)] if tokens else []
            tail = [(key, start + tokens, ids[4 * tokens :], whole)] if size > tokens else []
            return items[:n] + head, tail + items[n + 1 :]
        tokens -= size
    return items, []


def pack_documents(
    docs: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", end: int = 2, capacity: int = CAPACITY
) -> DataFrame:
    """Pieces of all documents, each id in one of them: ``key``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``.

    A document is its text's ids by ``tokenizer`` (the content of a tokenizer file) and ``end``;
    a null or empty text is ``end`` alone. Sequences have at most ``capacity`` ids, without a gap;
    their numbers are not consecutive. Repeated rows, and rows with equal or null keys, are
    documents of their own. An empty table has no sequences; other columns are not read.

    Documents are packed where they are read, so nothing is shuffled but less than one window
    of each task; a task repeated after a loss reads its rows in the same order, if ``docs`` is
    a table scan with narrow steps.
    """
    spark = docs.sparkSession
    kind = docs.schema[key].dataType.simpleString()
    columns = f"`{key}` {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    packed = _parse_datatype_string(f"{columns}, ids binary, part int")
    final = _parse_datatype_string(columns)
    packed_arrow, final_arrow = to_arrow_schema(packed), to_arrow_schema(final)
    shared = spark.sparkContext.broadcast(tokenizer)
    last = array("I", [end]).tobytes()
    block = BLOCK_WINDOWS * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        sequence = iter(range(part << 33, part + 1 << 33))
        encode, rows, items, waiting = encoder(shared.value).encode, _Rows(), [], 0

        def handed_on() -> pa.RecordBatch:
            rows.columns[8:] = [[part] * len(rows.columns[0])]
            return rows.taken(packed_arrow)

        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for begin, stop in slices(texts):
                for owner, ids in zip(keys[begin:stop], encode(texts[begin:stop]), strict=True):
                    ids += last
                    tokens = len(ids) // 4
                    whole = tokens // capacity * capacity
                    for at in range(0, whole, capacity):
                        rows.add(owner, at, ids[4 * at : 4 * (at + capacity)], tokens, next(sequence), 0)
                    if whole < tokens:
                        items.append((owner, whole, ids[4 * whole :], tokens))
                        waiting += tokens - whole
                if waiting >= block:
                    windows = waiting // capacity
                    full, items = _first(items, windows * capacity)
                    waiting -= windows * capacity
                    _sequences(full, capacity, sequence, rows)
                if rows.columns[0]:
                    yield handed_on()
        full, items = _first(items, waiting // capacity * capacity)
        _sequences(full, capacity, sequence, rows)
        for owner, start, ids, tokens in items:
            rows.add(owner, start, ids, tokens, None, None)
        yield handed_on()

    def pack_rests(rests: pa.Table) -> pa.Table:
        table = rests.sort_by([("part", "ascending"), ("at", "ascending")])
        items = list(zip(*(table.column(c).to_pylist() for c in (key, "start", "ids", "doc_tokens")), strict=True))
        group = table.column("part")[0].as_py() // RESTS
        rows = _Rows()
        _sequences(items, capacity, iter(range(1 << 62 | group << 33, 1 << 62 | group + 1 << 33)), rows)
        return pa.Table.from_batches([rows.taken(final_arrow)])

    source = docs.select(docs[key], docs[text].cast("string").alias("_text"))
    pieces = staged(map_arrow(source, run, packed), "pieces")
    ship(spark)
    rests = (
        pieces.where("sequence_id IS NULL")
        .select(key, "start", "ids", "doc_tokens", "part", F.monotonically_increasing_id().alias("at"))
        .groupBy(F.floor(F.col("part") / RESTS).alias("group"))
        .applyInArrow(pack_rests, final)
    )
    return pieces.where("sequence_id IS NOT NULL").select(*final.fieldNames()).unionByName(rests)
