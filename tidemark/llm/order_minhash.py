"""Near duplicates by order MinHash and banded alignment.

A sketch of a text samples the two k-mers of words with the smallest hashes, each labelled
with its occurrence number, and keeps them in text order. Texts that agree on a sketch
are candidates; an alignment within a band decides. Copies are joined before all this.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from tidemark.llm.components import components
from tidemark.llm.frames import map_arrow, map_texts
from tidemark.sources.tables import staged

WORDS = 5  # of a k-mer
#: Texts that share the part J of their k-mers agree on a sketch with probability J ** SAMPLED.
#: With words changed here and there, an alignment of 0.9 leaves J = 0.42, one of 0.85 J = 0.29,
#: one of 0.8 J = 0.2: of such pairs 1 in 10 ** 5, 4 in 1,000 and 8 in 100 agree on none.
SAMPLED, SKETCHES = 2, 64
LEAST = 0.8  # 1 - edits of words / words of the longer text
#: Members of a bucket that gives all their pairs.
SMALL = 12
#: Rare words that two texts in large buckets share before they are compared.
COMMON = 4
#: Counters of words by which rare ones are told from frequent ones.
COUNTERS = 1 << 17

_RANDOM = np.random.default_rng(20)
_TIMES = _RANDOM.integers(1, 1 << 63, SKETCHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _RANDOM.integers(1, 1 << 63, SKETCHES, dtype=np.uint64)
_PLACES = _RANDOM.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_COLUMNS = 1 << 15  # k-mers hashed at a time


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def word_hashes(text: str) -> tuple[np.ndarray, bytes]:
    """64-bit hashes of the lower-cased words between ASCII white space, and of all of them."""
    words = text.lower().encode("utf-8", "surrogatepass").split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    return hashes, xxhash.xxh3_128_digest(b" ".join(words))


def sketch(hashes: np.ndarray) -> list[int] | None:
    """One 64-bit value for each sketch; None for texts too short for a k-mer."""
    n = len(hashes) - WORDS + 1
    if n < 1:
        return None
    kmers = np.zeros(n, np.uint64)
    for place in range(WORDS):
        kmers += hashes[place : place + n] * _PLACES[place]
    kmers = _mix(kmers)
    order = np.argsort(kmers, kind="stable")
    same = np.concatenate(([False], np.diff(kmers[order]) == 0))
    if same.any():
        run = np.arange(n) - np.maximum.accumulate(np.where(same, 0, np.arange(n)))
        later = order[run > 0]  # a first occurrence keeps its hash
        kmers[later] = _mix(kmers[later] + run[run > 0].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    best = np.zeros((SKETCHES, 0), np.uint64)
    where = np.zeros((SKETCHES, 0), np.int64)
    rows = np.arange(SKETCHES)
    for begin in range(0, n, _COLUMNS):
        values = kmers[None, begin : begin + _COLUMNS] * _TIMES[:, None] + _PLUS[:, None]
        for _ in range(min(SAMPLED, values.shape[1])):
            at = values.argmin(1)
            best = np.column_stack((best, values[rows, at]))
            where = np.column_stack((where, at + begin))
            values[rows, at] = np.iinfo(np.uint64).max
        least = np.argsort(best, 1, kind="stable")[:, :SAMPLED]
        best, where = best[rows[:, None], least], where[rows[:, None], least]
    where.sort(1)
    made = _PLUS.copy()
    for column in kmers[where].T:
        made = _mix(made * _TIMES + column)
    return made.view(np.int64).tolist()


def sketches(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``copy`` (a digest of the words, null without words) and ``sketch``."""

    def make():
        def work(keys: list, texts: list[str]) -> dict[str, list]:
            both = [word_hashes(t) for t in texts]
            return {
                key: keys,
                "copy": [d if len(h) else None for h, d in both],
                "sketch": [sketch(h) for h, _ in both],
            }

        return work

    return map_texts(df, key, text, "copy binary, sketch array<long>", make)


def word_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and ``words``, 32 bits of each word's hash."""

    def make():
        def work(keys: list, texts: list[str]) -> dict[str, list]:
            return {key: keys, "words": [(word_hashes(t)[0] >> np.uint64(32)).astype("<u4").tobytes() for t in texts]}

        return work

    return map_texts(df, key, text, "words binary", make)


def _trim(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Without their common start and end."""
    n = min(len(a), len(b))
    apart = np.flatnonzero(a[:n] != b[:n])
    start = int(apart[0]) if len(apart) else n
    a, b = a[start:], b[start:]
    n = min(len(a), len(b))
    apart = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    end = int(apart[0]) if len(apart) else n
    return a[: len(a) - end], b[: len(b) - end]


def _apart(a: np.ndarray, b: np.ndarray) -> int:
    """Edits needed at least, from how often each word occurs in both."""
    words, inverse = np.unique(np.concatenate((a, b)), return_inverse=True)
    left = np.bincount(inverse[: len(a)], minlength=len(words))
    right = np.bincount(inverse[len(a) :], minlength=len(words))
    return max(len(a), len(b)) - int(np.minimum(left, right).sum())


def _band(pairs: list[tuple[np.ndarray, np.ndarray]], width: int) -> np.ndarray:
    """Edit distances where they are at most ``width``, something larger elsewhere.

    Rows of all pairs are filled together, cells more than ``width`` off the diagonal left out.
    """
    far = 1 << 29
    lengths = np.array([len(a) for a, _ in pairs])
    order = np.argsort(-lengths, kind="stable")
    rows, cols = int(lengths.max()), max(len(b) for _, b in pairs)
    left = np.zeros((len(pairs), rows), np.int64)
    right = np.full((len(pairs), max(cols, rows) + 2 * width + 1), -1, np.int64)
    ends = np.empty(len(pairs), np.int64)
    for slot, at in enumerate(order):
        a, b = pairs[at]
        left[slot, : len(a)] = a
        right[slot, width : width + len(b)] = b
        ends[slot] = len(b) - len(a) + width  # beyond the band where the lengths differ more
    steps = np.arange(2 * width + 1, dtype=np.int32)
    cells = np.tile(np.where(steps >= width, steps - width, far).astype(np.int32), (len(pairs), 1))
    result = np.full(len(pairs), far, np.int64)
    running = len(pairs)
    heights = lengths[order]
    for i in range(rows + 1):
        while running and heights[running - 1] == i:
            running -= 1
            if 0 <= ends[running] <= 2 * width:
                result[order[running]] = cells[running, ends[running]]
        if not running:
            break
        cells = cells[:running]
        new = cells + (right[:running, i : i + 2 * width + 1] != left[:running, i, None])
        np.minimum(new[:, :-1], cells[:, 1:] + 1, out=new[:, :-1])
        if i < width:
            new[:, : width - i - 1] = far  # left of the first column
        new -= steps
        np.minimum.accumulate(new, 1, out=new)
        cells = new + steps
    return result


def similarities(pairs: list[tuple[np.ndarray, np.ndarray]], least: float) -> list[float | None]:
    """1 - edits / words of the longer text where that is ``least`` or more, else None."""
    result: list[float | None] = [None] * len(pairs)
    open_, whole, most = [], {}, {}
    for n, (a, b) in enumerate(pairs):
        longer = max(len(a), len(b))
        most[n] = int((1 - least) * longer + 1e-9)
        if abs(len(a) - len(b)) > most[n] or _apart(a, b) > most[n]:
            continue
        whole[n] = longer
        a, b = _trim(a, b)
        if min(len(a), len(b)) == 0:
            if max(len(a), len(b)) <= most[n]:
                result[n] = 1 - max(len(a), len(b)) / max(longer, 1)
        else:
            open_.append((n, a, b))
    width = 16
    while open_:
        open_.sort(key=lambda p: len(p[1]))
        left, begin = [], 0
        while begin < len(open_):
            end, cells = begin, 0
            while end < len(open_) and (end == begin or cells + len(open_[end][2]) < 1 << 18):
                cells += len(open_[end][2]) + 2 * width
                end += 1
            for (n, a, b), edits in zip(
                open_[begin:end], _band([p[1:] for p in open_[begin:end]], width).tolist(), strict=True
            ):
                if edits <= min(width, most[n]):
                    result[n] = 1 - edits / whole[n]
                elif edits > width and width < most[n]:
                    left.append((n, a, b))
            begin = end
        # the distance of these is over the width
        open_, width = left, 4 * width
    return result


def aligned(pairs: DataFrame, words: DataFrame, key: str, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough, with their ``similarity``."""
    with_b = pairs.join(words.select(F.col(key).alias("b"), F.col("words").alias("words_b")), "b")
    rows = with_b.join(words.select(F.col(key).alias("a"), F.col("words").alias("words_a")), "a")
    kind = words.schema[key].dataType.simpleString()
    schema = _parse_datatype_string(f"a {kind}, b {kind}, similarity double")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                texts = list(
                    zip(
                        *(
                            [np.frombuffer(x, "<u4").astype(np.int64) for x in part.column(c).to_pylist()]
                            for c in ("words_a", "words_b")
                        ),
                        strict=True,
                    )
                )
                found = pa.array(similarities(texts, least), pa.float64())
                columns = [part.column("a"), part.column("b"), found]
                kept = found.is_valid()
                yield pa.RecordBatch.from_arrays([c.filter(kept) for c in columns], schema=arrow)

    return map_arrow(rows.select("a", "b", "words_a", "words_b"), run, schema)


def _most(longer: int, least: float) -> int:
    """Edits that two linked texts may need."""
    return int((1 - least) * longer + 1e-9)


def _tokens(words: bytes) -> np.ndarray:
    """A different 64-bit value for each occurrence of each word."""
    ordered = np.sort(np.frombuffer(words, "<u4").astype(np.uint64))
    places = np.arange(len(ordered))
    begins = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    nth = (places - np.maximum.accumulate(np.where(begins, places, 0))).astype(np.uint64)
    return _mix(ordered * np.uint64(0x9E3779B97F4A7C15) + nth * np.uint64(0xD6E8FEB86659FD93))


def _counter(tokens: np.ndarray) -> np.ndarray:
    return (tokens % np.uint64(COUNTERS)).astype(np.int64)


def _counts(texts: DataFrame) -> np.ndarray:
    """How often the words of each counter occur in ``words``; a table of fixed size."""
    schema = _parse_datatype_string("counter int, n long")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for words in batch.column(0).to_pylist():
                np.add.at(total, _counter(_tokens(words)), 1)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(total[used])], schema=arrow)

    sums = map_arrow(texts.select("words"), run, schema).groupBy("counter").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(COUNTERS, np.int64)
    counts[sums.column("counter").to_numpy()] = sums.column("n").to_numpy()
    return counts


def alike(texts: DataFrame, least: float = LEAST) -> DataFrame:
    """Pairs (a, b) of the rows (node, root, words) whose roots differ, all that can be linked
    among them.

    Texts of at least ``WORDS`` words that are linked have all but ``_most`` of the longer one's
    words in common. So of that number and ``COMMON`` more of each one's words, taken in one order
    for all, ``COMMON`` are common to both; the order goes from rare to frequent words. A pair
    comes from the last of its first ``COMMON`` common words, once.
    """
    common = max(1, min(COMMON, WORDS - _most(WORDS, least)))
    shared = texts.sparkSession.sparkContext.broadcast(_counts(texts))
    kind = texts.schema["node"].dataType.simpleString()
    schema = _parse_datatype_string(f"node {kind}, root {kind}, size int, tokens array<long>")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = shared.value
        for batch in batches:
            sizes, rare = [], []
            for words in batch.column("words").to_pylist():
                tokens = _tokens(words)
                order = np.lexsort((tokens, counts[_counter(tokens)]))
                sizes.append(len(tokens))
                rare.append(tokens[order[: _most(len(tokens), least) + common]].view(np.int64))
            columns = [batch.column("node"), batch.column("root"), pa.array(sizes, pa.int32()), pa.array(rare, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    rare = staged(map_arrow(texts.select("node", "root", "words"), run, schema), "rare-words")
    each = rare.select("node", "root", "size", F.posexplode("tokens").alias("place", "token"))
    # words of one class have nothing to tell
    of_token = Window.partitionBy("token")
    mixed = each.select("*", F.min("root").over(of_token).alias("x"), F.max("root").over(of_token).alias("y")).where("x <> y")
    listed = F.sort_array(F.collect_list(F.struct("place", "token"))).getField("token").alias("tokens")
    told = staged(mixed.groupBy("node", "root", "size").agg(listed), "told-words")
    rows = told.select("node", "root", "size", "tokens", F.posexplode("tokens").alias("place", "token"))
    rows = rows.where(F.col("place") >= common - 1).withColumn("before", F.slice("tokens", F.lit(1), F.col("place")))
    a, b = rows.alias("a"), rows.alias("b")
    longer, shorter = F.greatest("a.size", "b.size"), F.least("a.size", "b.size")
    meet = a.join(
        b,
        (F.col("a.token") == F.col("b.token"))
        & (F.col("a.root") != F.col("b.root"))
        & (F.col("a.node") < F.col("b.node"))
        & (longer - shorter <= F.floor(longer * (1 - least) + 1e-9))
        & (F.size(F.array_intersect("a.before", "b.before")) == common - 1),
    )
    return meet.select(F.col("a.node").alias("a"), F.col("b.node").alias("b"))


def _with_roots(pairs: DataFrame, roots: DataFrame | None) -> DataFrame:
    """Pairs (a, b) with ``root_a`` and ``root_b``, their classes so far."""
    for side in ("a", "b"):
        if roots is None:
            pairs = pairs.withColumn(f"root_{side}", F.col(side))
        else:
            of = roots.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
            pairs = pairs.join(of, side, "left").withColumn(f"root_{side}", F.coalesce(f"root_{side}", side))
    return pairs


def _joined(roots: DataFrame | None, links: DataFrame) -> DataFrame | None:
    """Classes with further links, worked out between classes."""
    between = _with_roots(links.select("a", "b"), roots).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    between = staged(between.where("a <> b").distinct(), "class-links")
    if between.isEmpty():
        return roots
    merged = components(between)
    if roots is None:
        return merged
    moved = roots.join(merged.select(F.col("node").alias("root"), F.col("root").alias("above")), "root", "left")
    alone = merged.join(roots.select("node"), "node", "left_anti")
    return staged(
        moved.select("node", F.coalesce("above", "root").alias("root")).unionByName(alone.select("node", "root")),
        "roots",
    )


def _classes_of(shared: DataFrame, df: DataFrame, key: str, text: str, least: float) -> DataFrame | None:
    """``node`` and ``root`` of the texts with a link, from rows (bucket, node, size)."""
    degrees = shared.groupBy("node").agg(F.sum("size").alias("degree"))
    leads = shared.join(degrees, "node").groupBy("bucket").agg(F.max(F.struct("degree", "node"))["node"].alias("lead"))
    stars = shared.join(leads, "bucket").where("node <> lead").groupBy("lead", "node").agg(F.count("*").alias("times"))
    stars = staged(stars, "stars")
    few = shared.where(F.col("size") <= SMALL).select("bucket", "node")
    other = few.withColumnRenamed("node", "after")
    every = few.join(other, "bucket").where("node < after").select(F.col("node").alias("a"), F.col("after").alias("b"))
    both = F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")
    pairs = staged(stars.select(*both).union(every).distinct(), "pairs")
    needed = shared.select(F.col("node").alias(key)).distinct()
    # the keys grow with the input: one plan at every size, which never broadcasts them
    words = staged(word_rows(df, key, text).join(needed.hint("merge"), key, "left_semi"), "words")
    # most classes are found by the lead that a node meets most often
    best = stars.groupBy("node").agg(F.max_by("lead", F.struct("times", "lead")).alias("lead"))
    tried = staged(best.select(*both).distinct(), "best-pairs")
    roots = _joined(None, staged(aligned(tried, words, key, least), "links"))
    apart = _with_roots(pairs, roots).where("root_a <> root_b").select("a", "b")
    roots = _joined(roots, staged(aligned(apart.join(tried, ["a", "b"], "left_anti"), words, key, least), "links"))
    # the other pairs of large buckets
    large = shared.where(F.col("size") > SMALL).select("bucket", "node")
    if roots is None:
        large = large.withColumn("root", F.col("node"))
    else:
        large = large.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    large = staged(large, "large")
    mixed = large.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y")
    left = large.join(mixed.select("bucket"), "bucket", "left_semi").select("node", "root").distinct()
    left = staged(left.join(words.withColumnRenamed(key, "node"), "node"), "left")
    if left.isEmpty():
        return roots
    return _joined(roots, staged(aligned(staged(alike(left, least), "alike"), left, "node", least), "links"))


def near_classes(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """``key`` and ``class_id``, the smallest key among the texts linked to this one.

    Texts with the same lower-cased words are copies. Other texts are linked if they agree
    on a sketch and their alignment reaches ``least``; classes are the components. A null
    or blank text is alone, a text of fewer than five words only joins its copies. Keys, of any
    type with an order, must be unique; rows whose key is null are classes of their own with a
    null ``class_id``; other columns are not read.

    A bucket of at most ``SMALL`` members gives all their pairs. A larger one has a lead, the
    member that meets most others in all buckets, and gives each member's pair with it. Members
    of large buckets that are still of several classes then meet by their rare words (``alike``),
    which leaves out no pair that can be linked.
    """
    df = df.select(key, text)
    own = staged(sketches(df.where(df[key].isNotNull()), key, text), "sketches")
    firsts = own.where("copy is not null").groupBy("copy").agg(F.min(key).alias("first"))
    copies = own.select(key, "copy").join(firsts, "copy", "left").select(key, F.coalesce("first", key).alias("first"))
    members = staged(copies, "copies")
    kept = own.where("sketch is not null").join(firsts.select(F.col("first").alias(key)), key, "left_semi")
    kept = staged(kept.select(F.col(key).alias("node"), "sketch"), "kept-sketches")
    rows = kept.select("node", F.explode("sketch").alias("bucket"))
    sizes = rows.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    shared = staged(rows.join(sizes, "bucket").select("bucket", "node", "size"), "shared")
    roots = None if shared.isEmpty() else _classes_of(shared, df, key, text, least)
    if roots is None:
        named = members.select(key, F.col("first").alias("class_id"))
    else:
        named = members.join(roots.withColumnRenamed("node", "first"), "first", "left")
        named = named.select(key, F.coalesce("root", "first").alias("class_id"))
    nobody = df.where(df[key].isNull()).select(key, F.col(key).alias("class_id"))
    return named.unionByName(nobody)


def first_of_class(df: DataFrame, key: str = "doc_id", text: str = "text", least: float = LEAST) -> DataFrame:
    """The rows of ``df`` whose key is the smallest of its class, all columns as they are; rows
    without a key stay."""
    rest = near_classes(df, key, text, least).where(F.col("class_id") != F.col(key)).select(key)
    return df.join(rest, key, "left_anti").select(*df.columns)
