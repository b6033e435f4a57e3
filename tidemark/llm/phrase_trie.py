"""Collocations of two to four words, counted in HAT-tries.

A task counts phrases in a trie of word ids: below a shallow trie lie hash containers, and
a container that fills up bursts, which gives its frequent next words containers of their
own. When a task's trie is full, its largest subtrees leave it whole, as runs of phrases in
sorted order. Runs are dealt out by language and prefix (a phrase's first two words) and
merged there.

Words and pairs are counted first. A phrase is never more frequent than a pair in it, so
the second pass leaves out phrases with a rare pair, which a filter of fixed size answers:
it may let rare pairs through, which costs time, but never holds a frequent one back.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.frames import map_arrow
from tidemark.sources.tables import staged

#: Bytes of text of one language that are cut into words at a time.
BLOCK = 2 << 20
#: Phrases that a hash container holds before it bursts, and how many of one next word make
#: that word a container of its own.
BURST, OWN = 16_384, 256
#: Levels of the trie above its containers.
DEPTH = 2
#: Phrases that a task's trie holds, and bytes of distinct words that it knows, before runs leave it.
MOST_PHRASES, MOST_WORD_BYTES = 1_000_000, 48 << 20
#: Bits of the filter of frequent pairs: 4 MB, whatever the size of the corpus.
FILTER_BITS = 25
#: Shares of a language's phrases that are ranked apart first.
_SHARES = 64

# What ends a piece, and what stands between words.
_ENDS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_UPPER, _LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
_PLAIN = bytes.maketrans(_UPPER + _ENDS + _BLANKS, _LOWER + b"\n" * len(_ENDS) + b" " * len(_BLANKS))
_WIDTH = 32
_LOW = (1 << _WIDTH) - 1
_MOST_WORDS = 4  # of a phrase
_NO_WORD = 2  # ids below are the end of a piece and the empty word


class Container:
    """A hash container with, once it has burst, a trie node's children beside it.

    A phrase is its word ids in one integer, the first one lowest, 32 bits each.
    """

    __slots__ = ("counts", "children", "limit", "depth")

    def __init__(self, depth: int = 0):
        self.counts: dict[int, int] = {}
        self.children: dict[int, Container] = {}
        self.limit, self.depth = BURST, depth

    def add(self, phrase: int, n: int) -> None:
        node = self
        while (below := node.children.get(phrase & _LOW)) is not None:
            node, phrase = below, phrase >> _WIDTH
        counts = node.counts
        counts[phrase] = counts.get(phrase, 0) + n
        if len(counts) > node.limit:
            node.burst()

    def add_all(self, phrases: list[int], times: list[int]) -> None:
        """:meth:`add` for many phrases; containers burst when all are in."""
        counts, children = self.counts, self.children
        grown: dict[int, Container] = {}
        for phrase, n in zip(phrases, times, strict=True):
            below = children.get(first := phrase & _LOW)
            if below is None:
                counts[phrase] = counts.get(phrase, 0) + n
            elif below.children:
                below.add(phrase >> _WIDTH, n)
            else:
                rest = phrase >> _WIDTH
                own = below.counts
                own[rest] = own.get(rest, 0) + n
                if len(own) > below.limit:
                    grown[first] = below
        for node in (*grown.values(), self):
            if len(node.counts) > node.limit:
                node.burst()

    def burst(self) -> None:
        """Give each frequent next word a container; rarer words stay in this one."""
        counts = self.counts
        if self.depth < DEPTH:
            longer = [phrase & _LOW for phrase in counts if phrase >> _WIDTH]
            words, n = np.unique(np.array(longer, dtype=np.int64), return_counts=True)
            made = {word: Container(self.depth + 1) for word in words[n >= OWN].tolist()}
            if made:
                # the word alone, if it was counted, lies below too, as no further word
                for phrase in [phrase for phrase in counts if phrase & _LOW in made]:
                    made[phrase & _LOW].counts[phrase >> _WIDTH] = counts.pop(phrase)
                self.children |= made
        self.limit = max(BURST, 2 * len(self.counts))

    def __len__(self) -> int:
        return len(self.counts) + sum(map(len, self.children.values()))

    def hashes(self, before: tuple[int, ...] = ()) -> Iterator[tuple[tuple[int, ...], dict[int, int]]]:
        """Every hash container with the words that lead to it."""
        if self.counts:
            yield before, self.counts
        for word, below in self.children.items():
            yield from below.hashes((*before, word))


class Words(dict):
    """Ids of words in order of appearance."""

    def __init__(self):
        super().__init__({b"\n": 0, b"": 1})
        self.size = 0
        self._hashes = np.zeros(2, dtype=np.uint64)

    def __missing__(self, word: bytes) -> int:
        made = self[word] = len(self)
        self.size += len(word)
        return made

    def hashes(self) -> np.ndarray:
        """A hash of each word, which is the same everywhere."""
        new = map(xxhash.xxh3_64_intdigest, islice(self, len(self._hashes), None))
        self._hashes = np.concatenate((self._hashes, np.fromiter(new, np.uint64)))
        return self._hashes


def _pair_places(first: np.ndarray, second: np.ndarray, lang: str, bits: int) -> np.ndarray:
    """Places in the filter of pairs, from the hashes of their words."""
    mixed = first * np.uint64(0x9E3779B97F4A7C15) + second + np.uint64(xxhash.xxh3_64_intdigest(lang))
    mixed ^= mixed >> np.uint64(29)
    return (mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)


def _blocks(text: bytes, most: int) -> Iterator[bytes]:
    """``text`` cut at ends of pieces into blocks of about ``most`` bytes."""
    begin = 0
    while len(text) - begin > most:
        cut = text.rfind(b"\n", begin, begin + most)
        if cut < 0 and (cut := text.find(b"\n", begin + most)) < 0:
            break
        yield text[begin:cut]
        begin = cut + 1
    yield text[begin:]


class Counting:
    """Counts phrases of one task's texts and gives runs of (lang, prefix, rest, n)."""

    def __init__(self, pairs: np.ndarray | None = None, bits: int = 0):
        self.pairs, self.bits = pairs, bits
        self.words: dict[str, Words] = {}
        self.tries: dict[str, Container] = {}

    def take(self, lang: str, block: bytes) -> None:
        """Count one block of pieces, lower-cased and with ``\\n`` between them."""
        words = self.words.setdefault(lang, Words())
        trie = self.tries.setdefault(lang, Container())
        found = block.replace(b"\n", b" \n ").split(b" ")
        ids = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
        ids = ids[ids != 1]
        inside = ids >= _NO_WORD
        if self.pairs is None:
            self._words_and_pairs(trie, ids, inside)
        else:
            self._longer(trie, ids, inside, lang)

    @staticmethod
    def _words_and_pairs(trie: Container, ids: np.ndarray, inside: np.ndarray) -> None:
        every, n = np.unique(ids[inside], return_counts=True)
        trie.add_all(every.tolist(), n.tolist())
        both = inside[:-1] & inside[1:]
        pairs = ids[:-1][both] | ids[1:][both] << np.uint64(_WIDTH)
        every, n = np.unique(pairs, return_counts=True)
        trie.add_all(every.tolist(), n.tolist())

    def _longer(self, trie: Container, ids: np.ndarray, inside: np.ndarray, lang: str) -> None:
        hashes = self.words[lang].hashes()[ids]
        both = inside[:-1] & inside[1:]
        places = _pair_places(hashes[:-1], hashes[1:], lang, self.bits)
        known = both & (self.pairs[places >> np.uint64(3)] >> (places & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
        starts = np.flatnonzero(known[:-1] & known[1:])
        # equal beginnings get one number, so that it and the next word fit into one integer
        keys = ids[starts] | ids[starts + 1] << np.uint64(_WIDTH)
        for size in (3, 4):
            _, numbers = np.unique(keys, return_inverse=True)
            keys = numbers.astype(np.uint64) << np.uint64(_WIDTH) | ids[starts + size - 1]
            _, first, n = np.unique(keys, return_index=True, return_counts=True)
            columns = [ids[starts[first] + i].tolist() for i in range(size)]
            phrases = [reduce(lambda low, word: low << _WIDTH | word, reversed(p)) for p in zip(*columns, strict=True)]
            trie.add_all(phrases, n.tolist())
            further = starts + size - 1 < len(known)
            further[further] = known[starts[further] + size - 1]
            starts, keys = starts[further], keys[further]

    def full(self) -> bool:
        known = sum(w.size + 100 * len(w) for w in self.words.values())
        return known > MOST_WORD_BYTES or sum(map(len, self.tries.values())) > MOST_PHRASES

    def runs(self, everything: bool) -> Iterator[pa.RecordBatch]:
        """Subtrees leave the trie, the largest first: all, or until half of the room is free."""
        if sum(w.size + 100 * len(w) for w in self.words.values()) > MOST_WORD_BYTES:
            everything = True
        left = sum(map(len, self.tries.values()))
        below = [
            (len(child), lang, word) for lang, trie in self.tries.items() for word, child in trie.children.items()
        ]
        leaving: dict[str, list] = {}
        for size, lang, word in sorted(below, reverse=True):
            if everything or left > MOST_PHRASES // 2:
                leaving.setdefault(lang, []).extend(self.tries[lang].children.pop(word).hashes((word,)))
                left -= size
        whole = {lang for lang in list(self.tries) if everything or left > MOST_PHRASES // 2}
        for lang in whole:
            leaving.setdefault(lang, []).extend(self.tries.pop(lang).hashes())
        for lang, containers in leaving.items():
            yield from self._run(lang, containers)
        for lang in whole:
            del self.words[lang]

    def _run(self, lang: str, containers: list[tuple[tuple[int, ...], dict[int, int]]]) -> Iterator[pa.RecordBatch]:
        """The phrases of ``containers`` in the order of their words, cut after the second word."""
        if not containers:
            return
        known = self.words[lang]
        table = pa.array(known, pa.binary()).cast(pa.string())
        place = np.empty(len(known) + 1, dtype=np.int64)
        place[sorted(range(len(known)), key=list(known).__getitem__)] = np.arange(1, len(known) + 1)
        place[-1] = 0  # no word
        columns: list[list[np.ndarray]] = [[] for _ in range(_MOST_WORDS)]
        for before, phrases in containers:
            for n, column in enumerate(columns):
                if n < len(before):
                    column.append(np.full(len(phrases), before[n], dtype=np.int64))
                elif self.pairs is None:
                    # at most two words: 64 bits
                    if n == len(before):
                        keys = np.fromiter(phrases, np.uint64, len(phrases))
                    column.append((keys & np.uint64(_LOW)).astype(np.int64))
                    keys = keys >> np.uint64(_WIDTH)
                else:
                    shift = _WIDTH * (n - len(before))
                    column.append(np.array([k >> shift & _LOW for k in phrases], dtype=np.int64))
        counts = [np.fromiter(phrases.values(), np.int64, len(phrases)) for _, phrases in containers]
        ids = np.stack([np.concatenate(c) for c in columns])
        ids[ids == 0] = -1
        order = np.lexsort(place[ids][::-1])
        n = np.concatenate(counts)
        for begin in range(0, len(order), 1 << 17):
            at = order[begin : begin + (1 << 17)]
            prefix, rest = (self._joined(table, ids[i : i + 2, at]) for i in (0, 2))
            langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(at), dtype=np.int32)))
            yield pa.RecordBatch.from_arrays([langs, prefix, rest, pa.array(n[at])], ["lang", "prefix", "rest", "n"])

    @staticmethod
    def _joined(table: pa.Array, ids: np.ndarray) -> pa.Array:
        """Two words each, with a blank between them where there is a second one."""
        words = [pc.fill_null(table.take(pa.array(i, mask=i < 0)), "") for i in ids]
        between = pa.array(["", " "]).take(pa.array((ids[1] >= 0).astype(np.int32)))
        return pc.binary_join_element_wise(*words, between)


def _merged(docs: DataFrame, text: str, lang: str, pairs=None, bits: int = 0) -> DataFrame:
    """Counts of phrases over all texts: runs of every task, merged per prefix."""
    source = docs.select(
        F.coalesce(docs[lang].cast("string"), F.lit("und")).alias("_lang"), docs[text].cast("string").alias("_text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(None if pairs is None else np.frombuffer(pairs.value, dtype=np.uint8), bits)
        waiting: dict[str, list[bytes]] = {}
        sizes: dict[str, int] = {}

        def counted(lang: str) -> Iterator[pa.RecordBatch]:
            sizes[lang] = 0
            for block in _blocks(b"\n".join(waiting.pop(lang)), BLOCK):
                counting.take(lang, block)
                if counting.full():
                    yield from counting.runs(everything=False)

        for batch in batches:
            for lang, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                plain = (content.as_py() or "").encode().translate(_PLAIN)
                waiting.setdefault(lang, []).append(plain)
                sizes[lang] = sizes.get(lang, 0) + len(plain)
                if sizes[lang] >= BLOCK or len(waiting) > 64:
                    for one in [lang] if len(waiting) <= 64 else list(waiting):
                        yield from counted(one)
        for lang in list(waiting):
            yield from counted(lang)
        yield from counting.runs(everything=True)

    runs = map_arrow(source, run, "lang string, prefix string, rest string, n long")
    merged = runs.repartition("lang", "prefix").groupBy("lang", "prefix", "rest").agg(F.sum("n").alias("f"))
    phrase = F.when(F.col("rest") == "", F.col("prefix")).otherwise(F.concat_ws(" ", "prefix", "rest"))
    return merged.select("lang", phrase.alias("phrase"), "f")


def _pair_filter(pairs: DataFrame, bits: int) -> bytes:
    """The filter of ``bits`` bits that holds every pair; its words are put together by Spark
    and only they, at most two to the power of ``bits - 6``, come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang in set(batch.column(0).to_pylist()):
                mine = batch.filter(pa.array([x == lang for x in batch.column(0).to_pylist()]))
                split = [p.encode().split(b" ") for p in mine.column(1).to_pylist()]
                first, second = (
                    np.array([xxhash.xxh3_64_intdigest(p[i]) for p in split], dtype=np.uint64) for i in (0, 1)
                )
                places = _pair_places(first, second, lang, bits)
                words = pa.array((places >> np.uint64(6)).astype(np.int64))
                masks = pa.array((np.uint64(1) << (places & np.uint64(63))).view(np.int64))
                yield pa.RecordBatch.from_arrays([words, masks], ["word", "mask"])

    found = (
        map_arrow(pairs.select("lang", "phrase"), run, "word long, mask long")
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .toArrow()
    )
    whole = np.zeros(1 << (bits - 6), dtype="<i8")
    whole[found["word"].to_numpy()] = found["mask"].to_numpy()
    return whole.tobytes()


def _n_words(phrase: Column) -> Column:
    return F.length(phrase) - F.length(F.replace(phrase, F.lit(" "), F.lit(""))) + 1


def phrase_counts(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 30, filter_bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """``lang``, ``phrase``, ``f``, ``words`` of all phrases of one to four words that occur at
    least ``least`` times in their language, and ``lang``, ``n``, the words of each language.

    Pieces end at ``.,;:!?`` and line ends, words at blanks and tabs; A-Z are lower-cased.
    """
    short = _merged(docs, text, lang).withColumn("words", _n_words(F.col("phrase")))
    short = staged(short.where((F.col("f") >= least) | (F.col("words") == 1)), "short-phrases")
    totals = short.where("words = 1").groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = short.where(F.col("f") >= least)
    pairs = docs.sparkSession.sparkContext.broadcast(_pair_filter(frequent.where("words = 2"), filter_bits))
    longer = _merged(docs, text, lang, pairs, filter_bits).where(F.col("f") >= least)
    longer = staged(longer.withColumn("words", _n_words(F.col("phrase"))), "frequent-long")
    return frequent.unionByName(longer), totals


def _sub_phrase(begin: Column, size: Column) -> Column:
    return F.array_join(F.slice("_words", begin, size), " ")


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 30,
    top: int = 2000,
    covered: tuple[int, int] = (80, 100),
    scale: int = 2_000_000,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """Per language the ``top`` phrases of two to four words: ``lang``, ``rank``, ``phrase``,
    ``a``, ``l``, ``r``, ``n``, ``score``.

    ``a`` is how often a phrase occurs, ``least`` at least; ``l`` and ``r`` how often its parts
    do, cut where ``score = floor(scale * a / (l + r))`` is lowest (ties: the earliest cut); ``n``
    counts the words of the language. A phrase inside a longer one that makes up at least
    ``covered`` of its occurrences is left out. Ranks go by score, then ``a``, then the bytes of the
    phrase, so there are no ties. A null language is ``und``, null texts are empty, repeated
    rows count again, an empty table gives no rows; other columns are not read.
    """
    counts, totals = phrase_counts(docs, text, lang, least, filter_bits)
    phrases = counts.where("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))
    known = counts.select("lang", F.col("phrase").alias("part"), "f")
    split = phrases.withColumn("_words", F.split("phrase", " ", -1))
    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang",
        "phrase",
        "words",
        "a",
        "k",
        _sub_phrase(F.lit(1), F.col("k")).alias("first"),
        _sub_phrase(F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"),
    )
    cuts = cuts.join(known.withColumnsRenamed({"part": "first", "f": "l"}), ["lang", "first"])
    cuts = cuts.join(known.withColumnsRenamed({"part": "rest", "f": "r"}), ["lang", "rest"])
    whole = "decimal(20,0)"  # products leave 64 bits
    score = F.expr(f"CAST(a AS {whole}) * CAST({scale} AS DECIMAL(10,0)) DIV (CAST(l AS {whole}) + CAST(r AS {whole}))")
    scored = (
        cuts.groupBy("lang", "phrase", "a")
        .agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    )
    inner = (
        split.where("words >= 3")
        .withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
        .select("lang", _sub_phrase(F.col("at"), F.col("size")).alias("phrase"), "a")
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longer"))
    )
    share, of = covered
    open_ = scored.join(inner, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * of < F.col("a") * share)
    )
    order = F.col("score").desc(), F.col("a").desc(), F.col("phrase")
    # the best of each of some shares first, so that no task sorts a whole language
    shares = Window.partitionBy("lang", "_share").orderBy(*order)
    best = (
        open_.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(_SHARES)))
        .withColumn("_n", F.row_number().over(shares))
        .where(F.col("_n") <= top)
    )
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def oracle(least: int = 30, top: int = 2000) -> str:
    """The same rows in DuckDB."""
    return f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER.decode()}', '{_LOWER.decode()}'), '[.,;:!?\\x0A-\\x0D]')) AS p
  FROM documents),
line AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w FROM piece),
gram AS (
  SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
  FROM line, range(1, 5) AS sizes(m) WHERE len(w) >= m),
f AS (SELECT lang, phrase, m, count(*) AS f FROM gram GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM f WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, m, f AS a, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND f >= {least}),
cut AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, m)) AS k FROM cand)),
scored AS (
  SELECT c.lang, c.phrase, c.a, x.f AS l, y.f AS r, c.k,
    (2000000::HUGEINT * c.a) // (x.f + y.f)::HUGEINT AS score
  FROM cut c JOIN f x ON x.lang = c.lang AND x.phrase = c.first JOIN f y ON y.lang = c.lang AND y.phrase = c.rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM cand))
  GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase)::BIGINT AS rank,
  b.phrase, b.a, b.l, b.r, t.n::BIGINT AS n, b.score::BIGINT AS score
FROM best b JOIN total t ON t.lang = b.lang LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
WHERE i.longer IS NULL OR 100 * i.longer < 80 * b.a
QUALIFY rank <= {top}"""
