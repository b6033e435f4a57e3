"""Spelling variants of the words of a corpus, by PartEnum signatures.

A word's letters are a multiset, which is a binary vector over (letter, occurrence). One
inserted or deleted letter changes one place of it, a replaced letter two. The places are
dealt out to PARTS parts. Vectors that differ in at most two places agree on all parts but
two, those that differ in one on all but one; so each way to leave out two parts (words of
one length) or one part (lengths that differ by one) gives an exact signature, and equal
signatures are an equi-join. As an edit also leaves one half of a word alone, every
signature is taken once with the word's first and once with its last half, which keeps the
groups small and no pair apart. Candidates are verified by their edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.frames import map_arrow
from tidemark.sources.tables import staged

#: Parts that the places of a vector are dealt out to.
PARTS = 4
#: Bytes of distinct words, with their overhead, that a task counts before it hands them on.
KEPT_BYTES = 48 << 20
_ENTRY_BYTES = 120
#: Longer texts are matched run by run instead of as one list.
_LONG = 1 << 20
_MASK = (1 << 64) - 1


def _runs(least: int) -> tuple[re.Pattern, re.Pattern]:
    """Maximal runs of Latin letters in lower-cased UTF-8: of plain texts, and of all others."""
    return re.compile(rb"[a-z]{%d,}" % least), re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf]){%d,}" % least)


def _less_one(run: bytes, h: int) -> bytes:
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def count_words(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_chars: int = 5,
    least_count: int = 3,
    lose_one_in: int | None = None,
) -> DataFrame:
    """``word`` and ``n``: runs of A-Z, a-z and U+00C0 to U+00FF, A-Z lower-cased, of at least
    ``least_chars`` letters and ``least_count`` occurrences.

    With ``lose_one_in``, a run whose crc32 of ``<key>:<run>`` that number divides first loses
    the letter at crc32 modulo its length (as a test of what the grouping brings back). A
    null text has no words; a null key is spelled as nothing. Tasks count before the shuffle.
    """
    plain, latin = _runs(least_chars)
    source = docs.select(docs[key].cast("string").alias("_key"), docs[text].cast("string").alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        held = 0

        def handed_on() -> pa.RecordBatch:
            words = pa.array(counts.keys(), pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([words, pa.array(counts.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for owner, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                letters = (content.as_py() or "").encode().lower()
                runs = plain if letters.isascii() else latin
                if len(letters) < _LONG:
                    own = Counter(runs.findall(letters))
                else:
                    own = Counter(map(re.Match.group, runs.finditer(letters)))
                seed = zlib.crc32(f"{owner or ''}:".encode())
                for run, n in own.items():
                    if lose_one_in and not (h := zlib.crc32(run, seed)) % lose_one_in:
                        run = _less_one(run, h)
                        if len(run.decode()) < least_chars:
                            continue
                    if run in counts:
                        counts[run] += n
                    else:
                        counts[run] = n
                        held += len(run) + _ENTRY_BYTES
                if held > KEPT_BYTES:
                    yield handed_on()
                    counts.clear()
                    held = 0
        yield handed_on()

    parts = map_arrow(source, count, "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


class Signer:
    """Signatures of words; equal on every machine, as all hashes are seeded by content."""

    def __init__(self, parts: int = PARTS):
        self.parts = parts
        self.places: dict[tuple[str, int], tuple[int, int]] = {}
        everyone = range(parts)
        self.less_two = [[p for p in everyone if p not in out] for out in combinations(everyone, 2)]
        self.less_one = [[p for p in everyone if p != out] for out in everyone]

    def place(self, letter: str, nth: int) -> tuple[int, int]:
        found = self.places.get((letter, nth))
        if found is None:
            h = xxhash.xxh3_64_intdigest(f"{letter}{nth}")
            found = (xxhash.xxh3_64_intdigest(f"{nth}{letter}") % self.parts, h)
            if nth <= 32:
                self.places[letter, nth] = found
        return found

    def vector(self, word: str) -> list[int]:
        """Per part, the sum of the hashes of the places that are set."""
        sums = [0] * self.parts
        for letter, n in Counter(word).items():
            for nth in range(1, n + 1):
                part, h = self.place(letter, nth)
                sums[part] += h
        return sums

    @staticmethod
    def _keys(sums: list[int], chosen: list[list[int]], tag: str, halves: tuple[str, str]) -> list[int]:
        made = []
        for side, half in zip("<>", halves, strict=True):
            base = xxhash.xxh3_64_intdigest(f"{tag}{side}{half}")
            for n, parts in enumerate(chosen):
                made.append((sum([sums[p] for p in parts]) + base + n * 0x9E3779B97F4A7C15) & _MASK)
        return made

    def signatures(self, word: str) -> tuple[list[int], list[int]]:
        """What a word is found by as the one that has no more letters, and as the other."""
        size, sums = len(word), self.vector(word)
        half, less = size // 2, (size - 1) // 2
        same = self._keys(sums, self.less_two, f"={size}", (word[:half], word[half:]))
        short = self._keys(sums, self.less_one, f"+{size}", (word[:half], word[half:]))
        long = self._keys(sums, self.less_one, f"+{size - 1}", (word[:less], word[less + 1 :]))
        return same + short, same + long


def _signed(words: DataFrame, parts: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(parts)
        for batch in batches:
            both = [signer.signatures(w) for w in batch.column(0).to_pylist()]
            columns = [batch.column(0), batch.column(1)]
            for side in (0, 1):
                flat = np.array([s for one in both for s in one[side]], dtype=np.uint64).view(np.int64)
                ends = np.cumsum([0, *(len(one[side]) for one in both)], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)))
            yield pa.RecordBatch.from_arrays(columns, ["word", "n", "fewer", "more"])

    return map_arrow(words.select("word", "n"), run, "word string, n long, fewer array<long>, more array<long>")


def near_words(words: DataFrame, parts: int = PARTS) -> DataFrame:
    """Pairs (a, b) of words that one inserted, deleted or replaced letter turns into each
    other, once each, with their counts ``a_n`` and ``b_n``, from distinct ``word`` and ``n``."""
    signed = staged(_signed(words, parts), "signed-words")
    fewer = signed.select(F.explode("fewer").alias("signature"), F.col("word").alias("a"), F.col("n").alias("a_n"))
    more = signed.select(F.explode("more").alias("signature"), F.col("word").alias("b"), F.col("n").alias("b_n"))
    # of one length a pair is met from either side and counts once
    sizes = F.char_length("a"), F.char_length("b")
    once = (sizes[0] < sizes[1]) | ((sizes[0] == sizes[1]) & (F.col("a") < F.col("b")))
    return (
        fewer.join(more, "signature")
        .where(once & (F.levenshtein("a", "b", 1) == 1))
        .select("a", "b", "a_n", "b_n")
        .distinct()
    )


def _with_roots(forms: DataFrame) -> DataFrame:
    """Follow forms to the last one; each round doubles how far, and counts at least double
    from word to form, so there are few rounds."""
    found = staged(forms.withColumn("root", F.coalesce("form", "word")), "roots")
    while True:
        ahead = found.where("form IS NOT NULL").select(F.col("word").alias("root"), F.col("root").alias("_ahead"))
        moved = staged(found.join(ahead, "root", "left"), "roots-ahead")
        if moved.where("_ahead IS NOT NULL").isEmpty():
            return found
        found = moved.withColumn("root", F.coalesce("_ahead", "root")).drop("_ahead")


def group_spellings(words: DataFrame, at_least: int = 2, parts: int = PARTS) -> DataFrame:
    """Per ``word`` of distinct words with counts ``n``: ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``form`` is the near word with the largest count (ties: the first in code-point order), if
    that is at least ``at_least`` times the word's own, else null; ``root`` is where following
    forms ends, the word itself without a form; ``n_near`` counts near words. An empty
    table gives an empty one; other columns of ``words`` are not read.
    """
    if at_least < 2:
        raise ValueError("forms have at least twice the count, else they might go in circles")
    words = staged(words.select("word", "n"), "words")
    pairs = near_words(words, parts)
    ways = F.explode(
        F.array(
            F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
            F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
        )
    )
    best = (
        pairs.select(ways.alias("w"))
        .groupBy(F.col("w.word").alias("word"))
        .agg(
            F.count("*").alias("n_near"),
            F.min(F.struct((-F.col("w.near_n")).alias("less"), F.col("w.near").alias("form"))).alias("best"),
        )
    )
    taken = -F.col("best.less") >= at_least * F.col("n")
    forms = words.join(best, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(taken, F.col("best.form")).alias("form"),
        F.when(taken, -F.col("best.less")).alias("form_n"),
    )
    return _with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")


def spelling_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", **counting) -> DataFrame:
    """:func:`group_spellings` of :func:`count_words`. Repeated rows count again; ties between
    near words are settled in code-point order; long texts are counted run by run."""
    return group_spellings(count_words(docs, key, text, **counting))
