"""Packed pieces against the tokenizers library."""

import random
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import balanced_packing
from tidemark.llm.queries import QUERIES, tokenizer_file

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(tokenizer_file())


def check(rows, docs, library, capacity=4096):
    """Every id of every document lies in one piece, every sequence is whole; the padded share."""
    ids = defaultdict(list)
    for key, text in docs:
        ids[key].append(array("I", [*library.encode(text or "", add_special_tokens=False).ids, 2]))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert pieces.keys() == ids.keys()
    for key, own in pieces.items():
        if len(ids[key]) == 1:
            (whole,) = ids[key]
            at = 0
            for r in sorted(own, key=lambda r: r.start):
                assert r.start == at and r.length > 0 and r.doc_tokens == len(whole)
                at += r.length
                assert r.ids_crc32 == zlib.crc32(whole[r.start : at].tobytes())
            assert at == len(whole)
        else:
            assert sum(r.length for r in own) == sum(map(len, ids[key]))
    total = 0
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
        total += at
    return 1 - total / (len(sequences) * capacity) if sequences else 0


def test_query(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    df = QUERIES["op12_balanced_packing"](spark, SF_DIR)
    assert df.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    assert check(df.collect(), docs, library) < 0.02


def test_many_tasks_and_small_windows(spark, library):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choices(["one", "two", "unbelievable", "xyzzy"], k=rng.randint(0, 300)))) for i in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(20)
    rows = balanced_packing.pack_documents(df, tokenizer_file(), capacity=64).collect()
    # less than one window is open in the end, however many tasks there are
    assert check(rows, docs, library, 64) < 0.01


def test_edges(spark, library):
    text = "a long text, " * 30_000
    docs = [(None, "x"), (1, None), (2, ""), (3, text), (4, "a b"), (4, "a b"), (5, "word " * 4095), (6, "中文 <|endoftext|> ǰ J̌")]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS start", "'z' AS ids", "2 AS part")
    assert check(balanced_packing.pack_documents(df, tokenizer_file()).collect(), docs, library) < 0.2
    named = [(f"k{k}", t) for k, t in docs]
    df = spark.createDataFrame(named, "doc_id string, text string")
    check(balanced_packing.pack_documents(df, tokenizer_file()).collect(), named, library)
    assert balanced_packing.pack_documents(df.limit(0), tokenizer_file()).collect() == []


def greedy(sizes, k):
    sums = [0] * k
    for size in sorted(sizes, reverse=True):
        sums[sums.index(min(sums))] += size
    return max(sums) - min(sums)


def test_differencing_known_cases():
    # two ways: 8 7 6 5 4 leaves 2 by differencing
    sums = np.bincount(balanced_packing.differencing(np.array([8, 7, 6, 5, 4]), 2), weights=[8, 7, 6, 5, 4])
    assert sorted(sums) == [14, 16]
    rng = np.random.default_rng(4)
    better = 0
    for _ in range(30):
        sizes = rng.integers(1, 10_000, 120)
        window = balanced_packing.differencing(sizes, 6)
        sums = np.bincount(window, weights=sizes, minlength=6)
        assert sums.sum() == sizes.sum()
        better += sums.max() - sums.min() <= greedy(sizes.tolist(), 6)
    assert better >= 24


@pytest.mark.parametrize(
    "sizes", [[2500] * 900, [1] * 50_000, [4095] * 3, [5], list(range(1, 1500)), [4096] * 600, [2100 + i for i in range(1900)]]
)
def test_pack_keeps_every_id(sizes):
    windows = balanced_packing.pack(sizes)
    seen = [[] for _ in sizes]
    for pieces in windows:
        assert sum(p[2] for p in pieces) <= 4096
        for item, begin, length in pieces:
            seen[item].append((begin, length))
    for size, parts in zip(sizes, seen, strict=True):
        at = 0
        for begin, length in sorted(parts):
            assert begin == at
            at += length
        assert at == size
    assert len(windows) <= -(-sum(sizes) // 4096) * (1 + balanced_packing.SPARE)


def test_full_memory_starts_over(library, monkeypatch):
    monkeypatch.setattr(balanced_packing, "KEPT_BYTES", 1000)
    own = balanced_packing.Encoder(tokenizer_file())
    for text in ["one two three four five", "six, seven. eight <|endoftext|>", "one six nine " + "ten" * 400, "J̌ İ Σς"] * 3:
        assert own.encode([text])[0] == array("I", library.encode(text, add_special_tokens=False).ids).tobytes()
        assert own.held <= 1000 or len(own.chunks) < 10


def test_merges_of_many_words_at_once():
    own = balanced_packing.Encoder(tokenizer_file())
    rng = random.Random(9)
    words = ["".join(rng.choices("aaabeinrstßé中’-0", k=rng.randint(1, 14))) for _ in range(3000)]
    words += ["a" * n for n in range(1, 40)] + ["ab" * 4000, "xyz" * 900, "é" * 700]
    plain = own.vocab.encode(words := list(dict.fromkeys(words)))
    assert own.merges.encode(words) == [array("I", ids).tobytes() for ids in plain]
