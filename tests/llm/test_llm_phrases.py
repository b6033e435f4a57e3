"""Collocations against plain counting and against DuckDB."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import database, differences

from tidemark.llm import phrase_trie
from tidemark.llm.queries import ORACLE, QUERIES

UPPER = {c: c + 32 for c in range(65, 91)}


def pieces(text):
    for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
        yield re.findall("[^\x20\x09]+", piece)


def expected(docs, least, top):
    f = defaultdict(Counter)
    for lang, text in docs:
        for words in pieces(text):
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    f[lang or "und"][tuple(words[i : i + size])] += 1
    rows = set()
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        candidates = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        kept = []
        for p, a in candidates.items():
            inside = any(
                100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in candidates.items()
                if len(q) > len(p)
            )
            if not inside:
                cuts = [(2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p))]
                score, _, left, right = min(cuts)
                kept.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            rows.add((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return rows


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    words = ["New", "york", "the", "of", "é", "É", "a b", "city-hall", "\x1c", "ab"]
    ends = [" ", " ", " ", "\t", " \t ", ".", ", ", "\r\n", "\x0b", "!", ""]
    return [
        (rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 200))))
        for _ in range(60)
    ]


@pytest.mark.parametrize("bits", [25, 6])
def test_any_text(spark, texts, bits):
    df = spark.createDataFrame(texts, "lang string, text string").repartition(3)
    # a filter of 64 bits lets nearly every pair through and changes nothing
    rows = found(phrase_trie.collocations(df, least=4, top=30, filter_bits=bits))
    assert rows == expected(texts, 4, 30) and len(rows) == 90


def test_runs_of_a_full_trie(texts, monkeypatch):
    monkeypatch.setattr(phrase_trie, "BURST", 8)
    monkeypatch.setattr(phrase_trie, "OWN", 3)
    monkeypatch.setattr(phrase_trie, "MOST_PHRASES", 60)
    everything = np.full(8, 255, dtype=np.uint8)
    counted, count = Counter(), 0
    for counting in (phrase_trie.Counting(), phrase_trie.Counting(everything, 6)):
        batches = []
        for lang, text in texts:
            counting.take(lang or "und", text.encode().translate(phrase_trie._PLAIN))
            if counting.full():
                batches += counting.runs(everything=False)
                assert not counting.full()
        batches += counting.runs(everything=True)
        count += len(batches)
        for batch in batches:
            part = [(r["lang"], " ".join(filter(None, (r["prefix"], r["rest"]))), r["n"]) for r in batch.to_pylist()]
            assert all(r["prefix"].count(" ") <= 1 for r in batch.to_pylist())
            words = [phrase.encode().split(b" ") for _, phrase, _ in part]
            assert words == sorted(words)
            for lang, phrase, n in part:
                counted[lang, phrase] += n
    plain = Counter()
    for lang, text in texts:
        for words in pieces(text):
            for size in range(1, 5):
                for i in range(len(words) - size + 1):
                    plain[lang or "und", " ".join(words[i : i + size])] += 1
    assert counted == plain and count > 20


def test_containers_burst(monkeypatch):
    monkeypatch.setattr(phrase_trie, "BURST", 50)
    monkeypatch.setattr(phrase_trie, "OWN", 10)
    rng = random.Random(1)
    trie, plain = phrase_trie.Container(), Counter()
    for _ in range(500):
        some = [tuple(rng.choice([2, 3, rng.randint(2, 60)]) for _ in range(rng.randint(1, 4))) for _ in range(10)]
        phrases = [sum(w << 32 * i for i, w in enumerate(ids)) for ids in some]
        if rng.random() < 0.5:
            trie.add_all(phrases, [1] * 10)
        else:
            for phrase in phrases:
                trie.add(phrase, 1)
        plain.update(some)
    found = Counter()
    for before, counts in trie.hashes():
        for phrase, n in counts.items():
            ids = before
            while phrase:
                ids, phrase = (*ids, phrase & 0xFFFFFFFF), phrase >> 32
            found[ids] += n
    assert found == plain and len(trie) == len(plain)
    assert trie.children and any(c.children for c in trie.children.values())


def test_blocks_end_with_pieces():
    text = b"ab cd\nef\n" * 50 + b"x" * 100 + b"\n" + b"y" * 300
    blocks = list(phrase_trie._blocks(text, 40))
    assert b"\n".join(blocks) == text and len(blocks) > 5


def test_edges(spark):
    docs = [("en", None), ("en", ""), (None, "a b a b"), ("und", "A B"), ("de", "w " * 100_000), ("de", "w " * 100_000)]
    df = spark.createDataFrame(docs, "lang string, text string").selectExpr("*", "1 AS phrase", "2 AS f", "3 AS _lang")
    rows = found(phrase_trie.collocations(df, least=3, top=5))
    assert rows == expected(docs, 3, 5)
    assert {r[0] for r in rows} == {"und", "de"}
    assert found(phrase_trie.collocations(df.limit(0))) == set()


def test_products_beyond_64_bits(spark):
    row = spark.range(1).selectExpr("9000000000000000000L AS a", "9000000000000000000L AS l", "9100000000000000000L AS r").selectExpr(
        "CAST(a AS DECIMAL(20,0)) * CAST(2000000 AS DECIMAL(10,0)) DIV (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0))) AS s"
    )
    assert row.first().s == 2_000_000 * 9 * 10**18 // (181 * 10**17)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert differences(QUERIES["op13_collocations"](spark, sf_dir), database(sf_dir), ORACLE["op13_collocations"]) is None
