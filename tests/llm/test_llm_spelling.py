"""Spelling groups against brute force over all words."""

import random
import re
import zlib
from collections import Counter

import pytest

from tidemark.llm import spelling_groups
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}


def distance_is_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)) :] == b[at + 1 :]


def expected(docs, every=97, least=5, times=3):
    counts = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= least and c >= times}
    by_size = {}
    for w in n:
        by_size.setdefault(len(w), []).append(w)
    near = {w: [v for s in (-1, 0, 1) for v in by_size.get(len(w) + s, ()) if distance_is_one(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {(w, form[w], root(w), n[w], len(near[w]), n.get(form[w])) for w in n}


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return set(rows)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert found(QUERIES["op11_spelling_groups"](spark, SF_DIR)) == expected(docs)


def test_edits_of_random_words(spark):
    rng = random.Random(3)
    letters = "aabcdeéÿ"
    words = ["".join(rng.choices(letters, k=rng.randint(5, 9))) for _ in range(150)]
    for w in list(words):
        at = rng.randrange(len(w))
        words += [w[:at] + w[at + 1 :], w[:at] + rng.choice(letters) + w[at:], w[:at] + rng.choice(letters) + w[at + 1 :]]
    docs = [(i, " ".join(rng.choices(words, k=400)).replace("é", rng.choice("éÉ"))) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    assert found(spelling_groups.spelling_groups(df)) == expected(docs, every=None)
    assert found(spelling_groups.spelling_groups(df, lose_one_in=3)) == expected(docs, every=3)


def test_chains_and_ties(spark):
    words = [("aaaab", 1), ("aaabb", 2), ("aabbb", 4), ("abbbb", 8), ("bbbbb", 16), ("bbbbc", 16), ("bbbcc", 9), ("zzzzz", 3)]
    df = spark.createDataFrame(words, "word string, n long").withColumnsRenamed({}).selectExpr("*", "1 AS form", "2 AS signature")
    rows = {r.word: r for r in spelling_groups.group_spellings(df).collect()}
    assert [rows[w].form for w, _ in words] == ["aaabb", "aabbb", "abbbb", "bbbbb", None, None, None, None]
    assert {rows[w].root for w, _ in words[:5]} == {"bbbbb"}
    assert rows["zzzzz"].n_near == 0 and rows["bbbbb"].n_near == 2
    ties = spark.createDataFrame([("mmmmm", 2), ("mmmmz", 9), ("mmmma", 9), ("ammmm", 9)], "word string, n long")
    assert {r.word: r.form for r in spelling_groups.group_spellings(ties).collect()}["mmmmm"] == "ammmm"


def test_edges(spark):
    long = "Lettersé " * 150_000 + "x" * 200_000
    docs = [(None, "Lettersé lettersé LETTERSÉ"), (1, None), (2, ""), (2, ""), (3, long), (3, long), (4, "中文 ßßßßß Ÿ×÷öäüé"), (4, "x" * 200_000)]
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'q' AS word", "1 AS n", "2 AS _key")
    assert found(spelling_groups.spelling_groups(df, lose_one_in=97)) == expected(docs)
    named = spark.createDataFrame([(str(k), t) for k, t in docs[3:]], "doc_id string, text string")
    assert found(spelling_groups.spelling_groups(named, lose_one_in=97)) == expected(docs[3:])
    assert found(spelling_groups.spelling_groups(df.limit(0))) == set()
    with pytest.raises(ValueError):
        spelling_groups.group_spellings(df, at_least=1)


def test_every_edit_shares_a_signature():
    rng = random.Random(5)
    signer = spelling_groups.Signer()
    for _ in range(2000):
        word = "".join(rng.choices("abcde", k=rng.randint(5, 40)))
        at, new = rng.randrange(len(word)), rng.choice("abcdefg")
        fewer = set(signer.signatures(word)[0])
        assert fewer & set(signer.signatures(word[:at] + new + word[at:])[1])
        if word[at] != new:
            assert fewer & set(signer.signatures(word[:at] + new + word[at + 1 :])[1])
