"""Base counts against their literal reading, decoding against all sequences, held-out verdicts."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import line_crf
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def literal(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dups = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dups += line in seen
            seen.add(line)
    count = Counter(zip(words, words[1:], words[2:]))
    covered = {p for i in range(len(words) - 2) if count[tuple(words[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(covered)


def test_base_counts():
    rng = random.Random(2)
    parts = ["a", "b ", "c\n", "\n", " ", "\x0b", "\x85", "\xa0", "É!", "#", "\r\n", "\x1c", "x y z "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(2000)] + ["", "w " * 30_000]
    base, lines = line_crf.measure(texts)
    assert len(lines.counts) == len(texts)
    for n, text in enumerate(texts):
        assert tuple(base[name][n] for name in line_crf.BASE) == literal(text)


def test_viterbi_finds_the_best_sequence():
    rng = np.random.default_rng(4)
    for sizes in ([3, 0, 5], [1], [0], [6, 6]):
        counts = np.array(sizes)
        features = rng.normal(size=(counts.sum(), 4))
        field = line_crf.Field(rng.normal(size=(2, 4)), rng.normal(size=(2, 2)), 0.5)
        lines = line_crf.Lines(features, np.ones(len(features)), np.arange(len(features)), counts)
        got = line_crf.viterbi(lines, field).astype(int)
        begin = 0
        for size in sizes:
            scores = features[begin : begin + size] @ field.weights.T

            def total(path, scores=scores):
                return sum(scores[i, y] for i, y in enumerate(path)) + sum(field.pairs[a, b] for a, b in zip(path, path[1:]))

            best = max(itertools.product((0, 1), repeat=size), key=total)
            assert tuple(got[begin : begin + size]) == best
            begin += size


@pytest.fixture(scope="module")
def labelled(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select("doc_id", "quality")
    return [tuple(r) for r in docs.join(labels, "doc_id").orderBy("doc_id").select("text", "quality").collect()]


def test_held_out(labelled):
    train, held = labelled[::2], labelled[1::2]
    field = line_crf.train([t for t, _ in train], [q == 1 for _, q in train])
    out = line_crf.judge([t for t, _ in held], field)
    verdicts = Counter((q, k) for (_, q), k, f in zip(held, out["kept"], out["base_failed"], strict=True) if not f)
    assert verdicts[1, True] >= 0.99 * (verdicts[1, True] + verdicts[1, False])
    assert verdicts[0, False] >= 0.9 * (verdicts[0, True] + verdicts[0, False])


def test_one_label_keeps_every_line():
    field = line_crf.train(["a b c\n***"], [True])
    assert line_crf.judge(["x y\nz"], field)["content_share"] == [1.0]
    assert line_crf.train([], []).least == 0.0


def test_query_and_filter_agree(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op7_line_quality"](spark, SF_DIR).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert rows.keys() == texts.keys()
    for key, row in rows.items():
        assert tuple(row[name] for name in line_crf.BASE) == literal(texts[key])
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
        assert not (row.base_failed and row.kept)
    field = line_crf.train_from(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    kept = line_crf.keep_good(docs, field)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in rows.items() if r.kept}
