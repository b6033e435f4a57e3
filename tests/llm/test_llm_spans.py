"""Suffix arrays against sorting, removed bytes against a count of all strings."""

import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest

from tidemark.llm import repeated_spans
from tidemark.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_suffix_array():
    rng = random.Random(1)
    for _ in range(1500):
        letters = rng.randint(1, 5)
        text = [rng.randint(1, letters) for _ in range(rng.randint(0, 50))] + [0]
        assert repeated_spans.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def literal(texts):
    length = repeated_spans.LENGTH
    data = [(k, (t or "").encode()) for k, t in texts]
    count = Counter(b[i : i + length] for _, b in data for i in range(len(b) - length + 1))
    found = []
    for key, b in data:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (not i or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone) if not g)
        found.append((key, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(found)


def measured(found):
    return sorted(
        (r.doc_id, r.n_bytes, sum(s.end - s.start for s in r.spans), len(r.spans), hashlib.sha256(r.kept).hexdigest())
        for r in found.collect()
    )


def made_up(rng):
    pool = ["".join(rng.choices("abcdé ", k=rng.randint(100, 700))) for _ in range(12)]
    rows = []
    for n in range(100):
        parts = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < 0.6:
                part = rng.choice(pool)
                at = rng.randint(0, len(part))
                parts.append(part[at : at + rng.randint(100, 400)])
            else:
                parts.append("".join(rng.choices("xyz ab", k=rng.randint(1, 300))))
        rows.append((n, "".join(parts)))
    return rows + [(200, None), (201, ""), (202, "a" * 900), (203, "ab" * 300), (204, "a" * 199), (205, "z" * 200), (206, "€" * 200)]


@pytest.mark.parametrize("most", [20_000, 1])
def test_removed(spark, monkeypatch, most):
    monkeypatch.setattr(repeated_spans, "MOST", most)
    rows = made_up(random.Random(4))
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id as at", "text as kept")
    assert measured(repeated_spans.removable(docs)) == literal(rows)


def test_pieces_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(repeated_spans, "PIECE", 1024)
    monkeypatch.setattr(repeated_spans, "SLICE", 700)
    rng = random.Random(9)
    same = "".join(rng.choices("abcdefgh", k=2500))
    rows = [(1, same + "".join(rng.choices("xyz", k=3000))), (2, "".join(rng.choices("uvw", k=1700)) + same), (3, same[700:1500])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert measured(repeated_spans.removable(docs)) == literal(rows)


def test_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = sorted(tuple(r) for r in QUERIES["op6_repeated_spans"](spark, SF_DIR).collect())
    assert got == literal(rows)


def test_slices_hold_places_of_21_bits(spark, monkeypatch):
    """Many short texts of four-byte characters, which share spans near a slice's end."""
    seen = []
    whole = repeated_spans.contexts_of

    def contexts_of(data, ends, *rest):
        seen.append(len(data))
        return whole(data, ends, *rest)

    monkeypatch.setattr(repeated_spans, "contexts_of", contexts_of)
    run = []
    monkeypatch.setattr(repeated_spans, "map_arrow", lambda df, work, schema: run.append(work) or df)
    rng = random.Random(8)
    texts = ["".join(chr(0x20000 + rng.randrange(4000)) for _ in range(1000)) for _ in range(590)]
    repeated_spans.contexts(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "doc_id", "text")
    batch = pa.RecordBatch.from_arrays([pa.array(range(590), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    keys = {k for part in run[0](iter([batch])) for k in part.column(0).to_pylist()}
    assert keys == set(range(590))
    assert sum(seen) == 590 * 4000
    assert max(seen) <= 1 << 21
