"""The trie coder against the tokenizers library."""

import hashlib
import random
from array import array

import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tidemark.llm import frames, trie_bpe
from tidemark.llm.queries import QUERIES, tokenizer_file

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(tokenizer_file())


def expected(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    return array("I", ids).tobytes(), library.decode(ids, skip_special_tokens=False)


def test_any_text(library):
    coder = trie_bpe.Coder(trie_bpe.Vocabulary(tokenizer_file()))
    rng = random.Random(1)
    parts = list("abcdefgthein  \n\t\x1c\x85\xa0'’.,!?019²½Ⅷ٣éÉΣσςİıſa̧Ḱ̀ǅ中文😀‍​_<|>-\x7f\x01") + [
        "<|endoftext|>", "<|startoftext|>", "'ll", "'S", "the", "ing", "가", "Å",
    ]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["ab" * 5000, "é" * 3000, "x" * 20_000 + " y"]
    ids, shown = coder.code(texts)
    for text, i, s in zip(texts, ids, shown, strict=True):
        assert (i, s) == expected(library, text), repr(text)


def test_full_memory_starts_over(library, monkeypatch):
    monkeypatch.setattr(trie_bpe, "KEPT_CHUNKS", 10)
    monkeypatch.setattr(trie_bpe, "MEMO", 5)
    coder = trie_bpe.Coder(trie_bpe.Vocabulary(tokenizer_file()))
    for text in ("one two three four five six seven", "eight nine ten eleven twelve", "one eight <|endoftext|> two"):
        ids, shown = coder.code([text])
        assert (ids[0], shown[0]) == expected(library, text)


def test_shared_prefixes_are_walked_once():
    vocab = trie_bpe.Vocabulary(tokenizer_file())
    calls = []
    step = vocab.step
    vocab.step = lambda *a: calls.append(a) or step(*a)
    vocab.encode(["walking", "walked", "walker", "walk"])
    assert len(calls) == len(set(calls))


def test_query(spark, library):
    rows = QUERIES["op2_bpe"](spark, SF_DIR).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == texts.keys()
    for row in rows:
        ids, shown = expected(library, texts[row.doc_id])
        assert row.n_tokens == len(ids) // 4
        assert row.ids_sha256 == hashlib.sha256(ids).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(shown.encode()).hexdigest()


def test_workers_free_the_encodings_for_other_operators(spark):
    docs = spark.createDataFrame([(n, f"some text {n}") for n in range(40)], "doc_id long, text string").repartition(4)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [trie_bpe.coder.cache_info().currsize] * batch.num_rows}, schema=arrow)

    arrow = pa.schema([("n", pa.int64())])

    def kept(**options):
        trie_bpe.encode_decode(docs, tokenizer_file()).write.format("noop").mode("overwrite").save()
        return {r.n for r in frames.map_arrow(docs, sizes, "n long", **options).collect()}

    assert 1 in kept(cached=trie_bpe.coder)
    assert kept() == {0}
