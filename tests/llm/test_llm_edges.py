"""Empty tables, odd rows and clashing columns in every operator, and the pipeline."""

import pytest

import corpus_pipeline
from tidemark.llm import (
    dom_content,
    latent_leaks,
    license_scan,
    line_crf,
    order_minhash,
    quote_links,
    repeated_spans,
    secret_scan,
    trie_bpe,
    url_templates,
)
from tidemark.llm.queries import tokenizer_file

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_words long, spans string, kept string, node string, `copy` string, words string, _text string"
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "word"), (5, "x" * 60_000), (6, "la " * 20_000), (7, "\n" * 5_000),
    (8, "The same text, twice in the table, with more than five words."),
    (9, "The same text, twice in the table, with more than five words."), (10, "\x00\x1c\u2028 é😀"), (None, "no key"),
]


def pages(spark, rows):
    return spark.createDataFrame([(k, t, t) for k, t in rows], "page_id long, html string, text string")


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


OPERATORS = {
    "bpe": lambda s, d: trie_bpe.encode_decode(d, tokenizer_file()),
    "licenses": lambda s, d: license_scan.find_licenses(d),
    "spans": lambda s, d: repeated_spans.removable(d),
    "lines": lambda s, d: line_crf.judge_quality(d, line_crf.train(["a b\n***"], [True])),
    "good": lambda s, d: line_crf.keep_good(d, line_crf.train([], [])),
    "secrets": lambda s, d: secret_scan.find_secrets(d, secret_scan.train([], [])),
    "masked": lambda s, d: secret_scan.mask_secrets(d, secret_scan.train([], [])),
    "leaks": lambda s, d: latent_leaks.find_leaks(d, bench(s, [(1, "five words make this item"), (2, None)])),
    "clean": lambda s, d: latent_leaks.without_leaks(d, bench(s, [])),
    "near": lambda s, d: order_minhash.near_classes(d),
    "first": lambda s, d: order_minhash.first_of_class(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_documents(spark, name):
    empty = spark.createDataFrame([], DOCS)
    assert OPERATORS[name](spark, empty).count() == 0
    rows = [(k, t, *[None] * 7) for k, t in ODD]
    out = OPERATORS[name](spark, spark.createDataFrame(rows, DOCS))
    keys = [r.doc_id for r in out.collect()]
    if name in ("bpe", "spans", "lines", "secrets", "masked", "clean", "near"):
        assert sorted(map(str, keys)) == sorted(str(k) for k, _ in ODD)
    if name == "first":
        assert 9 not in keys and 8 in keys and {1, 2, 3, 4} <= {*keys}
    if name in ("leaks", "licenses"):
        assert keys == []


def test_training_on_nothing(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert line_crf.train_from(docs, labels).least == 0.0
    assert secret_scan.train_from(docs, labels).least > 0
    some = spark.createDataFrame([(1, None), (1, 1), (1, 0), (None, 1)], "doc_id long, quality int")
    rows = spark.createDataFrame([(k, t, *[None] * 7) for k, t in ODD], DOCS)
    assert line_crf.train_from(rows, some).least >= 0.0
    assert secret_scan.train_from(rows, some).least > 0


def test_pages_urls_and_messages(spark):
    model = dom_content.trained(40)
    assert dom_content.extract(pages(spark, []), model).count() == 0
    assert dom_content.extract(pages(spark, ODD), model).count() == len(ODD)
    labels = spark.createDataFrame([], "page_id long, good int")
    for rows in ([], ODD):
        urls = spark.createDataFrame([(k, t, t) for k, t in rows], "page_id long, url string, verdict string")
        assert url_templates.judge_urls(urls, labels).count() == len(rows)
        messages = spark.createDataFrame([(k, 1, "u", t) for k, t in rows], "conv_id long, turn long, role string, text string")
        assert quote_links.reply_order(messages).count() == len(rows)


def test_pipeline(spark):
    """Each stage against its operator on what the stage before kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality rules", "MinHash near-dedup", "benchmark decontamination", "secret scans", "BPE encoding and decoding",
    ]
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES:
        rows = stage(spark, steps[-1], SF_DIR)
        steps.append(spark.createDataFrame(rows.collect(), rows.schema))
    assert all(s.columns == docs.columns for s in steps[:-1])
    kept = [{r.doc_id: r for r in s.collect()} for s in steps]
    classes = {r.doc_id: r.class_id for r in order_minhash.near_classes(steps[1]).collect()}
    assert kept[2].keys() == {*classes.values()} and kept[2].keys() < kept[1].keys() < kept[0].keys()
    leaks = latent_leaks.find_leaks(steps[2], spark.read.parquet(f"{SF_DIR}/benchmark.parquet"))
    assert kept[3].keys() == kept[2].keys() - {r.doc_id for r in leaks.collect()}
    assert kept[4].keys() == kept[3].keys() == kept[5].keys()
    assert all(r.n_chars == len(r.text) for r in kept[4].values())
    spans = secret_scan.find([r.text for r in kept[4].values()], None)
    assert not any(spans)
    final = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert {k: bytes(r.ids) for k, r in final.items()} == {k: bytes(r.ids) for k, r in kept[5].items()}
