"""One query for each operator over the whole table it is meant for, and its SQL where there is some."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    balanced_packing,
    dom_content,
    latent_leaks,
    license_scan,
    line_crf,
    order_minhash,
    phrase_trie,
    quote_links,
    repeated_spans,
    secret_scan,
    spelling_groups,
    trie_bpe,
    url_templates,
)
from tidemark.llm.frames import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    """The content of one of the public tokenizer files."""
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_text(encoding="utf-8")


def bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = trie_bpe.encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file())
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    field = line_crf.train_from(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return line_crf.judge_quality(docs, field).drop("content_lines")


def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    model = secret_scan.train_from(docs, table(spark, sf_dir, "labels", "doc_id"))
    spans = secret_scan.find_secrets(docs, model)

    def shown(of):
        return F.array_join(F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return spans.select(
        "doc_id",
        *(count(kind) for kind in secret_scan.KINDS),
        F.sha2(shown(F.filter("spans", lambda s: s["kind"] != "random")), 256).alias("base_sha256"),
        shown(F.col("spans")).alias("spans"),
    )


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_classes(table(spark, sf_dir, "documents", "doc_id", "text"))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return latent_leaks.find_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    labels = url_templates.labels_of_pages(pages, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return url_templates.judge_urls(pages, labels)


def main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return dom_content.extract(pages, dom_content.trained(), keep=("url",))


def repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans.removable(table(spark, sf_dir, "documents", "doc_id", "text"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def reply_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quote_links.reply_order(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def license_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.find_licenses(table(spark, sf_dir, "documents", "doc_id", "text"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return spelling_groups.spelling_groups(docs, lose_one_in=97)


def packed_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balanced_packing.pack_documents(table(spark, sf_dir, "documents", "doc_id", "text"), tokenizer_file())


def phrase_ranks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_trie.collocations(table(spark, sf_dir, "documents", "text", "lang"))


QUERIES: dict[str, Query] = {
    "op1_reply_order": reply_ordered,
    "op2_bpe": bpe_digests,
    "op3_licenses": license_places,
    "op4_main_text": main_text,
    "op5_url_verdicts": url_verdicts,
    "op6_repeated_spans": repeated_bytes,
    "op7_line_quality": line_quality,
    "op8_secrets": secret_spans,
    "op9_benchmark_leaks": benchmark_leaks,
    "op10_near_duplicates": near_duplicates,
    "op11_spelling_groups": spelling_variants,
    "op12_balanced_packing": packed_pieces,
    "op13_collocations": phrase_ranks,
}

ORACLE: dict[str, str] = {
    "op1_reply_order": quote_links.oracle(),
    "op5_url_verdicts": url_templates.oracle(),
    "op13_collocations": phrase_trie.oracle(),
}
