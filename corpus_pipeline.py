"""Five stages from raw documents to encoded ones.

Each stage takes (spark, docs, sf_dir), works on all rows it is given and returns rows with
the columns of ``docs``, except the last one, which returns the encoded documents. The rows
between two stages are written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import latent_leaks, line_crf, order_minhash, secret_scan, trie_bpe
from tidemark.llm.frames import table
from tidemark.llm.queries import tokenizer_file
from tidemark.sources.tables import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the line field reject go."""
    field = line_crf.train_from(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return line_crf.keep_good(docs, field)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the document with the smallest id stays."""
    return order_minhash.first_of_class(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold an item of the benchmark go."""
    return latent_leaks.without_leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked and ``n_chars`` follows; every document stays."""
    return secret_scan.mask_secrets(docs, secret_scan.train_from(docs, table(spark, sf_dir, "labels", "doc_id")))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and what they decode to."""
    return trie_bpe.encode_decode(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("secret scans", secrets),
    ("BPE encoding and decoding", encode),
]

#: Trained models, alignments and encodings are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the encoded ones that are left."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES):
            docs = staged(docs, f"stage-{n}")
    return docs
