"""The corpus pipeline: five stages over documents, each on all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from motionframe.llm import decontaminate, hyperlang, minhash, prefix_bpe, secrets
from motionframe.session import ship, table, written

TOKENIZER = "byte_bpe_50k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Prototypes of the labelled documents; those whose text has no letters go."""
    ship(spark)
    return hyperlang.keep_known(docs, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, similar from 0.8 on, the document with the smallest id stays."""
    ship(spark)
    return minhash.near_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth of the words or more are windows of the benchmark go."""
    ship(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking credentials are masked in their texts; widely copied examples stay, and so do all documents.

    Owners are counted over the whole table: the copies that show who has a value have left docs.
    """
    ship(spark)
    return secrets.redact(docs, corpus=table(spark, sf_dir, "documents"))


def encode_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids (little-endian unsigned 32-bit), n_tokens, and digests of ids and decoded text."""
    ship(spark)
    return prefix_bpe.round_trip(docs, public_tokenizers.path(TOKENIZER), ["doc_id", "lang", "source"], with_ids=True)


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("secret scans", redact_secrets),
    ("BPE encoding and decoding", encode_bpe),
]
#: SQL can express neither the prototypes nor the signatures and merges; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents; each one's result is written and read again."""
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        docs = written(docs, f"stage{i}")
    return docs
