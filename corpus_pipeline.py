"""The corpus pipeline: documents in, token counts and digests out.

Each stage calls one operator of ``starmart.llm`` on all that the stage before
kept, is written as Parquet in the shared folder and read again, so a lost
executor costs tasks and never a stage.

Defined results: what each operator states for nulls, empty and long texts and
repeated rows holds here too; an empty table passes through; columns beyond
those of ``documents`` are carried to the last stage, which returns its own.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from starmart.llm import bpe, exact_dedup, mixing, repetition, simhash
from starmart.llm.common import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base or the repetition rules go."""
    return repetition.keep_clean(docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id stays."""
    return exact_dedup.drop_duplicates(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked fingerprints the document with the smallest doc_id stays."""
    return simhash.drop_near_duplicates(docs, words=4, distance=4)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed_documents(docs, share_percent=150, max_epochs=2)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each document of the mix."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_digests(docs, ranks, public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_duplicates),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources to target weights", source_mix),
    ("byte-level BPE encoding and decoding", token_ids),
]

#: SQL has no suffix arrays, fingerprints or merges: tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
