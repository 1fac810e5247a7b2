"""Exact dedup by progressive refinement: length, then prefix hash, then full hash.

Each step looks only at what the last one left in groups of two or more:

1. the lengths (bytes) of all texts are counted;
2. the hashes of the first ``PREFIX`` characters are counted where a length
   occurs twice (lengths and prefix hashes come from one read of the texts and
   are written, 16 bytes a row);
3. the whole text is hashed (SHA-256) where length and prefix hash occur
   twice; texts of equal length and SHA-256 are a group.

The texts are read twice and never moved. What goes back to the scan is the set
of buckets (``hash mod BUCKETS``) that hold a group of two or more: at most
``BUCKETS`` numbers, broadcast, whatever the data. A bucket may let a single
text through; the group's own key then tells it apart, so buckets only save
work and never decide. DataFrame functions only.

Defined results: a null text counts as empty; equal empty texts are a group;
repeated rows (same id, same text) give one row each, of which one is kept;
null ids rank below all others; an empty table gives an empty table; columns
other than the two named are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import one_row_each, stage, text_of

PREFIX = 256
#: The bound of what is broadcast between the steps.
BUCKETS = 1 << 18


def _crowded(rows: DataFrame, key: list[str]) -> DataFrame:
    """The buckets that hold a key of two or more rows."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int")
    return stage(rows.groupBy(*key).count().where("count > 1").select(bucket.alias("bucket")).distinct())


def _in(rows: DataFrame, buckets: DataFrame, key: list[str], name: str) -> DataFrame:
    """Adds ``name``: whether the row's bucket is among ``buckets``."""
    right = buckets.select(F.col("bucket").alias("__b"), F.lit(True).alias(name))
    on = F.pmod(F.xxhash64(*key), F.lit(BUCKETS)).cast("int") == F.col("__b")
    # At most BUCKETS rows of four bytes: the bound is in the column's range.
    return rows.join(F.broadcast(right), on, "left").drop("__b").withColumn(name, F.coalesce(name, F.lit(False)))


def groups(docs: DataFrame, digest_all: bool, id_col: str, text_col: str, normalise) -> DataFrame:
    """``(doc_id, bytes, sha256, n, keep_id, group_size)``: a row for each id and text.

    ``n`` is the number of rows with both, ``sha256`` null where no other text
    has the length and prefix (unless ``digest_all``).
    """
    text = normalise(text_of(text_col))
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    base = base.withColumn("bytes", F.octet_length("text").cast("long"))
    prefix = F.xxhash64(F.substring("text", 1, PREFIX)).alias("prefix")
    heads = stage(base.select("bytes", prefix))
    by_length = _crowded(heads, ["bytes"])
    by_prefix = _crowded(_in(heads, by_length, ["bytes"], "same").where("same"), ["bytes", "prefix"])
    third = _in(base.select("*", prefix), by_prefix, ["bytes", "prefix"], "candidate")
    whole = F.sha2("text", 256)
    third = third.select(
        "doc_id",
        "bytes",
        "candidate",
        (whole if digest_all else F.when(F.col("candidate"), whole)).alias("sha256"),
    )
    # Equal rows become one with a count before anything is joined: a text
    # that a third of all rows hold has one row for each id from here on.
    rows = stage(third.groupBy("doc_id", "bytes", "candidate", "sha256").agg(F.count(F.lit(1)).alias("n")))
    same = stage(
        rows.where("candidate")
        .groupBy("bytes", "sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
        .where("group_size > 1")
    )
    pair = same.select(F.col("bytes").alias("__bytes"), F.col("sha256").alias("__sha"), "keep_id", "group_size")
    joined = rows.join(pair, F.expr("candidate and bytes = __bytes and sha256 = __sha"), "left")
    return joined.select(
        "doc_id",
        "bytes",
        "sha256",
        "n",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", "n").alias("group_size"),
    )


def _as_is(text: Column) -> Column:
    return text


def exact_duplicates(
    docs: DataFrame, digest_all: bool = False, id_col: str = "doc_id", text_col: str = "text", normalise=_as_is
) -> DataFrame:
    """One row a document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Of equal texts the row with the largest id stays. Rows without an equal
    stay too; their ``text_sha256`` is null unless ``digest_all`` asks for it.
    """
    found = groups(docs, digest_all, id_col, text_col, normalise)
    copies = found.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("i") == 1)
    return copies.select("doc_id", "keep_id", "group_size", kept.alias("kept"), F.col("sha256").alias("text_sha256"))


def drop_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", normalise=_as_is) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    found = groups(docs, False, id_col, text_col, normalise)
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # Only rows in a group are looked up, and all of these have their digest.
    verdicts = found.where("group_size > 1").select(
        F.col("doc_id").alias("__key_id"), F.col("sha256").alias("__key_text"), "n", stays.alias("stays")
    )
    marked = docs.withColumns(
        {"__key_id": F.col(id_col).cast("long"), "__key_text": F.sha2(normalise(text_of(text_col)), 256)}
    )
    return one_row_each(marked, verdicts, ["__key_id", "__key_text"]).drop("__key_id", "__key_text")
