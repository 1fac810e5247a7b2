"""One query for each operator, over its whole table, and its SQL where SQL can say it.

Each query reads ``documents`` or ``pages`` and applies its operator with the
parameters of production; columns that only a digest needs are worked out here.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm import (
    block_search,
    bpe,
    exact_dedup,
    fim,
    hilbert,
    line_dedup,
    mixing,
    repetition,
    secret_scan,
    simhash,
    warc,
    wavelet,
    whitening,
)
from starmart.llm.common import text_of

SHARDS = 16
LAYOUT = fim.Layout("<P>", "<S>", "<M>", plain_percent=10, spm_percent=20, salt="1")
NEAREST = 20
ASKED_EVERY = 20


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def _embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/embeddings.parquet")


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/pages.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.drop_boilerplate(_pages(spark, sf_dir))


def op2_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archives(spark, warc.write_archives(_pages(spark, sf_dir)))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_documents(spark, sf_dir), words=4, distance=4)


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_documents(spark, sf_dir), digest_all=True)


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.encode_digests(_documents(spark, sf_dir), ranks, public_tokenizers.PATTERN)


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select(
        "doc_id",
        "source",
        "lang",
        (F.octet_length(text_of()) + 1).cast("long").alias("size"),
        F.crc32(text_of().cast("binary")).alias("text_crc32"),
    )
    docs = hilbert.with_text_rank(hilbert.with_text_rank(docs, "source", "source_rank"), "lang", "lang_rank")
    dims = [F.col("source_rank"), F.col("lang_rank"), F.col("size"), F.col("doc_id")]
    placed = hilbert.shard_rows(docs, dims, SHARDS, then=[F.col("text_crc32"), F.col("doc_id")])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_documents(spark, sf_dir), share_percent=150, max_epochs=2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source")


def op9_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    folder, manifest = wavelet.write_shards(_documents(spark, sf_dir), path, end_id=0)
    return wavelet.read_shards(spark, folder, manifest)


def op10_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(_documents(spark, sf_dir))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.digests(fim.transform(_documents(spark, sf_dir), LAYOUT), LAYOUT)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(_embeddings(spark, sf_dir), components=4, scale=256)
    return white.withColumn("deviation", F.col("deviation").cast("long"))


def op13_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = F.col("vec_id") % ASKED_EVERY == 0
    return block_search.nearest(_embeddings(spark, sf_dir), asked, NEAREST)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_warc_revisits,
        op3_simhash,
        op4_secret_scan,
        op5_exact_dedup,
        op6_byte_bpe,
        op7_hilbert_shards,
        op8_mixing,
        op9_wavelet,
        op10_suffix_repetition,
        op11_fill_in_middle,
        op12_whitening,
        op13_block_search,
        pipeline,
    )
}

_WHITE = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE_SQL = {
    # Patterns, ratio and the least number of pages are stated anew here, in another form than the operator's.
    "op1_line_dedup": rf"""
WITH p AS (
  SELECT row_number() OVER () AS r, page_id, lower(coalesce(nullif(regexp_extract(coalesce(url, ''),
           '^[a-zA-Z][-a-zA-Z0-9+.]*://([^#?/@]*@)?([^#?/:]*)', 2), ''), '')) AS host,
         regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
           '(?is:<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<head\b.*?</head\s*>)', chr(10), 'g'),
           '(?i)</?(a(rticle|side)|b(r|ody)|div|footer|h([1-6]|eader|tml)|li|main|nav|[ou]l|p|section|t(able|d|h|itle|r))\b[^>]*>',
           chr(10), 'g'), '<[^>]*>', '', 'g') AS t
  FROM pages),
c AS (
  SELECT r, page_id, host, count(*) OVER (PARTITION BY host) AS host_pages,
         list_filter(list_transform(string_split(t, chr(10)), lambda x: trim(x, {_WHITE})), lambda x: x <> '') AS lines
  FROM p),
u AS (SELECT DISTINCT r, host, host_pages, unnest(lines) AS line FROM c),
often AS (
  SELECT host, line FROM u GROUP BY host, line, host_pages
  HAVING count(*) >= 2 AND count(*) > 0.3::DOUBLE * host_pages),
bad AS (SELECT host, list(line) AS b FROM often GROUP BY host),
k AS (
  SELECT c.*, list_filter(lines, lambda x: NOT list_contains(coalesce(b, []), x)) AS kept
  FROM c LEFT JOIN bad USING (host))
SELECT page_id, host, host_pages, CAST(len(lines) AS BIGINT) AS n_lines,
       CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped, coalesce(array_to_string(kept, chr(10)), '') AS text
FROM k
""",
    "op2_warc_revisits": f"""
WITH p AS (
  SELECT page_id, url, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS n FROM pages),
o AS (
  SELECT *, row_number() OVER (PARTITION BY body ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS place,
         max(page_id) OVER (PARTITION BY body) AS first_id
  FROM p)
SELECT page_id, url AS target_uri, CAST(n AS BIGINT) AS payload_bytes, sha1(body) AS payload_digest,
       CASE WHEN n >= {warc.MIN_BYTES} AND place > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= {warc.MIN_BYTES} AND place > 1 THEN first_id END AS refers_to
FROM o
""",
    "op5_exact_dedup": """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
    "op11_fill_in_middle": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n,
         CAST('0x' || substr(x, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(x, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(x, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(x, 25, 8) AS BIGINT) AS h4
  FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM h),
p AS (
  SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
""",
    "op13_block_search": """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON c.r <> q.r WHERE q.vec_id % 20 = 0),
o AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS place FROM p)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM o WHERE place <= 20
""",
}
