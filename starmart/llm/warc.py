"""WARC archives: revisit resolution and deduplicated writing.

Headers (id, address, payload digest and length) are shuffled by payload
digest; of records with equal payloads the one with the largest id is the
response and every other becomes a revisit that refers to it. Then archives
are written with fresh headers: responses with their payload, revisits with
headers alone, so each payload is stored once.

Payloads move only where a digest occurs twice: the scan asks a set of at most
``BUCKETS`` digest buckets (broadcast; its size doesn't grow with the data)
whether a record may have an equal, and all others go straight to the file.
Groups are pre-aggregated, so a payload that a third of all records share
is one row for each task that has read it.

Archives are written by Spark's text sink, record by record, with the record
end ``\\r\\n\\r\\n`` as its line end: a task that runs again replaces its
files at commit, on any store Spark writes to. Files hold about ``FILE_BYTES``
of payload, gzip-compressed, and are read back whole, record by record, by their
Content-Length.

Defined results: a null html is an empty payload; payloads shorter than
``min_bytes`` are responses always; repeated rows are records of their own, of
which one is the response; null ids rank lowest; a null address has no
WARC-Target-URI; an empty table gives no record; columns other than the three
named are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.common import shared_folder, stage

BUCKETS = 1 << 18
FILE_BYTES = 32_000_000
MIN_BYTES = 1000
END = "\r\n"
_KEY = ["payload_digest", "full_digest", "payload_bytes"]
RESPONSE, REVISIT = "response", "revisit"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"


def headers(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """``page_id, url``, the payload and its digests. SHA-1 is the WARC's; SHA-256 tells SHA-1 collisions apart."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload")
    )
    return rows.withColumns(
        {
            "payload_digest": F.sha1("payload"),
            "full_digest": F.sha2("payload", 256),
            "payload_bytes": F.octet_length("payload").cast("long"),
        }
    )


def resolve(pages: DataFrame, min_bytes: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Records to write: ``page_id, url, payload_digest, payload_bytes, record_type, refers_to, payload, copy``."""
    heads = headers(pages, id_col, url_col, html_col)
    long_enough = F.col("payload_bytes") >= min_bytes
    bucket = F.pmod(F.xxhash64("payload_digest"), F.lit(BUCKETS)).cast("int")
    twice = heads.where(long_enough).groupBy(*_KEY).count().where("count > 1")
    buckets = stage(twice.select(bucket.alias("__b")).distinct())
    marked = heads.withColumn("__bucket", F.when(long_enough, bucket))
    on = F.col("__bucket") == F.col("__b")
    out = ["page_id", "url", "payload_digest", "payload_bytes", "record_type", "refers_to", "payload", "copy"]
    none = F.lit(None).cast("long").alias("refers_to")
    # What tells records of one page and payload apart: the row's number, or the number among equal rows.
    row = F.concat(F.lit("row"), F.monotonically_increasing_id().cast("string")).alias("copy")
    single = marked.join(F.broadcast(buckets), on, "left_anti").select(
        *out[:4], F.lit(RESPONSE).alias("record_type"), none, "payload", row
    )
    if buckets.isEmpty():
        return single
    shared = marked.join(F.broadcast(buckets), on, "left_semi")
    # Headers of possible copies, equal ones counted.
    keys = stage(shared.groupBy("page_id", "url", *_KEY).agg(F.count(F.lit(1)).alias("n")))
    first = F.max(F.struct("page_id", "url"))
    best = stage(keys.groupBy(*_KEY).agg(first.alias("best")))
    # Equal payloads: any of a group's is the response's.
    payloads = shared.groupBy(*_KEY).agg(F.first("payload").alias("payload"))
    responses = payloads.join(best, _KEY).select(
        "best.page_id", "best.url", "payload_digest", "payload_bytes", F.lit(RESPONSE).alias("record_type"), none, "payload",
        F.substring("full_digest", 1, 16).alias("copy"),
    )
    is_best = F.col("page_id").eqNullSafe(F.col("best.page_id")) & F.col("url").eqNullSafe(F.col("best.url"))
    others = keys.join(best, _KEY).withColumn("n", F.col("n") - F.when(is_best, 1).otherwise(0)).where("n > 0")
    revisits = others.withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).select(
        *out[:4], F.lit(REVISIT).alias("record_type"), F.col("best.page_id").alias("refers_to"), F.lit("").alias("payload"),
        F.concat(F.substring("full_digest", 1, 16), F.lit(":"), F.hex(F.xxhash64("url")), F.lit("."), F.col("i").cast("string")).alias("copy"),
    )
    return single.unionByName(responses).unionByName(revisits)


def _field(name: str, value: Column) -> Column:
    """A header line, nothing for null. Control characters can't break out of it."""
    safe = F.regexp_replace(value.cast("string"), r"[\x00-\x1f\x7f]", "%20")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(END)), F.lit(""))


def _urn(page_id: Column, copy: Column) -> Column:
    """The page, the payload and what tells equal ones apart: no two records have the same."""
    page = F.coalesce(page_id.cast("string"), F.lit("none"))
    return F.concat(F.lit("<urn:page:"), F.concat_ws(":", page, F.col("payload_digest"), copy), F.lit(">"))


def record(date: str) -> Column:
    """The record as text, without the two line ends behind it."""
    revisit = F.col("record_type") == REVISIT
    return F.concat(
        F.lit("WARC/1.0" + END),
        _field("WARC-Type", F.col("record_type")),
        _field("WARC-Record-ID", _urn(F.col("page_id"), F.col("copy"))),
        _field("WARC-Date", F.lit(date)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        _field("X-Payload-Length", F.col("payload_bytes")),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field("WARC-Refers-To", F.when(revisit, _urn(F.col("refers_to"), F.substring_index("copy", ":", 1)))),
        _field("Content-Type", F.lit("text/html;charset=utf-8")),
        _field("Content-Length", F.octet_length("payload")),
        F.lit(END),
        F.col("payload"),
    )


def write_archives(
    pages: DataFrame,
    path: str | None = None,
    min_bytes: int = MIN_BYTES,
    date: str = "1970-01-01T00:00:00Z",
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> str:
    """Writes the deduplicated archives (``*.gz``) to ``path`` or a fresh shared folder; returns it."""
    path = path or shared_folder(pages.sparkSession)
    length = F.octet_length(F.coalesce(F.col(html_col).cast("string"), F.lit("")))
    mean = pages.agg(F.avg(length)).first()[0] or 0
    found = resolve(pages, min_bytes, id_col, url_col, html_col)
    (
        found.select(record(date).alias("value"))
        .write.option("lineSep", END * 2)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", max(1, int(FILE_BYTES / (mean + 500))))
        .text(path)
    )
    return path


def parse(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """``(header fields in lower case, payload)`` of each record."""
    at = 0
    while at < len(data):
        if data[at : at + 5] != b"WARC/":
            raise ValueError(f"no WARC record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode().split("\r\n")[1:]
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"a record's length is wrong at byte {at}")
        yield fields, data[start:stop]
        at = stop + 4


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">").split(":")[0]
    return int(number) if number not in ("", "none") else None


def read_archives(spark: SparkSession, path: str, payloads: bool = False) -> DataFrame:
    """``page_id, target_uri, payload_bytes, payload_digest, record_type, refers_to`` and, if asked, ``payload``.

    A response's digest and length are those of the payload as read; a record that
    contradicts its headers raises.
    """
    schema = pa.schema(
        [
            ("page_id", pa.int64()),
            ("target_uri", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload_digest", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            *([("payload", pa.binary())] if payloads else []),
        ]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                found, held = [], 0
                data = zlib.decompress(content.as_buffer().to_pybytes(), wbits=31)
                for fields, payload in parse(data):
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    size = int(fields["x-payload-length"])
                    kind = fields["warc-type"]
                    if kind == RESPONSE and (hashlib.sha1(payload).hexdigest() != digest or len(payload) != size):
                        raise ValueError(f"the payload of {fields['warc-record-id']} isn't what its header says")
                    row = [_page(fields["warc-record-id"]), fields.get("warc-target-uri"), size, digest, kind]
                    row.append(_page(fields.get("warc-refers-to")))
                    found.append(tuple(row + [payload] * payloads))
                    held += len(payload) * payloads + 200
                    if held > 8_000_000:
                        yield _batch(found, schema)
                        found, held = [], 0
                if found:
                    yield _batch(found, schema)

    names = "page_id long, target_uri string, payload_bytes long, payload_digest string, record_type string, refers_to long"
    names += ", payload binary" * payloads
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/part-*")
    if not hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop):
        return spark.createDataFrame([], names)
    files = spark.read.format("binaryFile").load(f"{path}/part-*")
    return files.where("length > 0").select("content").mapInArrow(rows, names)


def _batch(found: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)
