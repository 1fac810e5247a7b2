"""The five source CSV files (comma, header row, UTF-8).

Read with declared schemas (no inference), ``"`` as quote and escape. Two ways
with records that don't fit their schema:

* ``read_csv`` fails at the first one (FAILFAST), so nothing is dropped or padded;
* ``read_with_rejects`` stages the file once and gives the rows that fit and,
  beside them, every record that doesn't, with its file, to be counted and kept.

``read_sources`` takes the first way, or the second with ``rejects`` set: then
it fails when there are any, unless ``rejects="keep"`` asks to go on.

NULL versus empty text: an unquoted empty field (``,,``) is NULL and a
quoted empty field (``,"",``) is the empty string. Spark's reader maps both
to NULL by default, so the quoted form is read as a sentinel character and
translated back to ``''`` after parsing.

Scale: fields may hold line ends (``multiline``, the default), and then one file
is one task, so large inputs should arrive as many files. Files without line
ends in their fields are read with ``multiline=False``: they are split like any
text. A line end in a field that comes all the same makes records that don't
fit, which are found either way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart import schemas
from starmart.functions import parse_timestamp
from starmart.session import stage_rows
from starmart.sources.raw import RawSources

EMPTY_SENTINEL = "\u0001"

# The source file names.
FILE_NAMES = {
    "orders": "olist_orders_dataset.csv",
    "items": "olist_order_items_dataset.csv",
    "customers": "olist_customers_dataset.csv",
    "products": "olist_products_dataset.csv",
    "sellers": "olist_sellers_dataset.csv",
}


REJECTED = "__rejected"


class RejectedRecords(ValueError):
    """Records that don't fit their schema, in an input that must be whole."""


@dataclass(frozen=True)
class CsvInput:
    rows: DataFrame
    rejects: DataFrame  # file, record


def _reader(spark: SparkSession, schema: T.StructType, multiline: bool, mode: str):
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", ",")
        .option("encoding", "UTF-8")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", multiline)
        .option("mode", mode)
        .option("emptyValue", EMPTY_SENTINEL)
        .option("enforceSchema", False)
    )


def _empty_texts(schema: T.StructType) -> list[Column]:
    out = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            c = F.when(c == F.lit(EMPTY_SENTINEL), F.lit("")).otherwise(c)
        out.append(c.alias(f.name))
    return out


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """The rows of a file or folder; a record that doesn't fit fails the job."""
    df = _reader(spark, schema, multiline, "FAILFAST").csv(path)
    return df.select(*_empty_texts(schema))


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> CsvInput:
    """The rows that fit, and the records that don't. The file is parsed once, with all its columns, and staged."""
    whole = T.StructType([*schema.fields, T.StructField(REJECTED, T.StringType())])
    # A header that doesn't name the columns fails: no record of such a file can be trusted.
    df = _reader(spark, whole, multiline, "PERMISSIVE").option("columnNameOfCorruptRecord", REJECTED).csv(path)
    staged = stage_rows(df.select(*_empty_texts(schema), REJECTED, F.col("_metadata.file_path").alias("__file")))
    rejects = staged.where(F.col(REJECTED).isNotNull()).select(F.col("__file").alias("file"), F.col(REJECTED).alias("record"))
    return CsvInput(staged.where(F.col(REJECTED).isNull()).drop(REJECTED, "__file"), rejects)


def read_sources(
    spark: SparkSession,
    folder: str,
    names: dict[str, str] | None = None,
    multiline: bool = True,
    rejects: str | None = None,
) -> RawSources:
    """The five inputs from ``folder`` (each name may be a file or a folder).

    ``rejects``: None to fail in the job that reads a record that doesn't fit;
    ``"fail"`` to count them all first and raise ``RejectedRecords`` with the
    counts; ``"keep"`` to leave them out (``read_with_rejects`` gives them).
    """
    names = names or FILE_NAMES
    paths = {k: f"{folder.rstrip('/')}/{names[k]}" for k in schemas.RAW_SCHEMAS}
    if rejects is None:
        return RawSources(**{k: read_csv(spark, p, schemas.RAW_SCHEMAS[k], multiline) for k, p in paths.items()})
    found = {k: read_with_rejects(spark, p, schemas.RAW_SCHEMAS[k], multiline) for k, p in paths.items()}
    if rejects == "fail":
        counts = {k: n for k, x in found.items() if (n := x.rejects.count())}
        if counts:
            raise RejectedRecords(f"records that don't fit their schema: {counts}")
    return RawSources(**{k: x.rows for k, x in found.items()})


def text_orders(spark: SparkSession, path: str, multiline: bool = True) -> DataFrame:
    """The orders with their times as text, as the raw snapshot has them."""
    fields = [T.StructField(f.name, T.StringType()) for f in schemas.RAW_ORDERS.fields]
    return read_csv(spark, path, T.StructType(fields), multiline)


def typed_orders(orders: DataFrame) -> DataFrame:
    """Text times parsed where they are read; text that is no time, the empty one included, fails the job."""
    return orders.select(
        *[
            (parse_timestamp(f.name) if isinstance(f.dataType, T.TimestampNTZType) else F.col(f.name)).alias(f.name)
            for f in schemas.RAW_ORDERS.fields
        ]
    )
