"""Warehouse exports: the INSERT-statement dump and the table profile.

``dump_statements`` renders every row of the star tables as an
``INSERT INTO analytics.<table> (...) VALUES (...);`` line. It is a plain
projection — every task renders its own rows — so it runs in parallel at
any size; ``write_dump`` writes one text folder per step, numbered in replay
order, between BEGIN and COMMIT, with a manifest of checksums that ``read_dump``
holds the folders against. The orders snapshot is not dumped.

``table_profile`` lists each table with its row count and column list in one
plan; ``profile_report`` goes table by table and reports one that can't be read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from functools import partial, reduce

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import sql_literal
from starmart.sinks.warehouse import Warehouse

DUMP_SCHEMA_NAME = "analytics"


def insert_statements(df: DataFrame, table: str, schema_name: str = DUMP_SCHEMA_NAME) -> DataFrame:
    """One ``INSERT … VALUES (…);`` line per row, in column ``statement``."""
    cols = ", ".join(df.columns)
    values = F.concat_ws(", ", *[sql_literal(f.name, f.dataType) for f in df.schema.fields])
    return df.select(
        F.concat(
            F.lit(f"INSERT INTO {schema_name}.{table} ({cols}) VALUES ("), values, F.lit(");")
        ).alias("statement")
    )


def dump_statements(tables: dict[str, DataFrame], order: Iterable[str] = schemas.STAR_ORDER) -> DataFrame:
    """All tables' INSERT lines, tagged with the table and its replay position."""
    parts = [
        insert_statements(tables[name], name).select(
            F.lit(pos).alias("position"), F.lit(name).alias("table_name"), "statement"
        )
        for pos, name in enumerate(order, start=1)
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _checked(statements: DataFrame) -> tuple[int, int]:
    """(lines, sum of their CRC-32): the same whatever the order of the files."""
    row = statements.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.crc32(F.col("statement").cast("binary"))), F.lit(0))).first()
    return int(row[0]), int(row[1])


def write_dump(wh: Warehouse, out_dir: str) -> list[str]:
    """Write ``NN_<step>/`` text folders and ``manifest``; replayed in name order they restore the tables.

    ``00_begin`` opens a transaction, then come the tables in foreign-key order,
    and the last folder commits. The manifest has a row a folder, in replay
    order, with its lines and their checksum.
    """
    spark, out_dir, star = wh.spark, out_dir.rstrip("/"), wh.read_star_tables()

    def line(text: str) -> DataFrame:
        return spark.range(1).select(F.lit(text).alias("statement"))

    steps = [("begin", line("BEGIN;"))]
    steps += [(name, insert_statements(star[name], name)) for name in schemas.STAR_ORDER]
    steps.append(("commit", line("COMMIT;")))
    rows = []
    for pos, (name, statements) in enumerate(steps):
        folder = f"{pos:02d}_{name}"
        statements.write.mode("overwrite").text(f"{out_dir}/{folder}")
        rows.append((pos, folder, *_checked(_read_step(spark, out_dir, folder))))
    manifest = spark.createDataFrame(rows, MANIFEST).coalesce(1)
    manifest.write.mode("overwrite").option("header", True).csv(f"{out_dir}/manifest")
    return [f"{out_dir}/{r[1]}" for r in rows]


MANIFEST = "position int, folder string, lines long, checksum long"


def _read_step(spark: SparkSession, out_dir: str, folder: str) -> DataFrame:
    return spark.read.text(f"{out_dir}/{folder}").withColumnRenamed("value", "statement")


def read_dump(spark: SparkSession, out_dir: str) -> DataFrame:
    """``position, statement`` of a dump whose folders agree with its manifest; raises if one doesn't."""
    out_dir = out_dir.rstrip("/")
    steps = sorted(tuple(r) for r in spark.read.schema(MANIFEST).option("header", True).csv(f"{out_dir}/manifest").collect())
    parts = []
    for pos, folder, lines, checksum in steps:
        statements = _read_step(spark, out_dir, folder)
        found = _checked(statements)
        if found != (lines, checksum):
            raise ValueError(f"{folder} has {found}, the manifest {(lines, checksum)}")
        parts.append(statements.select(F.lit(pos).alias("position"), "statement"))
    return reduce(DataFrame.unionAll, parts)


def table_profile(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(tablename, record_count, columns_list) per table.

    One plan: the union of a count of each table (Parquet counts read file
    footers only). ``columns_list`` is the JSON array of column names.
    """
    parts = [
        df.agg(F.count(F.lit(1)).alias("record_count")).select(
            F.lit(name).alias("tablename"),
            "record_count",
            F.to_json(F.array(*[F.lit(c) for c in df.columns])).alias("columns_list"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def profile_report(spark: SparkSession, tables: dict[str, Callable[[], DataFrame]]) -> DataFrame:
    """(tablename, record_count, columns_list) as text, a table at a time.

    A table that can't be planned or read has the class of its error in the
    cells, and the others are reported all the same. Counts come from the
    Parquet footers.
    """
    rows = []
    for name, read in tables.items():
        try:
            df = read()
            rows.append((name, str(df.count()), json.dumps(df.columns, separators=(",", ":"))))
        except (PySparkException, Py4JError, OSError) as e:
            said = (e.getCondition() if isinstance(e, PySparkException) else None) or type(e).__name__
            rows.append((name, f"error: {said}", f"error: {said}"))
    return spark.createDataFrame(rows, "tablename string, record_count string, columns_list string")


def write_profile(spark: SparkSession, wh: Warehouse, out_path: str) -> DataFrame:
    profile = profile_report(spark, {name: partial(wh.read, name) for name in wh.tables()})
    profile.coalesce(1).write.mode("overwrite").option("header", True).csv(out_path)
    return profile
