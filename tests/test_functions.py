import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.functions import (
    clean_id,
    elapsed_days,
    first_of_month,
    iso_day_of_week,
    iso_week,
    label,
    months_between_starts,
    sql_literal,
    year_month,
)
from starmart.functions.dates import make_period


def test_iso_calendar_edges(spark):
    df = spark.createDataFrame([(dt.date(2017, 1, 1),), (dt.date(2018, 12, 31),)], "d date")
    got = {r.d: (r.dow, r.wk, r.ym) for r in df.select("d", iso_day_of_week("d").alias("dow"), iso_week("d").alias("wk"), year_month("d").alias("ym")).collect()}
    assert got[dt.date(2017, 1, 1)] == (7, 52, "2017-01")
    assert got[dt.date(2018, 12, 31)] == (1, 1, "2018-12")


def test_clean_id_removes_every_hyphen_and_keeps_null(spark):
    df = spark.createDataFrame([("abc-123",), ("a-b-c",), (None,)], "x string")
    assert [r[0] for r in df.select(clean_id("x")).collect()] == ["abc123", "abc", None]


def test_month_arithmetic_and_elapsed_days(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2017, 11, 30, 12, 0), dt.datetime(2018, 2, 1, 0, 0))],
        T.StructType([T.StructField("a", T.TimestampNTZType()), T.StructField("b", T.TimestampNTZType())]),
    )
    r = df.select(
        first_of_month("a").alias("fa"),
        months_between_starts(first_of_month("b"), first_of_month("a")).alias("m"),
        elapsed_days("a", "b").alias("days"),
        make_period(F.lit(2018), F.lit(3)).alias("p"),
    ).first()
    assert r.fa == dt.date(2017, 11, 1)
    assert r.m == 3
    assert abs(r.days - 62.5) < 1e-12
    assert r.p == dt.date(2018, 3, 1)


def test_label_and_sql_literals(spark):
    df = spark.createDataFrame(
        [(7, "O'Brian", dt.date(2020, 1, 2), True, Decimal("5.00")), (8, None, None, None, None)],
        "k bigint, t string, d date, b boolean, m decimal(10,2)",
    )
    rows = df.select(
        label("item: ", "k").alias("l"),
        sql_literal("t", T.StringType()).alias("t"),
        sql_literal("d", T.DateType()).alias("d"),
        sql_literal("b", T.BooleanType()).alias("b"),
        sql_literal("m", T.DecimalType(10, 2)).alias("m"),
    ).collect()
    assert tuple(rows[0]) == ("item: 7", "'O''Brian'", "'2020-01-02'", "True", "5.00")
    assert tuple(rows[1]) == ("item: 8", "NULL", "NULL", "NULL", "NULL")


def test_timestamp_parsing_and_period(spark):
    import pytest

    from starmart.functions import parse_timestamp, try_parse_timestamp
    from starmart.plans.analytics import with_period

    df = spark.createDataFrame([("2017-10-02 10:56:33",), ("",)], "t string")
    got = [r[0] for r in df.select(try_parse_timestamp("t")).collect()]
    assert got == [dt.datetime(2017, 10, 2, 10, 56, 33), None]
    assert df.limit(1).select(parse_timestamp("t")).first()[0] == dt.datetime(2017, 10, 2, 10, 56, 33)
    with pytest.raises(Exception):
        df.where("t = ''").select(parse_timestamp("t")).collect()
    m = spark.createDataFrame([(2018, 3, 1.0)], "year int, month int, v double")
    assert with_period(m).first().periodo == dt.date(2018, 3, 1)
    assert "periodo" not in with_period(df).columns
