"""The five inputs written as CSV and loaded from there give the same star."""

import os
import tempfile

from starmart.load import run_load
from starmart.sinks.warehouse import Warehouse
from starmart.sources.csv import FILE_NAMES, read_sources
from starmart.sources.testdata import load_testdata

SF = "/root/testdata/sf0.001"


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_csv_inputs_load_like_the_tables(spark):
    raw = load_testdata(spark, SF)
    d = tempfile.mkdtemp(prefix="starmart-csvrt-")
    for name, df in raw.as_dict().items():
        # a folder of part files per input, as large inputs should arrive
        df.write.option("header", True).option("escape", '"').csv(os.path.join(d, FILE_NAMES[name]))
    from_csv = read_sources(spark, d)
    for name, df in raw.as_dict().items():
        assert _rows(getattr(from_csv, name)) == _rows(df), name

    a, b = tempfile.mkdtemp(prefix="wh-a-"), tempfile.mkdtemp(prefix="wh-b-")
    run_load(spark, raw, a, load_date="2024-01-01", stage_inputs=False, audit=False)
    run_load(spark, from_csv, b, load_date="2024-01-01", audit=False)
    sa, sb = Warehouse(spark, a).read_star_tables(), Warehouse(spark, b).read_star_tables()
    for name in sa:
        assert _rows(sa[name]) == _rows(sb[name]), name
