import os

import duckdb
import pytest

import __spark_entry__ as entry
from litholake.plans import catalogue


def norm(v):
    return ("nan" if v != v else round(v, 6)) if isinstance(v, float) else v


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query_equals_sql(spark, data, name):
    df = catalogue.QUERIES[name](spark, data)
    cols = sorted(df.columns)
    con = duckdb.connect()
    con.sql("set TimeZone='UTC'")
    for f in os.listdir(data):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{data}/{f}'")
    want = con.sql(f"select {', '.join(chr(34) + c + chr(34) for c in cols)} from ({catalogue.ORACLES[name]})").fetchall()
    assert sorted(repr(tuple(map(norm, r))) for r in df.select(*cols).collect()) == sorted(repr(tuple(map(norm, r))) for r in want)
