import os

import duckdb
import pytest

from litholake.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, data, name):
    df = QUERIES[name](spark, data)
    cols = sorted(df.columns)
    con = duckdb.connect()
    for f in os.listdir(data):
        con.sql(f"create view {f.removesuffix('.parquet')} as select * from '{data}/{f}'")
    want = con.sql(f"select {', '.join(cols)} from ({ORACLES[name]})").fetchall()
    assert sorted(map(tuple, df.select(*cols).collect())) == sorted(want)
