"""Every registered query against its SQL oracle (DuckDB) on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(df: pd.DataFrame):
    cols = []
    for c in sorted(df.columns):
        s = df[c]
        if s.dtype.kind in "fiu" or str(s.dtype) in ("Int64", "Int32", "Float64", "Float32"):
            vals = ["NULL" if pd.isna(x) else repr(round(float(x), 6)) for x in s.astype("float64")]
        else:
            vals = ["NULL" if x is None or (not isinstance(x, str) and pd.isna(x)) else str(x) for x in s]
        cols.append(vals)
    return sorted(zip(*cols))


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    exp = con.execute(E.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(exp.columns)
    assert _norm(got) == _norm(exp)


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert "metric" in df.columns
