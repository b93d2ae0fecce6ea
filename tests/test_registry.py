"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as E
from smogline.plans import registry
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return v


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(_norm(r[c]) for c in cols) for r in df[cols].to_dict("records")), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


# Corpus queries have tests of their own beside their operators.
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_oracle(spark, con, name):
    pdf = E.queries()[name](spark, SF_SMALL).toPandas()
    sql = E.oracle_sql().get(name)
    if sql is None:
        assert len(pdf) > 0 and len(pdf.columns) == len(set(pdf.columns))
        return
    odf = con.execute(sql).df()
    assert sorted(pdf.columns) == sorted(odf.columns)
    assert len(pdf) == len(odf)
    assert _rows(pdf) == _rows(odf)
