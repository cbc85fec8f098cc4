"""Every query of the catalog against its DuckDB twin on the smallest tables."""

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from barline.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(df):
    """Rows as sorted tuples of texts; numbers to nine digits."""

    def cell(x):
        if x is None or x is pd.NaT or (isinstance(x, float) and x != x):
            return ""
        if isinstance(x, (int, float)) or hasattr(x, "dtype"):
            return f"{float(x):.9g}"
        return str(x).removesuffix(" 00:00:00")

    return sorted(tuple(cell(x) for x in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False))


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_twin(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, SF).toPandas(), duck.sql(catalog.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert plain(got) == plain(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
