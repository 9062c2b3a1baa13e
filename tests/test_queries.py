"""Every query with SQL against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = [n for n in entry.oracle_sql() if not n.startswith("op") and n != "pipeline"]


@pytest.fixture(scope="module")
def con(sf):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, sf, con, name):
    got = entry.queries()[name](spark, sf).toPandas()
    want = con.execute(entry.oracle_sql()[name]).fetch_df()
    cols = sorted(want.columns)
    assert sorted(got.columns) == cols

    def rows(df):
        return df[cols].astype(object).where(df[cols].notna(), None).astype(str).sort_values(cols).reset_index(drop=True)

    assert rows(got).equals(rows(want))


def test_entry(spark):
    assert entry.entry(spark).count() == 6
