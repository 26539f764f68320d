"""Every registered query runs on sf0.001 and agrees with its oracle, unrounded."""

import duckdb
import pytest

from capgrid.plans.fixtures import BASE_TABLES
from capgrid.plans.queries import ORACLES, QUERIES

from compare import differences

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rows = df.collect()
    if name not in ORACLES:
        assert len(df.columns) > 0
        return
    res = duck.execute(ORACLES[name])
    cols = [c[0] for c in res.description]
    assert differences(rows, df.columns, res.fetchall(), cols) == []


def test_entry_runs(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
