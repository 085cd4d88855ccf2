"""Every registered query against its DuckDB oracle SQL at sf0.001 (the driver
runs the same check at sf0.01)."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from vhist.plans import catalog
from tools.check_oracle import TABLES, digest

SF = "/root/testdata/sf0.001"
QUERIES = dict(catalog.QUERIES)
ORACLES = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns[:8] == ["BusinessKey", "RowHashKey", "SnapshotDate", "FirstSnapshot", "ValidFrom",
                              "ValidTo", "IsDeleted", "GDPR_Compliant"]
    assert df.count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    ocols = [d[0] for d in cur.description]
    orows = cur.fetchall()
    assert sorted(c.lower() for c in df.columns) == sorted(c.lower() for c in ocols)
    assert len(srows) == len(orows)
    assert digest(df.columns, srows)[0] == digest(ocols, orows)[0]
