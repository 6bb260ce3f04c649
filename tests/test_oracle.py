"""Every registered query against its DuckDB reference SQL (as the driver compares)."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tools.check_oracle import TABLES, digest

KEYS = sorted(E.oracle_sql())  # queries without reference SQL have their own tests


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_reference_sql():
    from lakeweave.oracle import oracle_sql
    from lakeweave.registry import queries

    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_reference(spark, duck, key):
    df = E.queries()[key](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[key])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["observation_year", "country_id", "country_name", "station_count",
                          "avg_tmax_celsius", "avg_tmin_celsius", "avg_yearly_precip_mm"]
