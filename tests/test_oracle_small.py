"""Every query with an oracle, against DuckDB on sf0.001 (the driver uses sf0.01); one whose
columns are those of the data at sf0.01 runs there."""

import duckdb
import pytest

import __spark_entry__ as E
from cardlens.sources.tables import TABLES, table_path
from tools.oracle_check import rows_of

from .conftest import SF_SMALL

SQL = E.oracle_sql()


SF_FIT = "/root/testdata/sf0.01"
FITTED = {"onehot_weighted_sum", "card_vector"}


@pytest.fixture(scope="module")
def connect():
    made = {}

    def at(sf):
        if sf not in made:
            made[sf] = duckdb.connect()
            for t in TABLES:
                made[sf].execute(f"create view {t} as select * from read_parquet('{table_path(sf, t)}')")
        return made[sf]
    return at


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, connect, name):
    sf = SF_FIT if name in FITTED else SF_SMALL
    con = connect(sf)
    df = E.queries()[name](spark, sf)
    scols, srows = df.columns, [tuple(r) for r in df.collect()]
    res = con.execute(SQL[name])
    dcols, drows = [d[0] for d in res.description], res.fetchall()
    assert sorted(scols) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(scols, srows) == rows_of(dcols, drows)
