"""Driver contract and plan shapes."""

import __spark_entry__ as E
from cardlens.operators.sequence import with_previous
from cardlens.sources import views as V

from .conftest import SF_SMALL


def test_contract_keys():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(q) >= 90


def test_entry_runs(spark):
    df = E.entry(spark)
    assert "cl_id" in df.columns and len(df.columns) > 300
    assert df.count() > 0


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_and_columns_pushed_to_scan(spark):
    from pyspark.sql import functions as F
    df = V.tx_o(spark, SF_SMALL).filter(F.col("category") == "1-URGENT").select("cl_id", "amount")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_totalprice:double,o_orderpriority:string>" in p


def test_previous_row_not_partitioned_by_client_only(spark):
    # more shares than clients: every client is cut
    df = with_previous(V.tx_e(spark, SF_SMALL).select("cl_id", "ts", "tx_id"), ["cl_id"], "ts", "tx_id", shares=200)
    p = df._jdf.queryExecution().optimizedPlan().toString()
    # the row-level window is keyed by (client, bucket), never by the client alone
    rows_window = [line for line in p.splitlines() if "Window [lag(ts" in line]
    assert rows_window and all("_bkt" in line for line in rows_window)


def test_small_fx_calendar_is_broadcast_by_its_size(spark):
    from cardlens.operators.asof import convert_with_tolerance
    df = convert_with_tolerance(V.tx_e(spark, SF_SMALL), V.fx(spark, SF_SMALL))
    df.collect()
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()
