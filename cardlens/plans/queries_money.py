"""Queries over currency conversion and dictionaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardlens.functions.money import flat_converted
from cardlens.operators import asof as A
from cardlens.plans.catalog import query
from cardlens.sources import ingest as I
from cardlens.sources import views as V
from cardlens.sources.tables import read_table


def rate_files(spark, sf):
    """The fx view written as the two exchange-rate CSV files the card job reads
    (TICKER, DATE, OPEN, WAPRICE).  The euro file lacks the weighted price on
    days divisible by 5, so the open-price fallback is exercised."""
    fx = V.fx(spark, sf)
    date = F.date_format(F.date_from_unix_date("day"), "yyyy-MM-dd")
    out = {}
    for code, ticker in ((840, "USD000UTSTOM"), (978, "EUR_RUB__TOM")):
        r = fx.filter(F.col("code") == code)
        wap = F.col("rate").cast("double")
        if code == 978:
            wap = F.when(F.col("day") % 5 == 0, F.lit(None).cast("double")).otherwise(wap)
        lines = r.select(F.lit(ticker).alias("TICKER"), date.alias("DATE"),
                         (F.col("rate") + 1).cast("double").alias("OPEN"), wap.alias("WAPRICE"))
        out[code] = I.write_csv(lines, I.materialise(spark, f"rates-{code}"))
    return out


@query("fx_rates")
def q_fx_rates(spark, sf):
    files = rate_files(spark, sf)
    usd = I.read_rates_csv(spark, files[840], 840, fallback_open=False)
    eur = I.read_rates_csv(spark, files[978], 978, fallback_open=False)
    return I.last_per_day(usd.unionByName(eur))


@query("fx_rates_fallback")
def q_fx_rates_fallback(spark, sf):
    files = rate_files(spark, sf)
    return I.last_per_day(I.read_rates_csv(spark, files[978], 978, fallback_open=True))


@query("fx_flat")
def q_fx_flat(spark, sf):
    t = V.tx_e(spark, sf)
    amt, cur = flat_converted("amount", "currency")
    return t.select("cl_id", "tx_id", amt.alias("amount_flat"), cur.alias("currency_flat"))


@query("fx_asof_tolerance")
def q_fx_asof_tolerance(spark, sf):
    t = A.convert_with_tolerance(V.tx_e(spark, sf), V.fx(spark, sf))
    return t.select("cl_id", "tx_id", "currency", "amount_rub")


@query("fx_asof_unbounded")
def q_fx_asof_unbounded(spark, sf):
    t = A.convert_unbounded(V.tx_e(spark, sf), V.fx(spark, sf))
    return t.select("cl_id", "tx_id", "currency", "amount_rub")


def mcc_file(spark, sf):
    """The whole part table written as the MCC dictionary text file (mcc, type, category)."""
    p = read_table(spark, sf, "part")
    lines = p.select(F.concat_ws(",", F.col("p_partkey").cast("string"), "p_type", "p_brand").alias("value"))
    return I.write_lines(lines, I.materialise(spark, "mcc-codes"))


@query("mcc_dim")
def q_mcc_dim(spark, sf):
    return I.read_mcc_dictionary(spark, mcc_file(spark, sf))


@query("mcc_lookup")
def q_mcc_lookup(spark, sf):
    t = A.lookup(V.tx_l(spark, sf), V.mcc_dim(spark, sf), "mcc")
    return t.select("cl_id", "tx_id", "mcc", "mcc_category")


@query("mcc_unmatched")
def q_mcc_unmatched(spark, sf):
    return A.unmatched(V.tx_l(spark, sf), V.mcc_dim(spark, sf), "mcc").select("cl_id", "tx_id", "mcc")


@query("fx_asof_seconds")
def q_fx_asof_seconds(spark, sf):
    """The latest quote of the row's currency at or before its time: quotes are the purchases in dollars and euros."""
    t, quotes = V.tx_e(spark, sf), V.fx_quotes(spark, sf)
    return A.asof_join(t, quotes, "currency", "ts").select("cl_id", "tx_id", "rate", "rate_ts")


@query("fx_asof_seconds_tolerance")
def q_fx_asof_seconds_tolerance(spark, sf):
    """The same with quotes of the last two hours only."""
    t, quotes = V.tx_e(spark, sf), V.fx_quotes(spark, sf)
    return A.asof_join(t, quotes, "currency", "ts", tolerance_seconds=7200).select("cl_id", "tx_id", "rate")
