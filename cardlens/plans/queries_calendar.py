"""Queries over row-level calendar columns, parsing and tenure."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardlens.functions import calendar as cal
from cardlens.functions.config import events_fixture, orders_fixture
from cardlens.functions.money import signed_amount
from cardlens.operators import tenure as T
from cardlens.operators.recency import with_last_action
from cardlens.operators.dictionary import with_category_code
from cardlens.plans.catalog import query
from cardlens.sources import views as V


def trx_time_text():
    """Transaction time as the card log writes it (ddMMMyy:HH:mm:ss), in
    upper, lower and mixed case, with unparseable text on 'error' rows."""
    fmt = F.date_format("ts", cal.TRX_TIME_FORMAT)
    text = (F.when(F.col("tx_id") % 3 == 0, F.upper(fmt)).when(F.col("tx_id") % 3 == 1, F.lower(fmt))
            .otherwise(fmt))
    return F.when(F.col("category") == "error", F.concat(F.lit("bad"), F.col("tx_id").cast("string"))).otherwise(text)


@query("parse_trx_time")
def q_parse_trx_time(spark, sf):
    t = V.tx_e(spark, sf).withColumn("raw", trx_time_text())
    return (t.select("cl_id", "tx_id", cal.parse_trx_time("raw").alias("trx_time"))
            .filter(F.col("trx_time").isNotNull()))


@query("iso_weekday")
def q_iso_weekday(spark, sf):
    t = V.tx_e(spark, sf).withColumn("raw", trx_time_text())
    return t.select("cl_id", "tx_id", cal.iso_weekday_or_zero(cal.parse_trx_time("raw")).alias("iso_weekday"))


@query("parse_period")
def q_parse_period(spark, sf):
    t = V.tx_o(spark, sf)
    text = F.when(F.col("channel") == "P", F.lit("31/02/1999")).otherwise(
        F.date_format(F.trunc("ts", "MM"), cal.PERIOD_FORMAT))
    p = cal.parse_period(text)
    return t.select("cl_id", "tx_id", p.alias("period"), cal.month_index(p).alias("period_month"))


@query("calendar_fields")
def q_calendar_fields(spark, sf):
    t = V.tx_e(spark, sf)
    return t.select(
        "cl_id", "tx_id", F.hour("ts").alias("tr_hour"), cal.day_part(F.hour("ts")).alias("day_part"),
        cal.weekday0("ts").alias("week_day"), cal.epoch_day("ts").alias("global_day_number"),
        cal.epoch_week("ts").alias("week_global_number"), cal.quarter0("ts").alias("quartel"),
        cal.base_month_index("ts", 2016).alias("month"), F.dayofmonth("ts").alias("day"),
        F.year("ts").alias("year"), cal.days_since("ts", "2015-01-01").alias("days_since"),
        cal.month_index(F.trunc("ts", "MM")).alias("period_month"))


@query("holiday_flag")
def q_holiday_flag(spark, sf):
    cfg = events_fixture()
    return V.tx_e(spark, sf).select("cl_id", "tx_id", cal.holiday_flag("ts", cfg.holidays).alias("is_holiday"))


@query("channel_code")
def q_channel_code(spark, sf):
    return V.tx_e(spark, sf).select("cl_id", "tx_id", cal.channel_code("channel_type").alias("channel_code"))


@query("category_code")
def q_category_code(spark, sf):
    return with_category_code(V.tx_e(spark, sf), "category", "cat_index").select("cl_id", "tx_id", "cat_index")


@query("period_part_buckets")
def q_period_part_buckets(spark, sf):
    cfg = events_fixture()
    t = T.tenure_fields(V.tx_e(spark, sf))
    return t.select("cl_id", "tx_id", "day_number",
                    *[cal.period_part("day_number", n).alias(f"period_part_{n}") for n in cfg.period_parts])


@query("tenure_fields")
def q_tenure_fields(spark, sf):
    t = T.tenure_fields(V.tx_o(spark, sf))
    return t.select("cl_id", "tx_id", "period_month", "months_before_last", "week_number", "day_number",
                    "transaction_day", "period_number", "transaction_week")


@query("day_diff")
def q_day_diff(spark, sf):
    t = T.tenure_fields(V.tx_e(spark, sf), day_diff="day_diff")
    return t.select("cl_id", "tx_id", "day_number", "day_diff")


@query("tenure_cut")
def q_tenure_cut(spark, sf):
    cfg = orders_fixture()
    return T.tenure_cut(V.tx_o(spark, sf), cfg.max_transaction_day).select("cl_id", "tx_id", "transaction_day")


@query("last_action_backjoin")
def q_last_action_backjoin(spark, sf):
    cfg = events_fixture()
    t = with_last_action(V.tx_e(spark, sf), cfg.recency_days)
    return t.select("cl_id", "tx_id", "last_action", *[f"in_last_{n}" for n in cfg.recency_days])


@query("round_amount_flags")
def q_round_amount_flags(spark, sf):
    cfg = events_fixture()
    return V.tx_e(spark, sf).select(
        "cl_id", "tx_id", *[cal.round_flag("amount", d).alias(f"ostatok_{d}") for d in cfg.round_divisors])


@query("signed_amount")
def q_signed_amount(spark, sf):
    cfg = events_fixture()
    t = V.tx_e(spark, sf)
    return t.select("cl_id", "tx_id",
                    signed_amount("amount", "category", cfg.income_categories).cast("double").alias("signed_amount"))
