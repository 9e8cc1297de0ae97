"""Queries over client statistics, windows and sequences."""

from __future__ import annotations

from cardlens.operators import client_stats as cs
from cardlens.plans.catalog import query
from cardlens.sources import views as V


@query("client_gap_stats")
def q_client_gap_stats(spark, sf):
    return cs.client_gap_stats(V.tx_e(spark, sf))


from pyspark.sql import functions as F  # noqa: E402

from cardlens.functions import calendar as cal  # noqa: E402
from cardlens.functions.config import events_fixture, orders_fixture  # noqa: E402
from cardlens.operators.holistic import keyed_stats  # noqa: E402
from cardlens.operators import recency as R  # noqa: E402
from cardlens.operators import tenure as T  # noqa: E402

AMOUNT_STATS = ("sum", "mean", "std", "median", "max", "min", "mode_count", "mode", "mean_div_std")
MONTH_STATS = ("median", "max", "min", "mode_count", "mode")
ROUND_STATS = ("mean", "std", "median", "max", "min", "mean_div_std")


def tx_o_months(spark, sf):
    cfg = orders_fixture()
    return V.tx_o(spark, sf).withColumn("month", cal.base_month_index("ts", cfg.base_year))


@query("client_num_deals")
def q_client_num_deals(spark, sf):
    return cs.client_counts(V.tx_e(spark, sf)).select("cl_id", "num_deals")


@query("client_sum_deals")
def q_client_sum_deals(spark, sf):
    return cs.client_counts(V.tx_e(spark, sf)).select("cl_id", "sum_deals")


@query("client_lifespan")
def q_client_lifespan(spark, sf):
    return cs.client_lifespan(V.tx_o(spark, sf), orders_fixture().base_year)


@query("client_amount_stats")
def q_client_amount_stats(spark, sf):
    return cs.client_stats(V.tx_e(spark, sf), "amount", AMOUNT_STATS, "amount_")


@query("client_month_stats")
def q_client_month_stats(spark, sf):
    return cs.client_stats(tx_o_months(spark, sf), "month", MONTH_STATS, "month_")


@query("client_round_stats")
def q_client_round_stats(spark, sf):
    cfg = events_fixture()
    t = V.tx_e(spark, sf).withColumns({f"ostatok_{d}": cal.round_flag("amount", d) for d in cfg.round_divisors})
    return keyed_stats(t, ["cl_id"], [(f"ostatok_{d}", ROUND_STATS, f"ostatok_{d}_", None)
                                      for d in cfg.round_divisors])


@query("client_channel_mode")
def q_client_channel_mode(spark, sf):
    t = V.tx_e(spark, sf).withColumn("channel_code", cal.channel_code("channel_type"))
    return cs.client_stats(t, "channel_code", ("mode",), "channel_code_")


@query("client_mode_count")
def q_client_mode_count(spark, sf):
    return cs.mode_counts(V.tx_e(spark, sf), ["cl_id"], "mcc", "mcc_mode_count")


@query("client_mean_div_std")
def q_client_mean_div_std(spark, sf):
    return cs.client_stats(V.tx_e(spark, sf), "amount", ("mean_div_std",), "amount_")


@query("client_active_days")
def q_client_active_days(spark, sf):
    t = V.tx_o(spark, sf).withColumn("days_since", cal.days_since("ts", "2015-01-01"))
    return cs.client_active_days(t)


@query("month_cohort")
def q_month_cohort(spark, sf):
    return cs.month_cohort(tx_o_months(spark, sf))


@query("month_amount_stats")
def q_month_amount_stats(spark, sf):
    return cs.month_amount_stats(tx_o_months(spark, sf))


@query("month_cohort_join")
def q_month_cohort_join(spark, sf):
    t = tx_o_months(spark, sf)
    clients = cs.client_lifespan(V.tx_o(spark, sf), orders_fixture().base_year).select("cl_id", "max_month", "min_month")
    coh = cs.month_cohort(t)
    out = cs.attach_by_month(clients, coh, "max_month", "max_")
    return cs.attach_by_month(out, coh, "min_month", "min_")


@query("client_first_value")
def q_client_first_value(spark, sf):
    return cs.client_first_value(V.tx_o(spark, sf), "channel", ["ts", "tx_id"], "first_channel")


@query("client_target")
def q_client_target(spark, sf):
    rows = V.tx_e(spark, sf).join(V.cust_lbl(spark, sf), "cl_id", "left")
    out = cs.client_target(rows)
    return out.withColumn("target_sum", F.col("target_sum").cast("double"))


@query("client_features_left_join")
def q_client_features_left_join(spark, sf):
    t = V.tx_e(spark, sf).withColumn("days_since", cal.days_since("ts", "2015-01-01"))
    base = cs.client_counts(t)
    for part in (cs.client_gap_stats(t), cs.client_lifespan(t, events_fixture().base_year),
                 cs.client_active_days(t)):
        base = base.join(part, "cl_id", "left")
    return base


@query("wide_join_suffix")
def q_wide_join_suffix(spark, sf):
    t = V.tx_e(spark, sf)
    left = cs.client_stats(t, "amount", ("sum", "max", "count"), "amount_") \
        .withColumn("channel_type", F.lit(1))
    right = cs.client_stats(t.filter(F.col("category") == "purchase"), "amount", ("sum", "max", "count"), "amount_") \
        .withColumn("channel_type", F.lit(2))
    return cs.wide_join(left, right)


@query("drop_columns")
def q_drop_columns(spark, sf):
    wide = cs.client_stats(V.tx_e(spark, sf), "amount", AMOUNT_STATS, "amount_")
    return wide.drop("amount_mode_count", "amount_mode", "amount_mean_div_std")


@query("category_stats_pivot")
def q_category_stats_pivot(spark, sf):
    from cardlens.operators.pivots import category_stats_pivot
    t = V.tx_e(spark, sf)
    return category_stats_pivot(t, "category", ["click", "error", "purchase", "signup", "view"], "amount")


@query("recency_aggs")
def q_recency_aggs(spark, sf):
    return R.recency_aggs(V.tx_e(spark, sf), events_fixture().recency_days)


@query("recency_ratios")
def q_recency_ratios(spark, sf):
    t = V.tx_e(spark, sf)
    days = events_fixture().recency_days
    stats = ("sum", "mean", "std", "median", "max", "min", "count")
    # whole-history and recency-window statistics: one aggregate, one histogram
    blocks = [("amount", stats, "amount_", None)] + R.recency_blocks(days, "amount", stats)
    feats = keyed_stats(R.with_last_action(t, days), ["cl_id"], blocks)
    wh = {s: f"amount_{s}" for s in ("sum", "mean", "std", "median", "max", "min")}
    out = R.recency_ratios(feats, days, whole=wh)
    out = R.recency_ratios(out, days, stats=("count",), whole={"count": "amount_count"})
    keep = ["cl_id"] + [c for c in out.columns if "_div_" in c or "_prc_" in c]
    return out.select(*keep)


@query("relative_month_state")
def q_relative_month_state(spark, sf):
    from cardlens.operators.pivots import relative_month_features
    cfg = orders_fixture()
    t = T.tenure_fields(V.tx_o(spark, sf))
    return relative_month_features(t, cfg, flows=False, mcc=None)


@query("inout_flows")
def q_inout_flows(spark, sf):
    from cardlens.operators.pivots import relative_month_features
    cfg = orders_fixture()
    t = T.tenure_fields(V.tx_o(spark, sf))
    return relative_month_features(t, cfg, flows=True, mcc=None)
