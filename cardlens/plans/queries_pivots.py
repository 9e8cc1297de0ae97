"""Queries over the wide pivot features."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardlens.functions import calendar as cal
from cardlens.functions.config import DivisibleBy, events_fixture, orders_fixture
from cardlens.operators import onehot as OH
from cardlens.operators import pivots as P
from cardlens.operators import tenure as T
from cardlens.operators.dictionary import code_table, fit_values, with_code, with_membership
from cardlens.session import write_table
from cardlens.plans.catalog import query
from cardlens.sources import views as V
from cardlens.sources.tables import read_table


def trash_mcc_fixture():
    """Stand-in for the 'trash' MCC list on tx_e: multiples of 11, as a predicate."""
    return DivisibleBy((11,))


def enriched_e(spark, sf, tenure: bool = True):
    return T.enrich(V.tx_e(spark, sf), events_fixture(), tenure=tenure)


def orders_calendar(spark, sf):
    cfg = orders_fixture()
    return V.tx_o(spark, sf).withColumns({
        "year": F.year("ts"), "month": cal.base_month_index("ts", cfg.base_year), "day": F.dayofmonth("ts"),
        "quartel": cal.quarter0("ts")})


def _scalar(spark, sf, cols, tenure=False):
    return P.scalar_features(enriched_e(spark, sf, tenure), events_fixture(), only=cols)


@query("sum_by_category_filter")
def q_sum_by_category_filter(spark, sf):
    return _scalar(spark, sf, ["sum_POS"])


@query("good_mcc_portion")
def q_good_mcc_portion(spark, sf):
    return _scalar(spark, sf, ["good_mcc_portion"])


@query("tenure_holes")
def q_tenure_holes(spark, sf):
    return _scalar(spark, sf, ["days_hole_mean", "head_hole_size", "tail_hole_size"], tenure=True)


@query("holiday_amount")
def q_holiday_amount(spark, sf):
    return _scalar(spark, sf, ["holydays_amount_part"])


@query("good_mcc_rows")
def q_good_mcc_rows(spark, sf):
    cfg = events_fixture()
    return P.with_good_mcc(V.tx_e(spark, sf), cfg.bad_mcc).filter(P.is_good(P.GOOD_COL)).select("cl_id", "tx_id", "mcc")


def mcc_feature_values(tx, cfg, trash):
    """Fitted MCC list: codes outside the bad and the trash lists (a NULL MCC
    is in neither list but is not a code, so it is left out)."""
    d = tx.select("mcc").filter(F.col("mcc").isNotNull()).distinct()
    d = with_membership(with_membership(d, "mcc", cfg.bad_mcc, "_bad"), "mcc", trash, "_trash")
    return d.filter(~F.col("_bad") & ~F.col("_trash")).select("mcc")


@query("mcc_feature_list")
def q_mcc_feature_list(spark, sf):
    return mcc_feature_values(V.tx_e(spark, sf), events_fixture(), trash_mcc_fixture())


def _pivot_o(spark, sf, dim):
    t = orders_calendar(spark, sf)
    return P.pivot_sums(t, [dim(t)])


@query("pivot_year")
def q_pivot_year(spark, sf):
    cfg = orders_fixture()
    t = orders_calendar(spark, sf)
    years = fit_values(t, "year")
    return P.pivot_sums(t, [P.PivotDim("year_", F.col("year"), tuple(years), P.pos_good(cfg, mcc=None))])


@query("pivot_month")
def q_pivot_month(spark, sf):
    cfg = orders_fixture()
    return _pivot_o(spark, sf, lambda t: P.PivotDim("year_month_", F.col("month"), tuple(range(1, 13)),
                                                    P.pos_good(cfg, mcc=None)))


@query("pivot_month_day")
def q_pivot_month_day(spark, sf):
    cfg = orders_fixture()
    return _pivot_o(spark, sf, lambda t: P.PivotDim("month_day_", F.col("day"), tuple(range(1, 32)),
                                                    P.pos_good(cfg, mcc=None)))


@query("pivot_quarter")
def q_pivot_quarter(spark, sf):
    return _pivot_o(spark, sf, lambda t: P.PivotDim("quartel_", F.col("quartel"), (0, 1, 2, 3)))


def _pivot_e(spark, sf, dims_fn, tenure: bool = False, **kw):
    t = enriched_e(spark, sf, tenure)
    return P.pivot_sums(t, dims_fn(t, events_fixture()), **kw)


@query("pivot_day_part_share")
def q_pivot_day_part_share(spark, sf):
    return _pivot_e(spark, sf, lambda t, c: [P.PivotDim("day_part_", F.col("day_part"), (0, 1, 2), P.pos_good(c),
                                                        P.TOTAL)])


@query("pivot_hour_share")
def q_pivot_hour_share(spark, sf):
    return _pivot_e(spark, sf, lambda t, c: [P.PivotDim("hour_", F.col("tr_hour"), tuple(range(24)), P.pos_good(c),
                                                        P.TOTAL)])


@query("pivot_category_share")
def q_pivot_category_share(spark, sf):
    t = enriched_e(spark, sf, tenure=False)
    codes = write_table(code_table(t, "category"), "codes")
    t = with_code(t, "category", "cat_index", codes)
    return P.pivot_sums(t, [P.PivotDim("cat_", F.col("cat_index"), tuple(range(codes.count())), None, P.TOTAL)])


@query("period_part_coverage")
def q_period_part_coverage(spark, sf):
    return P.period_part_coverage(enriched_e(spark, sf), events_fixture())


@query("pivot_currency")
def q_pivot_currency(spark, sf):
    return _pivot_e(spark, sf, lambda t, c: [P.PivotDim("cur_", F.col("currency"), tuple(c.currencies))])


@query("pivot_weekday")
def q_pivot_weekday(spark, sf):
    return _pivot_e(spark, sf, lambda t, c: [P.PivotDim("week_day_", F.col("week_day"), tuple(c.weekdays))])


@query("pivot_tenure_day")
def q_pivot_tenure_day(spark, sf):
    return _pivot_e(spark, sf, lambda t, c: [P.PivotDim("day_", F.col("day_number"), tuple(range(c.max_day_number)),
                                                        F.col("category") == c.pos_category)], tenure=True)


@query("pivot_tenure_week")
def q_pivot_tenure_week(spark, sf):
    return _pivot_e(spark, sf, lambda t, c: [P.PivotDim("week_", F.col("week_number"),
                                                        tuple(range(c.max_day_number // 7)), P.pos_good(c))],
                    tenure=True)


@query("pivot_mcc_share")
def q_pivot_mcc_share(spark, sf):
    cfg = events_fixture()
    t = enriched_e(spark, sf, tenure=False)
    mccs = fit_values(mcc_feature_values(t, cfg, trash_mcc_fixture()), "mcc")
    return P.pivot_sums(t, [P.PivotDim("sum_", F.col("mcc"), tuple(mccs), None, P.GOOD_TOTAL)])


@query("mcc_share_long")
def q_mcc_share_long(spark, sf):
    """The MCC shares of ``pivot_mcc_share`` in long form, for any number of codes."""
    t = with_membership(enriched_e(spark, sf, tenure=False), "mcc", trash_mcc_fixture(), "_trash")
    good = F.col(P.GOOD_COL)
    return P.shares_long(t, "mcc", keep=good & ~F.col("_trash"), total_of=good)


@query("onehot_weighted_sum")
def q_onehot_weighted_sum(spark, sf):
    t = T.tenure_cut(V.tx_o(spark, sf), orders_fixture().max_transaction_day)
    return OH.onehot_collapse(t, [("tw_", "transaction_week"), ("pn_", "period_number")], share=False)


@query("onehot_weighted_share")
def q_onehot_weighted_share(spark, sf):
    t = V.tx_e(spark, sf).withColumn("iso_weekday", cal.iso_weekday_or_zero("ts"))
    return OH.onehot_collapse(t, [("wd_", "iso_weekday"), ("cur_", "currency"), ("cat_", "category")], share=True)


@query("elementwise_vector_sum")
def q_elementwise_vector_sum(spark, sf):
    return OH.elementwise_sum(read_table(spark, sf, "embeddings"), "label", "embedding", out="vec_sum")
