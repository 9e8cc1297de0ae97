"""The real code lists, holidays and income categories through the row and client plans."""

import datetime as dt

from cardlens.functions.config import reference
from cardlens.operators import pivots as P
from cardlens.operators.tenure import enrich
from cardlens.plans import features as FT


def rows(spark):
    t = dt.datetime
    data = [
        (1, 1, t(2017, 1, 1, 10), "POS", 5411, 810, "type1", 100.0),        # a holiday, a good code
        (1, 2, t(2017, 1, 20, 11), "POS", 6011, 810, "type1", 50.0),        # a bad code
        (1, 3, t(2017, 2, 1, 12), "DEPOSIT", 6011, 810, None, 500.0),       # income
        (1, 4, t(2017, 2, 23, 13), "POS", 5812, 810, "type2", 30.0),        # a holiday
        (2, 5, t(2017, 3, 1, 9), "C2C_OUT", None, 810, "type2", 10.0),      # no code: counts as good
    ]
    return spark.createDataFrame(data, "cl_id long, tx_id long, ts timestamp_ntz, category string, mcc int, currency int, "
                                       "channel_type string, amount double")


def test_good_codes_holidays_and_income(spark):
    cfg = reference()
    e = enrich(rows(spark), cfg)
    got = {r.tx_id: r for r in e.collect()}
    assert [got[i].is_good_mcc for i in range(1, 6)] == [True, False, False, True, True]
    assert [got[i].is_holiday for i in range(1, 6)] == [1, 0, 0, 1, 0]
    assert [got[i].signed_amount for i in range(1, 6)] == [-100.0, -50.0, 500.0, -30.0, -10.0]
    s = {r.cl_id: r for r in P.scalar_features(e, cfg).collect()}
    assert s[1].sum_POS == 180.0 and s[1].holydays_amount_part == 130.0
    assert s[1].good_mcc_portion == round(130 / 180, 6)
    assert s[2].sum_POS == 0.0 and s[2].good_mcc_portion == 0.0


def test_feature_lists_leave_out_bad_and_trash_codes(spark):
    cfg = reference()
    log = enrich(rows(spark), cfg)
    lists = FT.fit_lists(log, cfg, trash_mcc=[5812])
    assert lists["mcc"] == [5411] and lists["categories"] == ["C2C_OUT", "DEPOSIT", "POS"]
