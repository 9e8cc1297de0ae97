"""Inline edge cases (FIXTURES.md §3) and invariants of the operators."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from cardlens.functions import calendar as cal
from cardlens.functions.config import events_fixture
from cardlens.functions.stats import safe_div
from cardlens.operators import client_stats as cs
from cardlens.operators import metrics as M
from cardlens.operators import pivots as P
from cardlens.operators import recency as R
from cardlens.operators.asof import convert_unbounded, convert_with_tolerance
from cardlens.operators.sequence import with_previous
from cardlens.operators.tenure import tenure_fields, with_day_diff


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_mode_tie_smallest_and_mode_count(spark):
    df = spark.createDataFrame([(1, v) for v in (3, 1, 3, 1, 2)], "cl_id long, x int")
    r = cs.client_stats(df, "x", ("mode", "mode_count"), "x_").first()
    assert r.x_mode == 1.0 and r.x_mode_count == 2
    assert cs.mode_counts(df, ["cl_id"], "x").first().mode_count == 2


def test_one_row_client_spreads(spark):
    df = spark.createDataFrame([(1, 5.0)], "cl_id long, amount double")
    r = cs.client_stats(df, "amount", ("std", "std_pop", "median"), "a_").first()
    assert r.a_std is None and r.a_std_pop == 0.0 and r.a_median == 5.0


def test_gap_over_24h_modulo_and_true(spark):
    df = spark.createDataFrame([(1, 1, ts("2024-01-01 10:00:00")), (1, 2, ts("2024-01-02 11:00:00"))],
                               "cl_id long, tx_id long, ts timestamp_ntz")
    assert cs.client_gap_stats(df).first().gap_min == 60.0
    assert cs.client_gap_stats(df, modulo_day=False).first().gap_min == 1500.0


def test_first_row_day_diff_zero(spark):
    df = spark.createDataFrame([(1, 1, ts("2024-01-01 10:00:00")), (1, 2, ts("2024-01-01 12:00:00")),
                                (1, 3, ts("2024-01-04 09:00:00"))], "cl_id long, tx_id long, ts timestamp_ntz")
    out = {r.tx_id: r.day_diff for r in with_day_diff(tenure_fields(df)).collect()}
    assert out == {1: 0, 2: 0, 3: 3}


def test_fx_older_than_tolerance(spark):
    tx = spark.createDataFrame([(1, 1, ts("2024-01-11 10:00:00"), 840, 2.0)],
                               "cl_id long, tx_id long, ts timestamp_ntz, currency int, amount double")
    d = 19733  # 2024-01-11 is epoch day 19733; the only rate is ten days older
    rates = spark.createDataFrame([(840, d - 10, 3.0)], "code int, day int, rate double")
    assert convert_with_tolerance(tx, rates).first().amount_rub is None
    assert convert_unbounded(tx, rates).first().amount_rub == 6.0


def test_unparseable_time_dropped(spark):
    df = spark.createDataFrame([("18APR17:01:02:03",), ("18apr17:01:02:03",), ("bad",)], "s string")
    got = [r.t for r in df.select(cal.parse_trx_time("s").alias("t")).collect()]
    assert got[0] == got[1] == dt.datetime(2017, 4, 18, 1, 2, 3) and got[2] is None


def test_zero_denominator_null(spark):
    assert spark.range(1).select(safe_div(F.lit(5.0), F.lit(0.0)).alias("x")).first().x is None


def test_last_histogram_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in (0, 1, 2, 10)], "p double")
    bins = {r.bin: r.n for r in M.histogram(df, "p", 5).collect()}
    assert bins[5] == 1 and max(bins) == 5


def test_missing_channel_code_zero(spark):
    df = spark.createDataFrame([(None,), ("type3",)], "c string")
    assert [r.x for r in df.select(cal.channel_code("c").alias("x")).collect()] == [0, 3]


def test_with_previous_equals_plain_lag(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(400):
        c = rnd.choice([1, 1, 1, 2, 3])  # client 1 is hot
        rows.append((c, i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 20))))
    df = spark.createDataFrame(rows, "cl_id long, tx_id long, ts timestamp_ntz")
    a = {r.tx_id: r.prev for r in with_previous(df, ["cl_id"], "ts", "tx_id").collect()}
    w = Window.partitionBy("cl_id").orderBy("ts", "tx_id")
    b = {r.tx_id: r.prev for r in df.withColumn("prev", F.lag("ts").over(w)).collect()}
    assert a == b


def previous_and_last(df, shares):
    got = with_previous(df, ["cl_id"], "ts", "tx_id", last_out="last", shares=shares)
    a = {r.tx_id: (r.prev, r.last) for r in got.collect()}
    w = Window.partitionBy("cl_id").orderBy("ts", "tx_id")
    want = df.withColumn("prev", F.lag("ts").over(w)).withColumn("last", F.max("ts").over(Window.partitionBy("cl_id")))
    return a, {r.tx_id: (r.prev, r.last) for r in want.collect()}


def test_with_previous_cuts_hot_clients(spark):
    """Clients with many shares of the rows are cut by (time, id), also inside a second."""
    rnd = random.Random(11)
    rows = []
    for i in range(600):
        c = rnd.choice([1, 1, 1, 1, 2, 3])
        sec = rnd.randrange(0, 3 * 3600) if c == 1 else rnd.randrange(0, 86400 * 5)
        rows.append((c, i, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=sec // 7 * 7)))
    df = spark.createDataFrame(rows, "cl_id long, tx_id long, ts timestamp_ntz")
    for shares in (1, 3, 40):
        a, b = previous_and_last(df, shares)
        assert a == b


def test_with_previous_all_rows_of_a_client_in_one_second(spark):
    rows = [(1, i, dt.datetime(2024, 1, 1)) for i in range(500)] + [(2, 1000 + i, dt.datetime(2024, 1, 1 + i)) for i in range(20)]
    df = spark.createDataFrame(rows, "cl_id long, tx_id long, ts timestamp_ntz")
    a, b = previous_and_last(df, 10)
    assert a == b
    from cardlens.operators import sequence as S
    keyed = df.withColumn("_h", F.hash("cl_id"))
    cut = keyed.withColumn("r", S.ranges(keyed, "ts", "tx_id", 10)).where("cl_id = 1").groupBy("r").count().collect()
    assert len(cut) >= 8 and max(r["count"] for r in cut) < 100       # the second itself is cut


def test_roc_auc_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(float(rnd.random() < 0.4), float(rnd.randrange(0, 20))) for _ in range(300)]
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    brute = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "label double, score double")
    assert abs(M.roc_auc(df, "label", "score", partitions=4).first().auc - brute) < 1e-9


def test_pivot_shares_sum_to_one_over_full_list(spark):
    df = spark.createDataFrame([(1, h, 10.0 * (h + 1)) for h in range(3)] + [(2, 0, 5.0)],
                               "cl_id long, h int, amount double")
    out = P.pivot_sums(df, [P.PivotDim("h_", F.col("h"), (0, 1, 2), None, P.TOTAL)]).collect()
    for r in out:
        assert abs(r.h_0 + r.h_1 + r.h_2 - 1.0) < 1e-6


def test_recency_counts_nested(spark):
    base = dt.datetime(2024, 3, 1)
    rows = [(1, i, base - dt.timedelta(days=d), 1.0) for i, d in enumerate([0, 3, 10, 20, 45, 90])]
    df = spark.createDataFrame(rows, "cl_id long, tx_id long, ts timestamp_ntz, amount double")
    r = R.recency_aggs(df, (7, 14, 30, 60), stats=("count",)).first()
    counts = [r[f"last_action_minus_{n}_days_count"] for n in (7, 14, 30, 60)]
    assert counts == [2, 3, 4, 5]


def test_category_pivot_fill_rules(spark):
    df = spark.createDataFrame([(1, "a", 5.0), (2, "b", 1.0), (2, "b", 3.0)], "cl_id long, category string, amount double")
    out = {r.cl_id: r for r in P.category_stats_pivot(df, "category", ["a", "b"], "amount").collect()}
    assert out[1]["trx_categorya_amount_std"] == 0          # one row: filled with 0
    assert out[1]["trx_categoryb_amount_sum"] is None       # no rows in the category: NULL
    assert out[2]["trx_categoryb_amount_count"] == 2


def test_fixture_config_bad_mcc_rule(spark):
    codes = spark.range(0, 30000, 1).where(events_fixture().bad_mcc(F.col("id")))
    assert codes.where("id % 7 <> 0").count() == 0 and codes.where("id in (9996, 29995)").count() == 2



def test_fx_after_last_rate_day(spark):
    """Days past the last rate day look up that day: unbounded keeps the last
    rate; the tolerance rule keeps it only within the look-back window."""
    d = 19733  # 2024-01-11
    tx = spark.createDataFrame([(1, 1, ts("2024-01-16 10:00:00"), 840, 2.0),
                                (1, 2, ts("2024-01-31 10:00:00"), 840, 2.0)],
                               "cl_id long, tx_id long, ts timestamp_ntz, currency int, amount double")
    rates = spark.createDataFrame([(840, d - 3, 2.5), (840, d, 3.0)], "code int, day int, rate double")
    tol = {r.tx_id: r.amount_rub for r in convert_with_tolerance(tx, rates).collect()}
    unb = {r.tx_id: r.amount_rub for r in convert_unbounded(tx, rates).collect()}
    assert tol == {1: 6.0, 2: None}
    assert unb == {1: 6.0, 2: 6.0}


def test_order_key_sorts_like_time_then_id(spark):
    """The packed decimal key orders rows exactly as (ts, id), including equal
    times, negative ids and times before 1970."""
    from cardlens.operators.sequence import order_key
    rnd = random.Random(5)
    base = [ts("1969-12-31 23:59:59"), ts("2024-01-01 00:00:00"), ts("2024-01-01 00:00:00.000001")]
    rows = [(i, rnd.choice(base), rnd.choice([-(2 ** 63), -5, 0, 7, 2 ** 63 - 1, rnd.randrange(-10 ** 9, 10 ** 9)]))
            for i in range(200)]
    df = spark.createDataFrame(rows, "rid long, ts timestamp_ntz, id long")
    by_key = [r.rid for r in df.orderBy(order_key("ts", "id"), "rid").collect()]
    by_pair = [r.rid for r in df.orderBy("ts", "id", "rid").collect()]
    assert by_key == by_pair


ROWS = "cl_id long, tx_id long, ts timestamp_ntz, amount double"


def test_day_diff_of_repeated_rows_equals_lag(spark):
    """Rows alike in time and id: one of them carries the difference, as lag gives it."""
    t = [ts("2024-01-01 10:00:00"), ts("2024-01-04 09:00:00")]
    df = spark.createDataFrame([(1, 1, t[0], 1.0), (1, 2, t[1], 2.0), (1, 2, t[1], 2.0), (1, 2, t[1], 2.0), (2, 5, t[1], 1.0)], ROWS)
    w = Window.partitionBy("cl_id").orderBy("day_number", "ts", "tx_id")
    plain = tenure_fields(df).withColumn("d", F.coalesce(F.col("day_number") - F.lag("day_number").over(w), F.lit(0)))
    want = sorted((r.cl_id, r.tx_id, r.d) for r in plain.collect())
    for got in (with_day_diff(tenure_fields(df)), tenure_fields(df, day_diff="day_diff")):
        assert sorted((r.cl_id, r.tx_id, r.day_diff) for r in got.collect()) == want


def test_rows_without_a_time_stay(spark):
    df = spark.createDataFrame([(1, 1, ts("2024-01-01 10:00:00"), 1.0), (1, 2, None, 2.0), (1, 3, ts("2024-01-05 10:00:00"), 3.0),
                                (2, 4, None, 4.0), (None, 5, None, 5.0)], ROWS)
    out = {r.tx_id: r for r in tenure_fields(df, day_diff="day_diff").collect()}
    assert sorted(out) == [1, 2, 3, 4, 5]
    assert out[3].day_number == 4 and out[3].day_diff == 4 and out[2].day_number is None and out[2].day_diff == 0
    last = {r.tx_id: r.last_action for r in R.with_last_action(df, (7,)).collect()}
    want = df.withColumn("m", F.max("ts").over(Window.partitionBy("cl_id"))).collect()
    assert last == {r.tx_id: r.m for r in want}
    assert with_day_diff(tenure_fields(df)).count() == 5


def test_a_repeated_rate_day_keeps_one_row_per_transaction(spark):
    tx = spark.createDataFrame([(1, 1, ts("2024-01-11 10:00:00"), 840, 2.0)], "cl_id long, tx_id long, ts timestamp_ntz, currency int, amount double")
    d = 19733
    rates = spark.createDataFrame([(840, d - 1, 3.0), (840, d - 1, 4.0)], "code int, day int, rate double")
    for f in (convert_with_tolerance, convert_unbounded):
        assert [r.amount_rub for r in f(tx, rates).collect()] == [8.0]
    lines = rates.withColumn("_line", -F.col("rate"))
    assert convert_unbounded(tx, lines).first().amount_rub == 6.0      # the later line, not the higher rate


def test_many_currency_codes(spark):
    d = 19733
    rates = spark.range(3000).select(F.col("id").cast("int").alias("code"), F.lit(d).alias("day"), (F.col("id") + 1.0).alias("rate"))
    tx = spark.createDataFrame([(1, 1, ts("2024-01-11 10:00:00"), 840, 2.0)], "cl_id long, tx_id long, ts timestamp_ntz, currency int, amount double")
    assert convert_unbounded(tx, rates).first().amount_rub == 2.0 * 841


def test_dictionaries_of_any_size(spark):
    from cardlens.operators.dictionary import code_table, with_category_code
    df = spark.range(25000).select((F.col("id") % 10).alias("cl_id"), F.format_string("c%06d", "id").alias("category"),
                                   F.lit(2.0).alias("amount"))
    out = with_category_code(df, "category", "code")
    assert out.where(F.col("code") != F.substring("category", 2, 6).cast("int")).count() == 0
    shares = P.shares_long(df, "category")
    assert shares.count() == 25000 and shares.where("share <> 0.0004").count() == 0
    freq = spark.createDataFrame([("b",), ("a",), ("c",), ("c",), (None,)], "v string")
    assert {r.value: r.code for r in code_table(freq, "v", by_frequency=True).collect()} == {"c": 0, "a": 1, "b": 2}
    assert code_table(freq.limit(0), "v").count() == 0


def test_folds_depend_on_the_seed(spark):
    keys = spark.range(400).withColumnRenamed("id", "cl_id")
    folds = [tuple(r.fold for r in M.hash_folds(keys, "cl_id", 4, seed).orderBy("cl_id").collect()) for seed in range(3)]
    together = [{(a, b) for a in range(60) for b in range(a) if f[a] == f[b]} for f in folds]
    assert together[0] != together[1] != together[2] != together[0]
    assert all(60 < f.count(k) < 140 for f in folds for k in range(4))


def test_scratch_folder_is_an_error_off_local_masters():
    import pytest

    from cardlens import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())
    assert session.is_local_master("local[8]") and not session.is_local_master("local-cluster[3,2,1024]")


def test_membership_by_list_table_and_predicate_agree(spark):
    from cardlens.operators.dictionary import SHORT_LIST, with_membership
    df = spark.createDataFrame([(v,) for v in (None, 0, 3, 7, 14, 5000)], "v int")
    flags = lambda values: [r.f for r in with_membership(df, "v", values, "f").orderBy(F.col("v").asc_nulls_first()).collect()]
    want = [False, True, False, True, True, False]
    assert flags([0, 7, 14]) == flags(list(range(0, 7 * (SHORT_LIST + 5), 7))) == flags(lambda c: (c % 7 == 0) & (c < 100)) == want
