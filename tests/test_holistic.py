"""Histogram median / mode equal Spark's holistic aggregates, on both the
small-key path and the bucketed hot-key path."""

import random

import pytest
from pyspark.sql import functions as F

from cardlens.operators.holistic import HolisticSpec, holistic_stats


@pytest.mark.parametrize("opts", [{}, {"small_group": 3, "buckets": 4},
                                  {"small_group": 1, "buckets": 9, "accuracy": 40}])
def test_matches_builtin(spark, opts):
    rnd = random.Random(7)
    rows = []
    for k in range(8):
        n = rnd.choice([1, 2, 3, 8, 60, 500])
        for _ in range(n):
            v = rnd.choice([float(rnd.randint(0, 25)), round(rnd.random() * 100, 2), None])
            rows.append((k, v, rnd.random() < 0.5))
    rows.append((99, None, True))   # a key with no values at all
    df = spark.createDataFrame(rows, "k int, v double, f boolean")
    got = holistic_stats(df, ["k"], [HolisticSpec(F.col("v"), ("median", "mode", "mode_count"), "a_"),
                                     HolisticSpec(F.col("v"), ("median", "mode"), "b_", F.col("f"))], **opts)
    fv = F.when(F.col("f"), F.col("v"))
    want = df.groupBy("k").agg(
        F.round(F.median("v"), 6).alias("a_median"), F.mode("v", True).alias("a_mode"),
        F.round(F.median(fv), 6).alias("b_median"), F.mode(fv, True).alias("b_mode"))
    mc = (df.filter(F.col("v").isNotNull()).groupBy("k", "v").count()
          .groupBy("k").agg(F.max("count").alias("a_mode_count")))
    want = want.join(mc, "k", "left")
    g = {r.k: r.asDict() for r in got.collect()}
    w = {r.k: r.asDict() for r in want.collect()}
    assert 99 not in g and w[99]["a_median"] is None
    for k, row in w.items():
        if k == 99:
            continue
        assert g[k] == row, k


def test_keyed_stats_hot_client_matches_builtin(spark):
    """One client holds most rows; forcing the bucketed path (tiny
    thresholds) through keyed_stats with filters gives Spark's exact answers."""
    from cardlens.operators.holistic import keyed_stats
    rnd = random.Random(3)
    rows = [(0, round(rnd.random() * 50, 1), rnd.randint(0, 3)) for _ in range(3000)]
    rows += [(k, float(rnd.randint(0, 9)), rnd.randint(0, 3)) for k in range(1, 30) for _ in range(rnd.randint(1, 6))]
    df = spark.createDataFrame(rows, "cl_id int, amount double, cat int")
    blocks = [("amount", ("mean", "median", "mode", "mode_count"), "a_", None),
              ("amount", ("median", "mode"), "c2_", F.col("cat") == 2)]
    got = keyed_stats(df, ["cl_id"], blocks, small_group=20, buckets=16, accuracy=200, salt=4)
    c2 = F.when(F.col("cat") == 2, F.col("amount"))
    want = df.groupBy("cl_id").agg(
        F.round(F.avg("amount"), 6).alias("a_mean"), F.round(F.median("amount"), 6).alias("a_median"),
        F.mode("amount", True).alias("a_mode"),
        F.round(F.median(c2), 6).alias("c2_median"), F.mode(c2, True).alias("c2_mode"))
    mc = df.groupBy("cl_id", "amount").count().groupBy("cl_id").agg(F.max("count").alias("a_mode_count"))
    want = want.join(mc, "cl_id")
    g = {r.cl_id: r.asDict() for r in got.collect()}
    w = {r.cl_id: r.asDict() for r in want.collect()}
    assert g == w


def test_cuts_below_are_found_by_halving(spark):
    """As counting every cut, for any number of cuts, repeated ones and NaN; the plan has no pass over all cuts."""
    from cardlens.operators.holistic import cuts_below
    nan = float("nan")
    for cuts in ([], [1.0], [1.0, 1.0, 2.0], [float(i // 3) for i in range(511)], [0.0, 5.0, nan]):
        df = spark.createDataFrame([(v, cuts) for v in (-1.0, 0.0, 1.0, 1.5, 2.0, 5.0, 99.0, 169.5, 1e9, nan)], "v double, c array<double>")
        got = df.select(cuts_below("c", F.col("v"), len(cuts)).alias("n"), F.size(F.filter("c", lambda x: x < F.col("v"))).alias("m"))
        assert all(r.n == r.m for r in got.collect())
