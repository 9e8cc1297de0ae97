"""As-of joins on times, day bits, rows without a time, hot days, rejected lines."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cardlens.operators import daybits as D
from cardlens.operators import sequence
from cardlens.operators.asof import asof_join
from cardlens.operators.recency import with_last_action
from cardlens.operators.tenure import tenure_fields
from cardlens.session import scratch_path
from cardlens.sources import ingest as I

T0 = dt.datetime(2024, 1, 1)
ROWS = "tx_id long, currency int, ts timestamp_ntz, rate string"
RATES = "code int, ts timestamp_ntz, rate double"


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


def brute(rows, rates, tolerance=None):
    out = []
    for i, code, t, _ in rows:
        seen = [(s, r) for c, s, r in rates if None not in (c, s, r, code, t) and c == code and s <= t]
        best = max(seen, default=None)
        if best and tolerance is not None and (t - best[0]).total_seconds() > tolerance:
            best = None
        out.append((i, best[1] if best else None, best[0] if best else None))
    return sorted(out, key=str)


def joined(spark, rows, rates, **options):
    got = asof_join(spark.createDataFrame(rows, ROWS).withColumnRenamed("rate", "note"), spark.createDataFrame(rates, RATES), "currency", "ts", **options)
    assert got.columns == ["tx_id", "currency", "ts", "note", "rate", "rate_ts"]
    return sorted([(r.tx_id, r.rate, r.rate_ts) for r in got.collect()], key=str)


@pytest.mark.parametrize("seed,shares,tolerance", [(1, 8, None), (2, 40, None), (3, 40, 50.0), (4, 1, 0.0)])
def test_asof_with_a_hot_code(spark, seed, shares, tolerance):
    """One code holds half of the rows, one second a tenth of them."""
    r = random.Random(seed)
    code = lambda: r.choice([840, 840, 840, 978, 36, None])
    time = lambda: at(r.choice([None, 500] + [r.randrange(1000) + r.choice([0, 0.25]) for _ in range(12)]))
    rows = [(i, code(), time(), None) for i in range(800)]
    rates = [(code(), time(), r.choice([None, float(r.randrange(100))])) for _ in range(150)]
    assert joined(spark, rows, rates, shares=shares, tolerance_seconds=tolerance) == brute(rows, rates, tolerance)


def test_asof_edges(spark):
    assert joined(spark, [], [(840, at(1), 1.0)]) == []
    rows = [(1, 840, at(5), None), (1, 840, at(5), None), (2, None, at(5), None), (3, 840, None, None), (4, 840, at(0), None)]
    rates = [(840, at(5), 1.0), (840, at(5), 3.0), (840, at(5), None), (None, at(1), 9.0)]
    assert joined(spark, rows, rates) == brute(rows, rates)
    assert joined(spark, rows, []) == brute(rows, [])


def test_asof_hot_code_is_cut(spark):
    rows = spark.range(6000).select(F.col("id").alias("tx_id"), F.when(F.col("id") % 3 == 0, 840).otherwise(F.col("id").cast("int")).alias("currency"),
                                    F.timestamp_seconds(F.col("id") * 10).cast("timestamp_ntz").alias("ts"))
    line = rows.withColumn("_h", F.hash("currency"))
    cut = line.withColumn("b", sequence.ranges(line, "ts", "tx_id", 30)).where("currency = 840").groupBy("b").count().collect()
    assert len(cut) > 5 and max(r["count"] for r in cut) < 2000 / 4


def day_rows(seed):
    r = random.Random(seed)
    return [(c, r.choice([None, r.randrange(400), r.randrange(8), 127, 128])) for c in [1, 1, 1, 1, 2, 3, None] for _ in range(30)] + [(9, None), (9, None), (8, 0)]


@pytest.mark.parametrize("seed", [1, 2])
def test_day_sets(spark, seed):
    rows = day_rows(seed)
    parts = (2, 4, 8, 16, 32, 64, 128)
    assert D.countable(parts) and not D.countable((2, 6))
    got = {r.cl_id: r for r in D.day_sets(spark.createDataFrame(rows, "cl_id int, d int"), "d", parts, 128).collect()}
    for c in {c for c, _ in rows}:
        days = {d for k, d in rows if k == c and d is not None}
        assert got[c].len_days == len(days)
        assert got[c].len_div_set_days == (round(len(days) / (max(days) - min(days) + 1), 6) if days else None)
        for n in parts:
            assert got[c][f"period_part{n}"] == pytest.approx(round(len({(d + 1) // n for d in days}) / (128 / n), 6), abs=1e-9)
    assert len(got) == len({c for c, _ in rows})


def test_days_before_the_epoch(spark):
    days = [-300, -129, -128, -1, 0, 5]
    r = D.day_sets(spark.createDataFrame([(1, d) for d in days], "cl_id int, d int"), "d").first()
    assert (r.len_days, r.len_div_set_days) == (6, round(6 / 306, 6))


def test_day_sets_take_two_shuffles(spark):
    plan = D.day_sets(spark.createDataFrame(day_rows(1), "cl_id int, d int"), "d", (2, 128), 128)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2


LOG = "cl_id long, tx_id long, ts timestamp_ntz, amount double"


def test_rows_without_a_time_are_spread(spark):
    """A third of the log: one client's rows without a time."""
    rows = [(1, i, None, 1.0) for i in range(2000)] + [(i % 50, 5000 + i, at(3600 * i), 1.0) for i in range(4000)]
    df = spark.createDataFrame(rows, LOG)
    out = tenure_fields(df, day_diff="day_diff")
    assert out.where("ts is null").agg(F.count("*"), F.count("day_number"), F.sum("day_diff")).first() == (2000, 0, 0)
    assert with_last_action(df, (7,)).where("cl_id = 1 and ts is null").agg(F.count("*"), F.count("last_action")).first() == (2000, 2000)
    slots = df.where("ts is null").withColumn("d", F.lit(None).cast("int"))
    from cardlens.operators.tenure import _slot
    assert slots.select(_slot(slots, "d", "tx_id").alias("s")).groupBy("s").count().agg(F.max("count")).first()[0] < 20


SKEW = {"skewJoin.skewedPartitionThresholdInBytes": "64k", "advisoryPartitionSizeInBytes": "32k", "skewJoin.skewedPartitionFactor": "1.5",
        "autoBroadcastJoinThreshold": "-1", "coalescePartitions.enabled": "false"}


@pytest.fixture
def eager_splits(spark):
    """Skew splitting at test sizes."""
    names = {f"spark.sql.adaptive.{k}": v for k, v in SKEW.items()} | {"spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_day_in_several_tasks(spark, eager_splits):
    """Half of the rows are one client's on one day: no task of the join or behind it holds the day."""
    n = 40_000
    hot = spark.range(n, numPartitions=8).select(F.lit(7).cast("long").alias("cl_id"), F.col("id").alias("tx_id"),
                                                 F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") % 5000).cast("timestamp_ntz").alias("ts"), F.rand(1).alias("amount"))
    rest = spark.range(n, numPartitions=8).select((F.col("id") % 1000 + 10).alias("cl_id"), (F.col("id") + n).alias("tx_id"),
                                                  F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 60).cast("timestamp_ntz").alias("ts"), F.rand(2).alias("amount"))
    out = tenure_fields(hot.union(rest), day_diff="day_diff").withColumn("p", F.spark_partition_id())
    rows = out.select("p", "cl_id", "day_diff").collect()
    assert len(rows) == 2 * n and sum(r.day_diff for r in rows if r.cl_id == 7) == 0
    per_task = {}
    for r in rows:
        if r.cl_id == 7:
            per_task[r.p] = per_task.get(r.p, 0) + 1
    assert max(per_task.values()) < n / 3


def test_sorted_lines(spark):
    lines = [I.TX_HEADER, "", "a", "01/10/2017,5", "01/10/2017,x,1,type1,810,18APR17:01:02:03,5.0,POS", "01/10/2017,5,1,type1,810,never,5.0,POS",
             "01/10/2017,5,1,type1,810,18APR17:01:02:03,much,POS", "01/10/2017,5,1,,810,18apr17:01:02:03,5.5,POS,1.0,7.5",
             "bad,6,,type2,x,18Apr17:01:02:03,-1,POS", "01/10/2017,6,1,type2,810,18APR17:01:02:03"]
    path = I.write_lines(spark.createDataFrame([(x,) for x in lines], "value string"), scratch_path(spark, "log"))
    accepted, rejected = I.sort_lines(spark, path)
    assert sorted(r.reason for r in rejected.collect()) == ["amount", "amount", "client", "header", "short", "short", "short", "time"]
    got = {r.cl_id: r for r in accepted.collect()}
    assert set(got) == {5, 6} and (got[5].channel_type, got[5].amount, got[5].target_flag, got[5].target_sum) == (None, 5.5, 1.0, 7.5)
    assert (got[6].period, got[6].mcc, got[6].currency, got[6].ts) == (None, None, None, dt.datetime(2017, 4, 18, 1, 2, 3))
    assert accepted.count() + rejected.count() == len(lines)
