"""Transaction-shaped views over the given tables (FIXTURES.md §2).

Every view is a lazy projection/aggregate of a parquet scan, so the work of
any query built on it grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.sources.tables import read_table

MONEY = "decimal(18,2)"


def money(c) -> Column:
    """Amounts are summed exactly as DECIMAL(18,2)."""
    return F.col(c).cast(MONEY) if isinstance(c, str) else c.cast(MONEY)


def epoch_day(ts) -> Column:
    """Days since 1970-01-01 of a timestamp (UTC session)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_date(F.to_date(c))


def tx_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-of-day transactions from ``events``; one row per event."""
    ev = read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    currency = (F.when(k % 5 == 0, 810).when(k % 5 == 1, 840).when(k % 5 == 2, 978)
                .when(k % 5 == 3, 784).otherwise(704))
    channel = F.when(k % 10 == 9, F.lit(None).cast("string")).otherwise(
        F.concat(F.lit("type"), (k % 6).cast("string")))
    return ev.select(
        F.col("user_id").alias("cl_id"), F.col("event_id").alias("tx_id"), "ts",
        F.col("event_type").alias("category"), k.alias("mcc"), currency.alias("currency"),
        channel.alias("channel_type"), money("value").alias("amount"))


def tx_o(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-year transactions from ``orders``."""
    o = read_table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").alias("cl_id"), F.col("o_orderkey").alias("tx_id"),
        F.col("o_orderdate").alias("ts"), F.col("o_orderpriority").alias("category"),
        F.col("o_orderstatus").alias("channel"), money("o_totalprice").alias("amount"))


def tx_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large line-level transactions (lineitem joined to its order)."""
    li = read_table(spark, sf_dir, "lineitem")
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    return j.select(
        F.col("o_custkey").alias("cl_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("tx_id"),
        F.col("l_shipdate").alias("ts"), F.col("l_returnflag").alias("category"),
        F.col("l_partkey").alias("mcc"), money("l_extendedprice").alias("amount"))


def mcc_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MCC -> category dictionary with deliberate holes."""
    p = read_table(spark, sf_dir, "part")
    return (p.filter(F.col("p_partkey") % 50 != 0)
            .select(F.col("p_partkey").alias("mcc"), F.col("p_brand").alias("mcc_category")))


def fx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily USD (840) and EUR (978) rates without weekends: (code, day, rate)."""
    ev = read_table(spark, sf_dir, "events")
    d = epoch_day("ts")
    base = ev.select(d.alias("day"), money("value").alias("v")).filter(~((F.col("day") % 7).isin(2, 3)))
    usd = base.groupBy("day").agg(F.max("v").alias("rate")).select(F.lit(840).alias("code"), "day", "rate")
    eur = base.groupBy("day").agg(F.min("v").alias("rate")).select(F.lit(978).alias("code"), "day", "rate")
    return usd.unionByName(eur)


def fx_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """USD and EUR quotes to the second: (code, ts, rate), several a day."""
    t = tx_e(spark, sf_dir).where((F.col("category") == "purchase") & F.col("currency").isin(840, 978))
    return t.select(F.col("currency").alias("code"), "ts", F.col("amount").cast("double").alias("rate"))


def cust_lbl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels for clients with cl_id % 5 != 0 (the rest play the test set)."""
    t = tx_e(spark, sf_dir).filter(F.col("cl_id") % 5 != 0)
    spent = F.sum(F.when(F.col("category") == "purchase", F.col("amount")).otherwise(F.lit(0).cast("decimal(18,2)")))
    return (t.groupBy("cl_id").agg(spent.alias("target_sum"))
            .select("cl_id", F.when(F.col("target_sum") > 700, 1).otherwise(0).alias("target_flag"), "target_sum"))
