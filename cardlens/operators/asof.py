"""Backward as-of joins of transactions to exchange rates.

Spark has no batch as-of join in the DataFrame API.  Rates by time meet the rows in one cut timeline
(``asof_join``).  Daily rates are a small time
series per currency, so the plan forward-fills a dense ``(code, day)``
calendar once (one task per currency, one row per day of the rate series) and
then equi-joins the transactions to it: no range join and no per-row search.
Whether the calendar is broadcast is Spark's own size-based choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlens.functions import constants as K
from cardlens.functions.calendar import epoch_day
from cardlens.functions.money import flat_converted
from cardlens.operators.sequence import ranges


def one_per_day(rates: DataFrame) -> DataFrame:
    """One rate per (code, day): that of the later line where the rates carry a
    line number (``_line``), else the highest."""
    order = "_line" if "_line" in rates.columns else "rate"
    return rates.groupBy("code", "day").agg(F.max_by("rate", order).alias("rate"))


def rate_calendar(rates: DataFrame) -> DataFrame:
    """(code, day, rate, rate_day): the latest rate on or before ``day`` for
    every day from the code's first to its last rate day.  A day with several
    rates counts once."""
    rates = one_per_day(rates)
    firsts = rates.groupBy("code").agg(F.min("day").alias("d0"), F.max("day").alias("d1"))
    days = firsts.select("code", F.explode(F.sequence(F.col("d0"), F.col("d1"))).alias("day"))
    facts = rates.select("code", "day", F.col("rate").cast("double").alias("rate"), F.col("day").alias("rate_day"))
    j = days.join(facts, ["code", "day"], "left")
    w = Window.partitionBy("code").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return j.select("code", "day", F.last("rate", ignorenulls=True).over(w).alias("rate"),
                    F.last("rate_day", ignorenulls=True).over(w).alias("rate_day"))


def _calendar_join(tx: DataFrame, rates: DataFrame, code_col: str, day_col: str) -> DataFrame:
    """Join each row to the calendar row of its (code, day).  A day after the
    code's last rate day looks up that last day (its forward-filled rate is
    the same), so the calendar depends on the rates alone.  The last days are a
    small table joined on the code; nothing reaches the driver."""
    lasts = rates.groupBy(F.col("code").alias(code_col)).agg(F.max("day").alias("_last_day"))
    cal = rate_calendar(rates).withColumnRenamed("code", code_col).withColumnRenamed("day", "_lookup_day")
    t = tx.join(lasts, code_col, "left").withColumn("_lookup_day", F.least(F.col(day_col), F.col("_last_day")))
    return t.join(cal, [code_col, "_lookup_day"], "left").drop("_lookup_day", "_last_day")


def convert_with_tolerance(tx: DataFrame, rates: DataFrame, ts: str = "ts", amount: str = "amount",
                           currency: str = "currency", tolerance: int = K.FX_LOOKBACK_DAYS,
                           factors: dict | None = None, out: str = "amount_rub") -> DataFrame:
    """Notebook rule: exotic currencies go to US dollars by a flat factor;
    dollars and euros are multiplied by the latest rate of the last
    ``tolerance`` + 1 days (NULL when there is none); others pass unchanged."""
    amt, cur = flat_converted(amount, currency, factors)
    t = tx.withColumn("_amt", amt).withColumn("_code", cur).withColumn("_day", epoch_day(ts))
    j = _calendar_join(t, rates, "_code", "_day")
    fresh = (F.col("_day") - F.col("rate_day")) <= tolerance
    conv = F.when(F.col("_code").isin(K.USD_CODE, K.EUR_CODE),
                  F.when(fresh, F.col("_amt") * F.col("rate"))).otherwise(F.col("_amt"))
    return j.withColumn(out, conv).drop("_amt", "_code", "_day", "rate", "rate_day")


def convert_unbounded(tx: DataFrame, rates: DataFrame, ts: str = "ts", amount: str = "amount",
                      currency: str = "currency", out: str = "amount_rub") -> DataFrame:
    """Card-job rule: a currency with a rate series takes its latest rate on
    or before the day, however old (NULL when there is none); any other
    currency keeps its amount (rate 1.0)."""
    codes = [K.USD_CODE, K.EUR_CODE]
    t = tx.withColumn("_day", epoch_day(ts)).withColumn("_code", F.col(currency))
    j = _calendar_join(t, rates, "_code", "_day")
    conv = F.when(F.col("_code").isin(*codes), F.col(amount).cast("double") * F.col("rate")) \
        .otherwise(F.col(amount).cast("double"))
    return j.withColumn(out, conv).drop("_day", "_code", "rate", "rate_day")


def asof_join(tx: DataFrame, rates: DataFrame, code: str, ts: str, rate_code: str = "code", rate_ts: str = "ts", rate: str = "rate",
              tolerance_seconds: float | None = None, shares: int | None = None) -> DataFrame:
    """``tx`` with ``rate`` and ``rate_ts``: the latest rate of the row's code at or before its time, to the microsecond; NULL
    where there is none, or where it is older than the tolerance.

    Rates and rows stand in one timeline per code.  A code that holds more than a partition's share of it is cut into
    ranges of time, a single crowded time too (rates come first in it).  Inside a range the last rate is a window; the first
    rows of a range take the last rate of the ranges before, from one summary row per (code, range).  Of several
    rates at one time the highest counts.  Rows without a code or time keep NULL.
    """
    n = shares or int(tx.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    known = rates.where(F.col(rate_code).isNotNull() & F.col(rate_ts).isNotNull() & F.col(rate).isNotNull())
    known = known.groupBy(F.col(rate_code).alias("_code"), F.col(rate_ts).alias("_at")).agg(F.max(rate).alias("_rate"))
    least = F.lit(-(1 << 63)).cast("long")
    # a row's place among those of its time only spreads them over ranges; rates stand before all
    rows = tx.select(F.col(code).alias("_code"), F.col(ts).alias("_at"), F.shiftrightunsigned(F.xxhash64(*tx.columns), 1).alias("_tie"),
                     F.struct(*[F.col(f"`{c}`") for c in tx.columns]).alias("_row"))
    line = rows.unionByName(known.withColumn("_tie", least), allowMissingColumns=True).withColumn("_h", F.hash("_code"))
    line = line.withColumn("_bkt", F.greatest(ranges(line, "_at", "_tie", n), F.lit(0))).withColumn("_seen", F.when(F.col("_rate").isNotNull(), F.struct(
        F.col("_at").alias("at"), F.col("_rate").alias("rate"))))
    own = Window.partitionBy("_code", "_bkt").orderBy(F.col("_at").asc_nulls_first(), "_tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy("_code").orderBy("_bkt").rowsBetween(Window.unboundedPreceding, -1)
    carried = (line.groupBy("_code", "_bkt").agg(F.max_by("_rate", F.when(F.col("_rate").isNotNull(), micros("_at"))).alias("_r"),
                                                 F.max(F.when(F.col("_rate").isNotNull(), F.col("_at"))).alias("_t"))
               .select("_code", "_bkt", F.last("_r", ignorenulls=True).over(earlier).alias("_r"), F.last("_t", ignorenulls=True).over(earlier).alias("_t")))
    met = line.withColumn("_seen", F.last("_seen", ignorenulls=True).over(own)).join(carried, ["_code", "_bkt"], "left").where("_row is not null")
    out_rate, out_at = F.coalesce("_seen.rate", "_r"), F.coalesce("_seen.at", "_t")
    usable = F.col("_code").isNotNull() & F.col("_at").isNotNull()
    if tolerance_seconds is not None:
        usable = usable & (micros("_at") - F.unix_micros(out_at.cast("timestamp")) <= int(tolerance_seconds * 1_000_000))
    return met.select("_row.*", F.when(usable, out_rate).alias("rate"), F.when(usable, out_at).alias("rate_ts"))


def lookup(tx: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Dictionary lookup (left join).  The join strategy is Spark's size-based
    choice: broadcast for a small dictionary, shuffle join otherwise."""
    return tx.join(dim, key, "left")


def unmatched(tx: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose key is missing from the dictionary (data-quality report)."""
    return tx.join(dim.select(key), key, "left_anti")
