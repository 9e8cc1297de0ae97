"""Each row on its client's own calendar, and the row-level enrichment.

Per-client minima/maxima come from one summary row per active (client, day):
windows over those summary rows (bounded by the calendar) give the client's
first and last values, and the rows join their summary on (client, day).  No
per-client window or client-only join holds a whole client in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.functions import calendar as cal
from cardlens.functions.config import FeatureConfig
from cardlens.operators.dictionary import with_membership
from cardlens.operators.sequence import order_key

KEY = "cl_id"


def with_period(tx: DataFrame, ts: str = "ts", period: str = "period") -> DataFrame:
    """Add the card period (first day of the month) when the log lacks one."""
    if period in tx.columns:
        return tx
    return tx.withColumn(period, F.trunc(F.col(ts), "MM"))


def tenure_fields(tx: DataFrame, ts: str = "ts", period: str = "period", day_diff: str | None = None,
                  tiebreak: str = "tx_id") -> DataFrame:
    """Relative calendars of each row.

    * ``months_before_last``: period month minus the client's last period month (0, -1, ...)
    * ``week_number``, ``day_number``: epoch week/day minus the client's first
    * ``transaction_day``: whole days since the client's first transaction time
    * ``period_number``: period month minus the client's first period month
    * ``transaction_week``: transaction_day // 7
    * with ``day_diff``: that column as in ``with_day_diff``, from the same join

    Plan: one summary row per active (client, day); the client-level minima
    and maxima (and the previous active day) are windows over those summary
    rows, whose count per client is bounded by the calendar; the rows join
    their summary on (client, day), so a hot client is spread over its days.
    """
    t = with_period(tx, ts, period)
    g = "global_day_number"
    t = (t.withColumn("period_month", cal.month_index(period))
         .withColumn("week_global_number", cal.epoch_week(ts))
         .withColumn(g, cal.epoch_day(ts)))
    aggs = [F.min(ts).alias("_dts"), F.min("period_month").alias("_pmn"),
            F.max("period_month").alias("_pmx"), F.min("week_global_number").alias("_wk")]
    if day_diff:
        # first (time, id) of the day: the smallest packed order key
        t = t.withColumn("_ok", order_key(ts, tiebreak))
        aggs.append(F.min("_ok").alias("_fok"))
    t = t.withColumn("_slot", _slot(t, g, tiebreak))
    days = t.groupBy(KEY, "_slot").agg(F.first(g).alias(g), *aggs)
    w = Window.partitionBy(KEY)
    cols = [KEY, "_slot", F.max("_pmx").over(w).alias("_last_pm"), F.min("_pmn").over(w).alias("_first_pm"),
            F.min("_wk").over(w).alias("_first_wk"), F.min(g).over(w).alias("_first_day"),
            F.min("_dts").over(w).alias("_first_ts")]
    if day_diff:
        cols += ["_fok", F.lag(g).over(w.orderBy(g)).alias("_prev_day")]
    j = _join_summary(t, days.select(*cols))
    tday = F.floor(F.expr(f"timestampdiff(MICROSECOND, _first_ts, {ts})") / F.lit(86400 * 1000000))
    j = (j.withColumn("months_before_last", F.col("period_month") - F.col("_last_pm"))
         .withColumn("week_number", F.col("week_global_number") - F.col("_first_wk"))
         .withColumn("day_number", F.col(g) - F.col("_first_day"))
         .withColumn("transaction_day", tday.cast("int"))
         .withColumn("period_number", F.col("period_month") - F.col("_first_pm"))
         .withColumn("transaction_week", F.floor(F.col("transaction_day") / 7).cast("int")))
    if day_diff:
        is_first = _carries()
        diff = F.when(is_first & F.col("_prev_day").isNotNull(),
                      F.greatest(F.col(g) - F.col("_prev_day"), F.lit(0))).otherwise(F.lit(0))
        j = j.withColumn(day_diff, diff.cast("int")).drop("_ok", "_fok", "_prev_day")
    return j.drop("_last_pm", "_first_pm", "_first_wk", "_first_day", "_first_ts", "_slot")


TIMELESS = 1024     # slots of a client's rows without a time


def _slot(t: DataFrame, day: str, tiebreak: str) -> Column:
    """The row's day.  Rows without one would be a single key per client; they are dealt to ``TIMELESS`` slots below all days."""
    spread = F.xxhash64(tiebreak) if tiebreak in t.columns else F.xxhash64(*t.columns)
    return F.coalesce(F.col(day).cast("long"), F.lit(-(1 << 40)) - F.pmod(spread, F.lit(TIMELESS)))


def _join_summary(rows: DataFrame, summary: DataFrame) -> DataFrame:
    """Rows with the summary row of their (client, slot); a NULL client meets too."""
    named = summary.select(F.col(KEY).alias("_k"), F.col("_slot").alias("_s"), *[c for c in summary.columns if c not in (KEY, "_slot")])
    return rows.join(named, rows[KEY].eqNullSafe(F.col("_k")) & (rows["_slot"] == F.col("_s")), "left").drop("_k", "_s")


def _carries() -> Column:
    """The row is the day's first by the order key; of rows equal in it, one.  The window's keys begin with the
    join's, so it needs no shuffle of its own, unless the join is skewed: then (``forceOptimizeSkewedJoin``) a hot
    (client, day) is split for the join and dealt by the order key for the window."""
    one = F.row_number().over(Window.partitionBy(KEY, "_slot", "_ok").orderBy(F.lit(0)))
    return (F.col("_ok") == F.col("_fok")) & (one == 1)


def with_day_diff(tx: DataFrame, day_col: str = "day_number", ts: str = "ts", tiebreak: str = "tx_id",
                  out: str = "day_diff") -> DataFrame:
    """Tenure days since the client's previous transaction (rows ordered by
    day, time, id); 0 on the client's first row and on later rows of a day.

    Only the first row of each (client, day) can be non-zero, so the lookup
    runs on one summary row per active client-day, not on the rows.
    """
    # first (time, id) of each client-day: the smallest packed order key, a
    # hash aggregate that combines map-side to one row per client-day
    t = tx.withColumn("_ok", order_key(ts, tiebreak)).withColumn("_slot", _slot(tx, day_col, tiebreak))
    first = (t.groupBy(KEY, "_slot").agg(F.first(day_col).alias("_day"), F.min("_ok").alias("_fok"))
             .withColumn("_prev_day", F.lag("_day").over(Window.partitionBy(KEY).orderBy("_day"))).drop("_day"))
    j = _join_summary(t, first)
    is_first = _carries()
    diff = F.when(is_first & F.col("_prev_day").isNotNull(),
                  F.greatest(F.col(day_col) - F.col("_prev_day"), F.lit(0))).otherwise(F.lit(0))
    return j.withColumn(out, diff.cast("int")).drop("_ok", "_fok", "_prev_day", "_slot")


def tenure_cut(tx: DataFrame, max_day: int, ts: str = "ts") -> DataFrame:
    """Keep rows whose transaction_day (whole days since the client's first
    transaction) is at most ``max_day``."""
    t = tx if "transaction_day" in tx.columns else tenure_fields(tx, ts)
    return t.filter(F.col("transaction_day") <= max_day)


def enrich(tx: DataFrame, cfg: FeatureConfig, ts: str = "ts", amount: str = "amount",
           category: str = "category", channel: str = "channel_type", tenure: bool = True) -> DataFrame:
    """All row-level columns of the notebook's dataset loader in one projection
    plus one client-keyed aggregate join (tenure) and one client-day join
    (day_diff).  ``amount`` is used as given (convert currency first).
    ``tenure=False`` leaves out the two joins and the columns they feed
    (tenure calendars, period parts, day_diff) for queries that need none."""
    t = tx
    cols = {
        "tr_hour": F.hour(ts),
        "week_day": cal.weekday0(ts),
        "quartel": cal.quarter0(ts),
        "is_holiday": cal.holiday_flag(ts, cfg.holidays),
        "day": F.dayofmonth(ts),
        "year": F.year(ts),
        "month": cal.base_month_index(ts, cfg.base_year),
        "days_since": cal.days_since(ts, cfg.days_since),
    }
    if channel in t.columns:
        cols["channel_code"] = cal.channel_code(channel)
    t = t.withColumns(cols).withColumn("day_part", cal.day_part("tr_hour"))
    if "mcc" in t.columns:
        t = with_membership(t, "mcc", cfg.bad_mcc, "_bad_mcc")
        t = t.withColumn("is_good_mcc", ~F.col("_bad_mcc")).drop("_bad_mcc")
    if tenure:
        t = tenure_fields(t, ts, day_diff="day_diff")
        t = t.withColumns({f"period_part_{n}": cal.period_part("day_number", n) for n in cfg.period_parts})
    t = t.withColumns({f"ostatok_{d}": cal.round_flag(amount, d) for d in cfg.round_divisors})
    income = F.col(category).isin(*cfg.income_categories)
    return t.withColumn("signed_amount", F.when(income, F.abs(F.col(amount))).otherwise(-F.col(amount)))
