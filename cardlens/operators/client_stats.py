"""Per-client statistics of the transaction log (one row per client).

Everything keyed by the client is one ``groupBy(cl_id)`` with partial
aggregation; statistics that need a value histogram (median, mode, mode
count) aggregate on ``(cl_id, value)`` first, which spreads a hot client over
many tasks (``cardlens.operators.holistic``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.functions.stats import dbl, r6, safe_div
from cardlens.operators.daybits import day_sets
from cardlens.operators.holistic import keyed_stats
from cardlens.operators.sequence import first_by, with_previous

KEY = "cl_id"


def mode_counts(df: DataFrame, keys: list[str], value, out: str = "mode_count",
                where: Column | None = None) -> DataFrame:
    """How often the modal value occurs, per key: a two-level aggregate."""
    v = F.col(value) if isinstance(value, str) else value
    src = df if where is None else df.filter(where)
    hist = src.filter(v.isNotNull()).groupBy(*keys, v.alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    return hist.groupBy(*keys).agg(F.max("_n").alias(out))


def gap_minutes(prev: str, ts: str, modulo_day: bool = True) -> Column:
    """Minutes between two timestamps, whole seconds; modulo 24 h by default
    (the reference keeps only the within-day seconds of the difference)."""
    secs = F.expr(f"timestampdiff(SECOND, {prev}, {ts})")
    if modulo_day:
        secs = secs % 86400
    return secs.cast("double") / 60.0


def client_gap_stats(tx: DataFrame, ts: str = "ts", tiebreak: str = "tx_id",
                     modulo_day: bool = True, prefix: str = "gap_") -> DataFrame:
    """min/max/mean/std_pop/median of minutes between a client's consecutive
    transactions (NULL for a one-row client)."""
    seq = with_previous(tx.select(KEY, ts, tiebreak), [KEY], ts, tiebreak, out="_prev")
    g = seq.withColumn("_gap", gap_column("_prev", ts, modulo_day))
    extra, blocks = gap_blocks(prefix)
    return keyed_stats(g, [KEY], blocks, extra_aggs=extra)


def gap_column(prev: str, ts: str, modulo_day: bool = True) -> Column:
    return F.when(F.col(prev).isNotNull(), gap_minutes(prev, ts, modulo_day))


def gap_blocks(prefix: str, gap: str = "_gap"):
    """(aggregates, holistic blocks) of the gap statistics, for ``keyed_stats``."""
    g = F.col(gap)
    extra = [r6(F.min(g)).alias(f"{prefix}min"), r6(F.max(g)).alias(f"{prefix}max"),
             r6(F.avg(g)).alias(f"{prefix}mean"), r6(F.stddev_pop(g)).alias(f"{prefix}std")]
    return extra, [(gap, ("median",), prefix, None)]


def client_stats(tx: DataFrame, value: str, stats, prefix: str, where: Column | None = None) -> DataFrame:
    """The notebook's per-client statistic loops as one aggregate (plus the
    histogram pass for median / mode / mode count)."""
    return keyed_stats(tx, [KEY], [(value, stats, prefix, where)])


def money_double(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def client_counts(tx: DataFrame, value: str = "amount") -> DataFrame:
    """Number of non-null amounts and their exact sum per client."""
    return tx.groupBy(KEY).agg(F.count(value).alias("num_deals"),
                               money_double(F.sum(value)).alias("sum_deals"))


def client_lifespan(tx: DataFrame, base_year: int, ts: str = "ts") -> DataFrame:
    """Whole days between first and last transaction; first/last month index
    (from ``base_year``) and their difference."""
    from cardlens.functions.calendar import base_month_index
    g = tx.groupBy(KEY).agg(F.min(ts).alias("_mn"), F.max(ts).alias("_mx"))
    return g.select(
        KEY, F.expr("timestampdiff(DAY, _mn, _mx)").cast("int").alias("num_days_in_use"),
        base_month_index("_mx", base_year).alias("max_month"), base_month_index("_mn", base_year).alias("min_month"),
        (base_month_index("_mx", base_year) - base_month_index("_mn", base_year)).alias("delta_month"))


def client_active_days(tx: DataFrame, day_col: str = "days_since") -> DataFrame:
    """Distinct active days and the density distinct / (last - first + 1)."""
    return day_sets(tx, day_col)


def month_cohort(tx: DataFrame, month_col: str = "month") -> DataFrame:
    """Per month: rows, distinct clients and rows per client."""
    g = tx.groupBy(month_col).agg(F.count(KEY).alias("num_deals_month"),
                                  F.count_distinct(KEY).alias("uniq_len_num_cards"))
    return g.withColumn("avg_act", r6(safe_div(F.col("num_deals_month").cast("double"),
                                               F.col("uniq_len_num_cards").cast("double"))))


def month_amount_stats(tx: DataFrame, value: str = "amount", month_col: str = "month") -> DataFrame:
    """Global statistics of the amount per month.  A month is a huge group, so
    its median goes through the bucketed histogram, never one buffer."""
    return keyed_stats(tx, [month_col], [(dbl(value), ("median",), "ag_month_", None)], extra_aggs=[
        money_double(F.sum(value)).alias("ag_month_sum"), r6(F.avg(dbl(value))).alias("ag_month_mean"),
        r6(F.stddev_samp(dbl(value))).alias("ag_month_std"),
        r6(safe_div(F.avg(dbl(value)), F.stddev_pop(dbl(value)) + 1.0)).alias("ag_month_mean_div_std")])


def attach_by_month(clients: DataFrame, per_month: DataFrame, client_month: str, prefix: str,
                    month_col: str = "month") -> DataFrame:
    """Left join a per-month table onto clients by one of their month columns
    (role-played: first month, last month).  The per-month table has one row
    per calendar month, so its size is bounded by the calendar and it is
    broadcast."""
    renamed = per_month.select(F.col(month_col).alias(client_month),
                               *[F.col(c).alias(f"{prefix}{c}") for c in per_month.columns if c != month_col])
    return clients.join(F.broadcast(renamed), client_month, "left")


def client_first_value(tx: DataFrame, value: str, order: list[str], out: str) -> DataFrame:
    """The value of the client's first row by ``order`` (deterministic)."""
    return first_by(tx, [KEY], value, order, out)


def client_target(rows: DataFrame, labels=("target_flag", "target_sum")) -> DataFrame:
    """Client label = max of its row labels."""
    return rows.groupBy(KEY).agg(*[F.max(c).alias(c) for c in labels])


def wide_join(left: DataFrame, right: DataFrame, on: str = KEY, how: str = "left",
              lsuffix: str = "_l", rsuffix: str = "_r") -> DataFrame:
    """Join two wide client tables; clashing names get suffixes."""
    clash = (set(left.columns) & set(right.columns)) - {on}
    l2 = left.select(*[F.col(c).alias(c + lsuffix) if c in clash else F.col(c) for c in left.columns])
    r2 = right.select(*[F.col(c).alias(c + rsuffix) if c in clash else F.col(c) for c in right.columns])
    return l2.join(r2, on, how)
