"""Recency features: statistics over each client's last N days.

No cross join with the list of N: each N becomes a FILTER on the same
aggregate (the windows are nested), so the log is read and shuffled once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardlens.functions.stats import safe_div
from cardlens.operators.holistic import keyed_stats

KEY = "cl_id"
RECENCY_STATS = ("sum", "mean", "std", "median", "max", "min", "mode_count", "mode", "mean_div_std", "count")


def recency_flags(days, ts: str = "ts", last: str = "last_action") -> dict:
    """One 0/1 column per N: the row lies within N days before the client's
    last transaction (``last`` on the row)."""
    return {f"in_last_{n}": (F.col(ts) >= F.col(last) - F.make_dt_interval(F.lit(n))).cast("int") for n in days}


def with_last_action(tx: DataFrame, days, ts: str = "ts") -> DataFrame:
    """Client's last transaction time on each row, plus the flags.  The last
    time comes from one summary row per active (client, hour) and a window
    over those rows; rows join their summary on (client, hour), so a hot
    client is spread over its active hours (no client-only join)."""
    # rows without a time would be one key per client: they are dealt to 1024 slots below all hours
    b = tx.withColumn("_bkt", F.coalesce(F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / 3_600_000_000),
                                         F.lit(-(1 << 40)) - F.pmod(F.xxhash64(*tx.columns), F.lit(1024))))
    summary = (b.groupBy(KEY, "_bkt").agg(F.max(ts).alias("_bmax"))
               .select(F.col(KEY).alias("_k"), F.col("_bkt").alias("_b"), F.max("_bmax").over(Window.partitionBy(KEY)).alias("last_action")))
    met = F.col(KEY).eqNullSafe(F.col("_k")) & (F.col("_bkt") == F.col("_b"))
    return b.join(summary, met, "left").drop("_bkt", "_k", "_b").withColumns(recency_flags(days, ts))


def recency_blocks(days, value: str = "amount", stats=RECENCY_STATS) -> list:
    """Statistic blocks (see ``keyed_stats``): one per N, filtered by its flag."""
    return [(value, stats, f"last_action_minus_{n}_days_", F.col(f"in_last_{n}") == 1) for n in days]


def recency_name(n: int, stat: str) -> str:
    return f"last_action_minus_{n}_days_{stat}"


def recency_aggs(tx: DataFrame, days, value: str = "amount", stats=RECENCY_STATS, ts: str = "ts") -> DataFrame:
    """Ten statistics of ``value`` over each client's last N days, all N in
    one aggregate (each N is a filter); median / mode / mode count of all N
    share one (client, N, value) histogram."""
    return keyed_stats(with_last_action(tx, days, ts), [KEY], recency_blocks(days, value, stats))


def recency_ratios(features: DataFrame, days, stats=("sum", "mean", "std", "median", "max", "min"),
                   whole: dict | None = None) -> DataFrame:
    """Ratio of each recency statistic to the whole-history one (``_div_mean``),
    and for each pair of windows i < j: ``a_i / a_j`` (``_div_``) and
    ``(a_j - a_i) / a_j`` (``_prc_``).  Zero denominators give NULL."""
    whole = whole or {}
    cols = {}
    for s in stats:
        names = [recency_name(n, s) for n in days]
        base = whole.get(s)
        for a in names:
            if base is not None:
                cols[f"{a}_div_mean"] = safe_div(F.col(a).cast("double"), F.col(base).cast("double"))
        for i in range(len(names)):
            for j in range(i + 1, len(names)):
                ai, aj = F.col(names[i]).cast("double"), F.col(names[j]).cast("double")
                cols[f"{names[i]}_div_{names[j]}"] = safe_div(ai, aj)
                cols[f"{names[i]}_prc_{names[j]}"] = safe_div(aj - ai, aj)
    return features.withColumns({k: F.round(v, 6) for k, v in cols.items()})
