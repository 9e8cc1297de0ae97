"""Previous-row lookups within a client's timeline (lag) without one task per client.

A plain ``lag().over(partitionBy(client).orderBy(ts))`` sends every row of a
client to one task; a client holding a third of the log would then be a third
of the job in one task.  Here a client that holds more than one partition's share
of the rows is cut into ranges of (time, id) at approximate quantiles, one per
share: ``lag`` runs inside each (client, range), and the first row of a range
takes the last order value of the client's previous range from a small summary
(one row per client and range).  The result equals the plain window exactly; the
quantiles only decide where the cuts go.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_CUTS = 256     # quantiles taken of a hot client's timeline, of which its cuts are chosen


def ranges(rows: DataFrame, order_col: str, tiebreak: str | None, n: int) -> Column:
    """Number of the (time, id) range of each row: 0 for all rows of an ordinary client.

    n quantiles of the clients' 32-bit hashes ``_h`` show which clients hold more than a
    share of 1/n, and how many shares.  Those are cut at quantiles of their times, and a
    time that several cuts fall on at quantiles of its ids.  At most n numbers, the
    bounds and the cuts, reach the driver.
    """
    bounds = rows.agg(F.percentile_approx("_h", [i / n for i in range(1, n)], 10_000).alias("b")).first()["b"] if n > 1 else None
    hot = {h: c for h, c in Counter(bounds or []).items() if c > 1}
    if not hot:
        return F.lit(0)
    quantiles = [i / _CUTS for i in range(1, _CUTS)]
    pick = lambda values, k: [values[j * _CUTS // k - 1] for j in range(1, k)]
    timed = rows.withColumn("_t", F.unix_micros(F.col(order_col).cast("timestamp"))).where(F.col("_h").isin(*hot))
    by_time = {r["_h"]: Counter(pick(r["c"], hot[r["_h"]])) for r in
               timed.where("_t is not null").groupBy("_h").agg(F.percentile_approx("_t", quantiles, 10_000).alias("c")).collect()}
    cuts = {h: [(t << 64) + (1 << 64) - 1 for t in times] for h, times in by_time.items()}
    crowded = {(h, t): k + 1 for h, times in by_time.items() for t, k in times.items() if k > 1}
    if crowded and tiebreak:
        here = F.struct("_h", "_t").isin(*[F.struct(F.lit(h), F.lit(t)) for h, t in crowded])
        for r in timed.where(here).groupBy("_h", "_t").agg(F.percentile_approx(F.col(tiebreak).cast("long"), quantiles, 10_000).alias("c")).collect():
            h, t = r["_h"], r["_t"]
            cuts[h] += [(t << 64) + i + (1 << 63) for i in pick(r["c"], crowded[h, t])]
    kind = "decimal(38,0)"
    table = F.create_map(*[x for h, c in cuts.items() for x in (F.lit(h), F.array(*[F.lit(str(v)).cast(kind) for v in sorted(set(c))]))]) \
        if cuts else None
    if table is None:
        return F.lit(0)
    order = order_key(order_col, tiebreak) if tiebreak else \
        (F.unix_micros(F.col(order_col).cast("timestamp")).cast(kind) * F.lit(_SHIFT).cast(kind)).cast(kind)
    return F.size(F.filter(F.try_element_at(table, F.col("_h")), lambda c: c < order))


def with_previous(df: DataFrame, keys: list[str], order_col: str, tiebreak: str | None = None, out: str = "prev",
                  last_out: str | None = None, shares: int | None = None) -> DataFrame:
    """Add ``out`` = the ``order_col`` value of the previous row in
    ``(keys) order by order_col, tiebreak``; NULL on the client's first row.
    With ``last_out``, also the key's last ``order_col`` value (taken from the
    same summary, so it costs no extra join).

    ``shares`` (by default the number of shuffle partitions) is how finely hot
    clients are cut.  Window, summary and join have the same keys, so the rows are
    shuffled once."""
    n = shares or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(order_col)] + ([F.col(tiebreak)] if tiebreak else [])
    rows = df.withColumn("_h", F.hash(*keys))
    b = rows.withColumn("_bkt", F.greatest(ranges(rows, order_col, tiebreak, n), F.lit(0))).drop("_h")
    parts = [*keys, "_bkt"]
    inner = b.withColumn("_prev_in", F.lag(order_col).over(Window.partitionBy(*parts).orderBy(*order)))
    summary = (b.groupBy(*parts).agg(F.max(order_col).alias("_smax"))
               .withColumn("_prev_b", F.lag("_smax").over(Window.partitionBy(*keys).orderBy("_bkt"))))
    if last_out:
        summary = summary.withColumn(last_out, F.max("_smax").over(Window.partitionBy(*keys)))
    summary = summary.drop("_smax")
    joined = inner.join(summary, parts, "left")
    return joined.withColumn(out, F.coalesce("_prev_in", "_prev_b")).drop("_bkt", "_prev_in", "_prev_b")


_SHIFT = "18446744073709551616"   # 2^64
_OFFSET = "9223372036854775808"   # 2^63


def order_key(ts: str, tiebreak: str) -> Column:
    """``(ts, tiebreak)`` packed into one DECIMAL(38,0) that sorts the same
    way: micros * 2^64 + (tiebreak + 2^63).  A fixed-width value, so ``min`` /
    ``min_by`` over it stay hash aggregates that combine map-side (ordering by
    a struct would force a sort-based aggregate)."""
    dec = "decimal(38,0)"
    micros = F.unix_micros(F.col(ts).cast("timestamp")).cast(dec)
    hi = (micros * F.lit(_SHIFT).cast(dec)).cast(dec)
    lo = (F.col(tiebreak).cast(dec) + F.lit(_OFFSET).cast(dec)).cast(dec)
    return (hi + lo).cast(dec)


def first_by(df: DataFrame, keys: list[str], value: str, order: list[str], out: str) -> DataFrame:
    """Per key, ``value`` of the first row by ``order`` (lexicographic; the
    last order column should be unique, e.g. a transaction id).

    A (time, id) order is packed into one sortable decimal (``order_key``), so
    this is a single partial aggregate keyed by ``keys``.  Other orders use a
    chain of hash aggregates, one order column at a time, last to first."""
    if len(order) == 2:
        return df.groupBy(*keys).agg(F.min_by(F.col(value), order_key(*order)).alias(out))
    cur = df.select(*keys, *order, F.col(value).alias("_x"))
    for i in range(len(order) - 1, -1, -1):
        cur = cur.groupBy(*keys, *order[:i]).agg(F.min_by("_x", order[i]).alias("_x"))
    return cur.select(*keys, F.col("_x").alias(out))
