"""Aggregate column builders (the notebook's named and user-defined aggregates).

All are built-in Spark aggregates, so they run with partial (map-side)
aggregation.  The holistic statistics (median, mode, mode count) are not
built here: they come from a value histogram, see
``cardlens.operators.holistic`` (``keyed_stats`` combines both kinds).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUND = 6


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dbl(c) -> Column:
    return _c(c).cast("double")


def r6(c: Column) -> Column:
    return F.round(c, ROUND)


def safe_div(a, b) -> Column:
    """Division that gives NULL on a zero or NULL denominator (never inf)."""
    return F.try_divide(_c(a), _c(b))


def mean_div_std(c) -> Column:
    """mean / (population std + 1)."""
    return safe_div(F.avg(dbl(c)), F.stddev_pop(dbl(c)) + F.lit(1.0))


# Statistic name -> builder.  Outputs are DOUBLE (exact money sums are taken
# in DECIMAL and cast at the end); means and spreads are rounded to 6 places.
STAT_BUILDERS = {
    "sum": lambda c: F.sum(_c(c)).cast("double"),
    "mean": lambda c: r6(F.avg(dbl(c))),
    "std": lambda c: r6(F.stddev_samp(dbl(c))),
    "std_pop": lambda c: r6(F.stddev_pop(dbl(c))),
    "max": lambda c: F.max(_c(c)).cast("double"),
    "min": lambda c: F.min(_c(c)).cast("double"),
    "mean_div_std": lambda c: r6(mean_div_std(c)),
    "count": lambda c: F.count(_c(c)),
}


def stat_block(c, stats, prefix: str, where: Column | None = None) -> list[Column]:
    """One aliased aggregate per statistic, optionally restricted to rows
    where ``where`` holds (a FILTER clause, applied in the partial aggregate)."""
    src = _c(c) if where is None else F.when(where, _c(c))
    out = []
    for s in stats:
        if s in ("median", "mode", "mode_count"):
            continue
        out.append(STAT_BUILDERS[s](src).alias(f"{prefix}{s}"))
    return out
