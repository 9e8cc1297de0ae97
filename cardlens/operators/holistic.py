"""Exact median, mode and mode count per key, without one task per key.

Spark's ``median`` / ``mode`` aggregates keep every distinct value of a group
in one in-memory buffer, merged in one task: a client (or a month) holding a
third of the log would put a third of its distinct values in one buffer.
Here the statistics are computed from a value histogram instead:

1. ``hist``: rows per ``(key, value)``, a partial aggregate spread over the
   cluster by the value, so a hot key is split across tasks.  All statistics
   of one value (whole history, windows, categories) are counted in it at once.
2. mode and mode count: partial aggregates over the histogram.
3. exact median (Spark's ``percentile(v, 0.5)``: the mean of the two middle
   ranks): keys with at most ``small_group`` distinct values are ranked in
   one window each (bounded size).  Keys with more distinct values are cut
   into ``buckets`` value ranges at approximate quantiles (a bounded
   mergeable sketch); running counts are taken over the bucket totals
   (``buckets`` rows per key) and only the one or two buckets holding the
   middle ranks are ranked row by row.  The answer is exact either way: the
   sketch only decides where the cuts go.  The histogram meets the per-key
   cuts on ``(key, hash(value) % salt)``, so no step routes a hot key's
   histogram to a single task.

Several statistics (different values, filters) share one pass: each row
emits one entry per value, with a mask of the statistics it counts in.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.session import write_table

HOLISTIC = ("median", "mode", "mode_count")

# Keys with more distinct values than this are split into value buckets.
SMALL_GROUP = 100_000
BUCKETS = 512
SKETCH_ACCURACY = 10_000
SALT = 64


@dataclass(frozen=True)
class HolisticSpec:
    """Holistic statistics of ``value`` over rows where ``where`` holds;
    outputs ``{prefix}{stat}``."""
    value: Column
    stats: tuple
    prefix: str
    where: Column | None = None


_BITS = 60      # statistics of one value that share a bit mask


def _codes(specs: list[HolisticSpec]) -> list[int]:
    """Code of each statistic: _BITS times its value's number, plus its bit.  Statistics
    of the same value expression have the same number."""
    groups: dict[tuple[str, int], int] = {}
    used: dict[str, int] = {}
    out = []
    for s in specs:
        name = str(s.value)
        n = used[name] = used.get(name, -1) + 1
        g = groups.setdefault((name, n // _BITS), len(groups))
        out.append(g * _BITS + n % _BITS)
    return out


def value_histogram(df: DataFrame, keys: list[str], specs: list[HolisticSpec], codes: list[int]) -> DataFrame:
    """``(keys, _m, _v, _n)``: rows per statistic code and value.

    A row gives one entry per value expression, not per statistic: the entry's bit mask
    says which statistics it counts in.  One partial aggregate per (key, value) counts
    each bit, so however many windows and categories share a value, the shuffle has
    one row per distinct value; the statistics are told apart after it."""
    groups: dict[int, list[int]] = {}
    for i, c in enumerate(codes):
        groups.setdefault(c // _BITS, []).append(i)
    entries = []
    for g, members in groups.items():
        mask = F.lit(0).cast("long")
        for i in members:
            bit = F.lit(1 << (codes[i] % _BITS)).cast("long")
            mask = mask + (bit if specs[i].where is None else F.when(specs[i].where, bit).otherwise(F.lit(0).cast("long")))
        entries.append(F.struct(F.lit(g).alias("g"), specs[members[0]].value.cast("double").alias("v"), mask.alias("mask")))
    width = max(len(m) for m in groups.values())
    e = F.col("_e")
    long = (df.select(*keys, F.explode(F.array(*entries)).alias("_e")).where(e["v"].isNotNull() & (e["mask"] != 0))
            .select(*keys, e["g"].alias("_g"), e["v"].alias("_v"), e["mask"].alias("_mask")))
    bits = [F.sum(F.shiftright("_mask", b).bitwiseAND(F.lit(1).cast("long"))).alias(f"_b{b}") for b in range(width)]
    counts = long.groupBy(*keys, "_g", "_v").agg(*bits)
    each = F.array(*[F.struct((F.col("_g") * _BITS + b).alias("m"), F.col(f"_b{b}").alias("n")) for b in range(width)])
    return (counts.select(*keys, "_v", F.explode(F.filter(each, lambda x: x["n"] > 0)).alias("_x"))
            .select(*keys, F.col("_x.m").alias("_m"), "_v", F.col("_x.n").alias("_n")))


def key_summary(hist: DataFrame, gkeys: list[str]) -> DataFrame:
    """Per key: rows ``_N``, distinct values ``_D``, the mode (smallest value
    on ties) and the mode count.  Two hash aggregates with fixed-width
    buffers: the smallest value per (key, count), then ``max_by`` over the
    count, which is unique per key at that level."""
    by_count = hist.groupBy(*gkeys, "_n").agg(F.min("_v").alias("_minv"), F.count(F.lit(1)).alias("_k"))
    return by_count.groupBy(*gkeys).agg(
        F.sum(F.col("_n") * F.col("_k")).alias("_N"), F.sum("_k").alias("_D"),
        F.max_by("_minv", "_n").alias("_mode"), F.max("_n").alias("_mode_count"))


def cuts_below(cuts: str, value: Column, most: int) -> Column:
    """How many of the at most ``most`` sorted ``cuts`` are below ``value``, by halving: log2(most) looks instead of ``most``."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: at + F.when(F.get(cuts, at + step - 1) < value, step).otherwise(0))


def exact_median(hist: DataFrame, per: DataFrame, gkeys: list[str], small_group: int = SMALL_GROUP,
                 buckets: int = BUCKETS, accuracy: int = SKETCH_ACCURACY, salt: int = SALT) -> DataFrame:
    """``(gkeys, _median, _mode, _mode_count)`` from a histogram
    ``(gkeys, _v, _n)`` and its ``key_summary``.

    The histogram is joined to the hot keys and their cuts on ``(key, salt)``
    with the salt a hash of the value, so a hot key's histogram stays spread
    over ``salt`` tasks; only the small per-hot-key rows are replicated
    (``salt`` copies of at most ``buckets`` numbers per key that already has
    more than ``small_group`` distinct values)."""
    hs = hist.withColumn("_s", F.pmod(F.xxhash64("_v"), F.lit(salt)).cast("int"))
    fan = F.explode(F.sequence(F.lit(0), F.lit(salt - 1))).alias("_s")
    hot = per.filter(F.col("_D") > small_group).select(*gkeys, fan)
    probs = [i / buckets for i in range(1, buckets)]
    cuts = (hs.join(hot, [*gkeys, "_s"], "left_semi").groupBy(*gkeys)
            .agg(F.percentile_approx("_v", probs, accuracy).alias("_cuts"))
            .select(*gkeys, "_cuts", fan))
    bucket = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(cuts_below("_cuts", F.col("_v"), buckets - 1))
    hb = hs.join(cuts, [*gkeys, "_s"], "left").select(*gkeys, "_v", "_n", bucket.alias("_b"))

    # running row count before each bucket (at most ``buckets`` rows per key)
    # and the bucket(s) holding the middle ranks (0-based)
    before = Window.partitionBy(*gkeys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    pos = (F.col("_N") - 1) / 2.0
    btot = (hb.groupBy(*gkeys, "_b").agg(F.sum("_n").alias("_bn"))
            .withColumn("_bs", F.coalesce(F.sum("_bn").over(before), F.lit(0)))
            .join(per.select(*gkeys, "_N", "_mode", "_mode_count"), gkeys)
            .select(*gkeys, "_b", "_bs", "_bn", pos.alias("_pos"), F.floor(pos).alias("_lo"),
                    F.ceil(pos).alias("_hi"), "_mode", "_mode_count"))
    covers = lambda r: (F.col("_bs") <= F.col(r)) & (F.col(r) < F.col("_bs") + F.col("_bn"))
    target = btot.filter(covers("_lo") | covers("_hi")).drop("_bn")

    # rank rows only inside those buckets (bounded: a small key's whole
    # histogram, or about 1/buckets of a hot key's)
    upto = Window.partitionBy(*gkeys, "_b").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cand = (hb.join(target, [*gkeys, "_b"])
            .withColumn("_ce", F.col("_bs") + F.sum("_n").over(upto))
            .withColumn("_cs", F.col("_ce") - F.col("_n")))
    at = lambda r: F.max(F.when((F.col("_cs") <= F.col(r)) & (F.col(r) < F.col("_ce")), F.col("_v")))
    picks = cand.groupBy(*gkeys).agg(at("_lo").alias("_lv"), at("_hi").alias("_hv"),
                                     *[F.max(c).alias(c) for c in ("_pos", "_lo", "_hi", "_mode", "_mode_count")])
    # Spark's percentile: (hi - pos) * v[lo] + (pos - lo) * v[hi]
    med = F.when((F.col("_hi") == F.col("_lo")) | (F.col("_lv") == F.col("_hv")), F.col("_lv")).otherwise(
        (F.col("_hi") - F.col("_pos")) * F.col("_lv") + (F.col("_pos") - F.col("_lo")) * F.col("_hv"))
    return picks.select(*gkeys, med.alias("_median"), "_mode", "_mode_count")


def holistic_stats(df: DataFrame, keys: list[str], specs: list[HolisticSpec], round_to: int | None = 6,
                   **median_opts) -> DataFrame:
    """One row per key with ``{prefix}median`` (rounded like the other
    statistics), ``{prefix}mode`` (double; the smallest value on ties) and
    ``{prefix}mode_count`` for each spec, as requested.  A key without rows
    for a spec gets NULLs."""
    specs = [s for s in specs if set(s.stats) & set(HOLISTIC)]
    gkeys = [*keys, "_m"]
    codes = _codes(specs)
    hist = value_histogram(df, keys, specs, codes)
    if any("median" in s.stats for s in specs):
        # read by the summary, the cuts and the ranks: written once, so that neither the plan nor a lost executor repeats what is above
        hist = write_table(hist, "histogram")
        long = exact_median(hist, key_summary(hist, gkeys), gkeys, **median_opts)
    else:
        long = key_summary(hist, gkeys)
    aggs = []
    for code, s in zip(codes, specs):
        mine = F.col("_m") == code
        for st in s.stats:
            if st == "median":
                c = F.col("_median") if round_to is None else F.round(F.col("_median"), round_to)
            elif st == "mode":
                c = F.col("_mode")
            elif st == "mode_count":
                c = F.col("_mode_count")
            else:
                continue
            aggs.append(F.max(F.when(mine, c)).alias(f"{s.prefix}{st}"))
    return long.groupBy(*keys).agg(*aggs)


def keyed_stats(df: DataFrame, keys: list[str], blocks, extra_aggs=(), **median_opts) -> DataFrame:
    """Statistic blocks ``(value, stats, prefix, where)`` per key: the
    algebraic ones in one partial aggregate, the holistic ones (median, mode,
    mode count) through ``holistic_stats``, joined on the key."""
    from cardlens.functions.stats import stat_block, _c
    aggs = list(extra_aggs)
    specs = []
    for value, stats, prefix, where in blocks:
        aggs += stat_block(value, stats, prefix, where)
        hol = tuple(s for s in stats if s in HOLISTIC)
        if hol:
            specs.append(HolisticSpec(_c(value), hol, prefix, where))
    out = df.groupBy(*keys).agg(*aggs) if aggs else df.select(*keys).distinct()
    if specs:
        out = out.join(holistic_stats(df, keys, specs, **median_opts), keys, "left")
    return out
