"""Wide per-client pivots: sums and shares by calendar, tenure, currency, MCC.

Plan shape: every row emits one ``(label, amount)`` entry per dimension it
belongs to (a short in-memory array, no shuffle), the entries are summed per
``(client, label)`` with partial aggregation, and one ``pivot`` with the
fitted label list turns them into columns.  Every dimension of the feature
table therefore costs the same two shuffles in total, instead of one
filter+groupBy+join per output column.  Two reserved labels carry the
client's total and good-MCC total for shares.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.functions.config import FeatureConfig
from cardlens.functions.stats import safe_div
from cardlens.operators.daybits import countable, day_sets
from cardlens.operators.holistic import keyed_stats
from cardlens.session import write_table

KEY = "cl_id"
TOTAL = "__total__"
GOOD_TOTAL = "__good__"
CAT_STATS = ("sum", "mean", "std", "median", "max", "min", "mode_count", "mode", "mean_div_std", "count")


@dataclass(frozen=True)
class PivotDim:
    """One pivot dimension: columns ``{prefix}{value}`` for the fitted values (None: those of a label table)."""
    prefix: str
    expr: Column
    values: tuple | None
    where: Column | None = None
    share_of: str | None = None   # None, TOTAL or GOOD_TOTAL

    def labels(self) -> list[str]:
        return [f"{self.prefix}{v}" for v in self.values]


GOOD_COL = "is_good_mcc"


def with_good_mcc(tx: DataFrame, bad_codes, mcc: str = "mcc") -> DataFrame:
    if mcc not in tx.columns:
        return tx.withColumn(GOOD_COL, F.lit(True))
    from cardlens.operators.dictionary import with_membership
    return with_membership(tx, mcc, bad_codes, "_bad").withColumn(GOOD_COL, ~F.col("_bad")).drop("_bad")


def is_good(mcc: str | None) -> Column:
    """The precomputed good-MCC flag (``mcc`` names the flag column; None means
    the log has no MCC and every row is good)."""
    return F.col(mcc) if mcc else F.lit(True)


def pos_good(cfg: FeatureConfig, category: str = "category", mcc: str | None = GOOD_COL) -> Column:
    return (F.col(category) == cfg.pos_category) & is_good(mcc)


def pivot_sums(tx: DataFrame, dims: list[PivotDim], value: str = "amount", good: str | None = GOOD_COL,
               fill: float | None = 0.0) -> DataFrame:
    """All dimensions in one long-form aggregate and one pivot.

    Each output column is the client's sum of ``value`` over rows in the
    dimension value (and ``where``), divided by the client total or good-MCC
    total when ``share_of`` is set.  Every client of ``tx`` gets a row.
    """
    v = F.col(value)
    entries = [F.struct(F.lit(TOTAL).alias("l"), v.alias("v"))]
    need_good = any(d.share_of == GOOD_TOTAL for d in dims)
    if need_good:
        entries.append(F.when(is_good(good), F.struct(F.lit(GOOD_TOTAL).alias("l"), v.alias("v"))))
    for d in dims:
        cond = d.expr.isin(*d.values)
        if d.where is not None:
            cond = cond & d.where
        lab = F.concat(F.lit(d.prefix), d.expr.cast("string"))
        entries.append(F.when(cond, F.struct(lab.alias("l"), v.alias("v"))))
    long = (tx.select(KEY, F.explode(F.array(*entries)).alias("e"))
            .filter(F.col("e").isNotNull())
            .groupBy(KEY, F.col("e.l").alias("l")).agg(F.sum("e.v").alias("s")))
    labels = [TOTAL] + ([GOOD_TOTAL] if need_good else []) + [lab for d in dims for lab in d.labels()]
    wide = long.groupBy(KEY).pivot("l", labels).agg(F.first("s"))
    cols = [F.col(KEY)]
    for d in dims:
        for lab in d.labels():
            c = F.col(f"`{lab}`").cast("double")
            if d.share_of is not None:
                c = F.round(safe_div(c, F.col(f"`{d.share_of}`").cast("double")), 6)
            if fill is not None:
                c = F.coalesce(c, F.lit(fill))
            cols.append(c.alias(lab))
    return wide.select(*cols)


def open_labels(tx: DataFrame, dims: list[PivotDim]) -> DataFrame:
    """(label): the labels that the dimensions without a value list have in ``tx``, in one pass."""
    entries = [F.concat(F.lit(d.prefix), d.expr.cast("string")) for d in dims if d.values is None]
    return tx.select(F.explode(F.array(*entries)).alias("label")).where("label is not null").distinct()


def pivot_long(tx: DataFrame, dims: list[PivotDim], labels: DataFrame, value: str = "amount", good: str | None = GOOD_COL) -> DataFrame:
    """The columns of ``pivot_sums`` as (client, feature, x) rows, those that are not 0.  Dimensions without a value list take
    the labels of a table (``open_labels``), which may have any size; the plan does not grow with the values."""
    v = F.col(value)
    entry = lambda label, open_, share: F.struct(label.alias("l"), F.lit(open_).alias("o"), F.lit(share).alias("t"), v.alias("v"))
    entries = [entry(F.lit(TOTAL), False, None), F.when(is_good(good), entry(F.lit(GOOD_TOTAL), False, None))]
    for d in dims:
        cond = d.expr.isNotNull() if d.values is None else d.expr.isin(*d.values)
        cond = cond if d.where is None else cond & d.where
        entries.append(F.when(cond, entry(F.concat(F.lit(d.prefix), d.expr.cast("string")), d.values is None, d.share_of)))
    sums = write_table(tx.select(KEY, F.explode(F.array(*entries)).alias("e")).where("e is not null")
                       .groupBy(KEY, "e.l", "e.o", "e.t").agg(F.sum("e.v").alias("s")), "pivot-long")
    totals = sums.where(F.col("l").isin(TOTAL, GOOD_TOTAL)).select(KEY, F.col("l").alias("t"), F.col("s").cast("double").alias("total"))
    rest = sums.where(~F.col("l").isin(TOTAL, GOOD_TOTAL)).select(KEY, F.col("l").alias("feature"), "o", "t", F.col("s").cast("double").alias("s"))
    fixed = rest.where("not o").union(rest.where("o").join(labels.withColumnRenamed("label", "feature"), "feature", "left_semi").select(*rest.columns))
    shared = fixed.where("t is not null").join(totals, [KEY, "t"], "left").select(KEY, "feature", F.round(safe_div(F.col("s"), F.col("total")), 6).alias("x"))
    return fixed.where("t is null").select(KEY, "feature", F.col("s").alias("x")).union(shared).where("x is not null and x <> 0")


def shares_long(tx: DataFrame, col: str, value: str = "amount", keep: Column | None = None,
                total_of: Column | None = None) -> DataFrame:
    """(client, value of ``col``, share): the sum of ``value`` per client and value of an
    open-ended dimension (rows in ``keep``), over the client's total (rows in
    ``total_of``).  One row per pair that occurs, for any number of values."""
    v = F.col(value)
    total = tx.groupBy(KEY).agg(F.sum(v if total_of is None else F.when(total_of, v)).alias("_total"))
    part = (tx if keep is None else tx.where(keep)).where(F.col(col).isNotNull()).groupBy(KEY, col).agg(F.sum(v).alias("_sum"))
    share = F.round(safe_div(F.col("_sum").cast("double"), F.col("_total").cast("double")), 6)
    return part.join(total, KEY).select(KEY, col, F.coalesce(share, F.lit(0.0)).alias("share"))


def category_blocks(cat: str, values: list, value: str = "amount", stats=CAT_STATS) -> list:
    """Statistic blocks (see ``keyed_stats``), one per category value, each
    filtered to the category: conditional aggregation keyed by the client
    alone, so no (client, category) shuffle and no pivot step."""
    all_stats = tuple(stats) + (() if "count" in stats else ("count",))
    return [(value, all_stats, f"_c{i}_", F.col(cat) == F.lit(v)) for i, v in enumerate(values)]


def category_columns(values: list, value: str = "amount", stats=CAT_STATS, prefix: str = "trx_category") -> list:
    """Final category columns: inside a category the client has rows in,
    missing statistics are 0 (std of one row); a category without rows
    stays NULL."""
    out = []
    for i, v in enumerate(values):
        has = F.col(f"_c{i}_count") > 0
        for s in stats:
            out.append(F.when(has, F.coalesce(F.col(f"_c{i}_{s}"), F.lit(0))).alias(f"{prefix}{v}_{value}_{s}"))
    return out


def category_stats_pivot(tx: DataFrame, cat: str, values: list, value: str = "amount",
                         stats=CAT_STATS, prefix: str = "trx_category") -> DataFrame:
    """Ten statistics of ``value`` per client and category, one column set per
    category."""
    st = keyed_stats(tx, [KEY], category_blocks(cat, values, value, stats))
    return st.select(KEY, *category_columns(values, value, stats, prefix))


def relative_month_features(tx: DataFrame, cfg: FeatureConfig, flows: bool, value: str = "amount",
                            category: str = "category", mcc: str | None = GOOD_COL,
                            month_col: str = "months_before_last") -> DataFrame:
    return tx.groupBy(KEY).agg(*relative_month_aggs(cfg, flows, value, category, mcc, month_col))


def relative_month_aggs(cfg: FeatureConfig, flows: bool, value: str = "amount", category: str = "category",
                        mcc: str | None = GOOD_COL, month_col: str = "months_before_last") -> list:
    """Per relative month m (0 = client's last period month, -1, ...):

    * ``month_{m}``: POS good-MCC sum, ``month_state_{m}``: that sum >= threshold
    * with ``flows``: ``portion_in{m}`` = income sum / month total (1 when the
      client has no rows that month), ``portion_out{m}`` = POS good-MCC
      outflow sum (a plain sum, as in the reference).
    All in one filtered aggregate; missing values are 0.
    """
    v = F.col(value)
    pg = pos_good(cfg, category, mcc)
    income = F.col(category).isin(*cfg.income_categories)
    aggs = []
    for m in cfg.relative_months:
        in_m = F.col(month_col) == m
        if not flows:
            s = F.sum(F.when(in_m & pg, v)).cast("double")
            aggs += [F.coalesce(s, F.lit(0.0)).alias(f"month_{m}"),
                     F.coalesce((s >= cfg.month_state_threshold).cast("int"), F.lit(0)).alias(f"month_state_{m}")]
        else:
            in_sum = F.coalesce(F.sum(F.when(in_m & income, v)).cast("double"), F.lit(0.0))
            total = F.coalesce(F.sum(F.when(in_m, v)).cast("double"), F.lit(1.0))
            out_sum = F.coalesce(F.sum(F.when(in_m & ~income & pg, v)).cast("double"), F.lit(0.0))
            aggs += [F.coalesce(F.round(safe_div(in_sum, total), 6), F.lit(0.0)).alias(f"portion_in{m}"),
                     out_sum.alias(f"portion_out{m}")]
    return aggs


def scalar_features(tx: DataFrame, cfg: FeatureConfig, value: str = "amount", category: str = "category",
                    mcc: str = GOOD_COL, only: list[str] | None = None) -> DataFrame:
    return tx.groupBy(KEY).agg(*scalar_aggs(cfg, value, category, mcc, only))


def scalar_aggs(cfg: FeatureConfig, value: str = "amount", category: str = "category",
                mcc: str = GOOD_COL, only: list[str] | None = None) -> list:
    """Good-MCC share of POS spend, tenure holes, holiday spend (0-filled); those of ``only``."""
    v = F.col(value)
    pg = pos_good(cfg, category, mcc)
    n = float(cfg.max_day_number)
    good = F.sum(F.when(is_good(mcc), v)).cast("double")
    pos = F.sum(F.when(F.col(category) == cfg.pos_category, v)).cast("double")
    aggs = {
        "sum_POS": pos,
        "good_mcc_portion": F.round(safe_div(good, pos), 6),
        "days_hole_mean": F.round(F.avg(F.when(pg, F.col("day_diff").cast("double"))) / n, 6),
        "head_hole_size": F.round(F.min(F.when(pg, F.col("day_number"))) / n, 6),
        "tail_hole_size": F.round((n - F.max(F.when(pg, F.col("day_number")))) / n, 6),
        "holydays_amount_part": F.sum(F.when(F.col("is_holiday") == 1, v)).cast("double"),
    }
    return [F.coalesce(aggs[k], F.lit(0.0)).alias(k) for k in (only or aggs)]


def period_part_coverage(tx: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Share of tenure buckets used: distinct buckets / (horizon / N).  Bucket lengths that are powers of two come from
    the day bits; any others from the distinct buckets."""
    if countable(cfg.period_parts):
        return day_sets(tx, "day_number", cfg.period_parts, cfg.max_period_day).drop("len_days", "len_div_set_days")
    return tx.groupBy(KEY).agg(*[
        F.round(F.count_distinct(f"period_part_{n}") / (cfg.max_period_day / n), 6).alias(f"period_part{n}")
        for n in cfg.period_parts])
