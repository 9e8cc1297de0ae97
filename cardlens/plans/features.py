"""The wide per-client feature table: clean -> convert -> calendar -> aggregate.

``prepare_log``      the loader: currency conversion (as-of join), round-number
                     flags (after conversion, before the sign flip), signed
                     amount, calendar and tenure columns, day_diff.
``client_frame``     per-client statistics over all rows (train and test).
``build_features``   pivots, shares, tenure holes, relative months, with
                     value lists fitted on the training clients only.
``client_feature_table`` joins both on ``cl_id`` and adds the labels.

Every block is a partial aggregate keyed by ``cl_id``; the blocks are joined
on ``cl_id``, so their outputs share one hash partitioning.  The prepared log
is written once as a parquet table in the shared checkpoint folder, because a
dozen aggregates read it: the lineage is cut (a lost executor re-reads files),
and every aggregate scans only the columns it needs.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.functions import calendar as cal
from cardlens.functions.config import FeatureConfig
from cardlens.operators import client_stats as cs
from cardlens.operators.holistic import keyed_stats
from cardlens.operators.sequence import with_previous
from cardlens.operators import pivots as P
from cardlens.operators import recency as R
from cardlens.operators.asof import convert_with_tolerance
from cardlens.operators.dictionary import code_table, fit_values, with_code, with_membership
from cardlens.operators.encoding import long_vectors, unpivot
from cardlens.operators.learn import feature_columns
from cardlens.operators.tenure import enrich
from cardlens.session import write_table

KEY = "cl_id"
AMOUNT_STATS = ("sum", "mean", "std", "median", "max", "min", "mode_count", "mode", "mean_div_std")
RATIO_STATS = ("sum", "mean", "std", "median", "max", "min")


def prepare_log(tx: DataFrame, rates: DataFrame | None, cfg: FeatureConfig) -> DataFrame:
    """Row-level loader.  ``amount`` becomes the converted, signed amount."""
    t = tx
    if rates is not None:
        t = convert_with_tolerance(t, rates).withColumn("amount", F.col("amount_rub")).drop("amount_rub")
    e = enrich(t, cfg)
    return e.withColumn("amount", F.col("signed_amount")).drop("signed_amount")


def client_frame(log: DataFrame, cfg: FeatureConfig, categories: list) -> DataFrame:
    """Per-client statistics (the notebook's first feature block)."""
    # Row pass: previous-transaction gap and the client's last transaction
    # time from one bucketed lookup, then the recency flags.
    rounds = [f"ostatok_{d}" for d in cfg.round_divisors]
    rows = with_previous(log.select(KEY, "ts", "tx_id", "amount", "category", "month", "channel_code", *rounds),
                         [KEY], "ts", "tx_id", out="_prev", last_out="last_action")
    rows = rows.withColumns({"_gap": cs.gap_column("_prev", "ts"), **R.recency_flags(cfg.recency_days)})

    # One client aggregate and one shared histogram pass for every block:
    # whole-history statistics, gaps, recency windows and categories.
    gap_aggs, gap_blocks = cs.gap_blocks("diff_TRDATETIME_")
    extra = [F.count("amount").alias("num_deals"), F.sum("amount").cast("double").alias("sum_deals"),
             F.min("ts").alias("_mn_ts"), F.max("ts").alias("_mx_ts"), *gap_aggs]
    blocks = [("channel_code", ("mode",), "channel_code_", None),
              ("month", ("median", "max", "min", "mode", "mode_count"), "month_", None),
              ("amount", AMOUNT_STATS, "amount_", None)]
    blocks += [(r, ("mean", "std", "median", "max", "min", "mean_div_std"), f"{r}_", None) for r in rounds]
    blocks += gap_blocks + R.recency_blocks(cfg.recency_days)
    blocks += P.category_blocks("category", categories, "amount")
    main = keyed_stats(rows, [KEY], blocks, extra_aggs=extra)
    keep = [c for c in main.columns if not c.startswith("_c")]
    main = main.select(*keep, *P.category_columns(categories, "amount"))
    main = main.withColumns({
        "num_days_in_use": F.expr("timestampdiff(DAY, _mn_ts, _mx_ts)").cast("int"),
        "max_TRDATETIME": cal.base_month_index("_mx_ts", cfg.base_year),
        "min_TRDATETIME": cal.base_month_index("_mn_ts", cfg.base_year)}).drop("_mn_ts", "_mx_ts")
    main = main.withColumn("delta_month", F.col("max_TRDATETIME") - F.col("min_TRDATETIME"))

    out = main.join(cs.client_active_days(log), KEY, "left")

    # month cohorts by card period, role-played on the first and last month
    per_month = log.withColumn("_pm", cal.base_month_index("period", cfg.base_year))
    cohort = cs.month_cohort(per_month, "_pm").withColumnRenamed("_pm", "month")
    out = cs.attach_by_month(out, cohort, "max_TRDATETIME", "max_month_")
    out = cs.attach_by_month(out, cohort, "min_TRDATETIME", "min_month_")
    mstats = cs.month_amount_stats(log, "amount", "month")
    out = cs.attach_by_month(out, mstats, "month_min", "min_")
    out = cs.attach_by_month(out, mstats, "month_max", "max_")

    whole = {s: f"amount_{s}" for s in RATIO_STATS}
    out = R.recency_ratios(out, cfg.recency_days, RATIO_STATS, whole)
    out = R.recency_ratios(out, cfg.recency_days, ("count",), {"count": "num_deals"})
    return out


def fit_lists(train_log: DataFrame, cfg: FeatureConfig, trash_mcc=()) -> dict:
    """Value lists of the wide columns, learnt from training rows only."""
    mccs = train_log.select("mcc").filter(F.col("mcc").isNotNull()).distinct()
    mccs = with_membership(with_membership(mccs, "mcc", cfg.bad_mcc, "_bad"), "mcc", trash_mcc, "_trash")
    return {
        "categories": fit_values(train_log, "category"),
        "category_codes": write_table(code_table(train_log, "category"), "codes"),
        "years": fit_values(train_log, "year"),
        "mcc": fit_values(mccs.filter(~F.col("_bad") & ~F.col("_trash")), "mcc"),
    }


def pivot_dims(cfg: FeatureConfig, years, cat_codes, mccs) -> list[P.PivotDim]:
    """The pivot families; None instead of a list leaves a family's values to a label table."""
    pg = P.pos_good(cfg)
    pos = F.col("category") == cfg.pos_category
    return [
        P.PivotDim("year_", F.col("year"), years, pg),
        P.PivotDim("year_month_", F.col("month"), tuple(range(1, 13)), pg),
        P.PivotDim("month_day_", F.col("day"), tuple(range(1, 32)), pg),
        P.PivotDim("day_part_", F.col("day_part"), (0, 1, 2), pg, P.TOTAL),
        P.PivotDim("hour_", F.col("tr_hour"), tuple(range(24)), pg, P.TOTAL),
        P.PivotDim("cat_", F.col("cat_index"), cat_codes, None, P.TOTAL),
        P.PivotDim("cur_", F.col("currency"), tuple(cfg.currencies)),
        P.PivotDim("week_day_", F.col("week_day"), tuple(cfg.weekdays)),
        P.PivotDim("day_", F.col("day_number"), tuple(range(cfg.max_day_number)), pos),
        P.PivotDim("sum_", F.col("mcc"), mccs, None, P.GOOD_TOTAL),
        P.PivotDim("quartel_", F.col("quartel"), (0, 1, 2, 3)),
        P.PivotDim("week_", F.col("week_number"), tuple(range(cfg.max_day_number // 7)), pg),
    ]


def scalar_features(t: DataFrame, cfg: FeatureConfig) -> DataFrame:
    """Scalar shares, tenure holes, both relative-month families and tenure coverage."""
    scal = t.groupBy(KEY).agg(*P.scalar_aggs(cfg), *P.relative_month_aggs(cfg, flows=False),
                              *P.relative_month_aggs(cfg, flows=True))
    cover = P.period_part_coverage(t, cfg)
    return scal.join(cover, KEY, "left").fillna(0)


def build_features(log: DataFrame, cfg: FeatureConfig, lists: dict) -> DataFrame:
    """Pivots, shares and tenure features (the notebook's second block), 0-filled."""
    t = with_code(log, "category", "cat_index", lists["category_codes"])
    dims = pivot_dims(cfg, tuple(lists["years"]), tuple(range(len(lists["categories"]))), tuple(lists["mcc"]))
    wide = P.pivot_sums(t, dims, "amount")
    return scalar_features(t, cfg).join(wide, KEY, "left").fillna(0)


def client_vectors(tx: DataFrame, rates: DataFrame | None, labels: DataFrame, cfg: FeatureConfig, trash_mcc=()) -> tuple[DataFrame, DataFrame]:
    """(vectors, names): one sparse vector of all features per client, and (idx, feature).

    Holds what ``client_feature_table`` holds, but the pivot families go from long sums to the vector without
    becoming columns, and their open-ended values (years, categories, codes) stay in a written table.  A missing value is NaN; 0 takes no place."""
    log = write_table(prepare_log(tx, rates, cfg), "prepared-log")
    train_log = log.join(labels.select(KEY), KEY, "left_semi")
    codes = write_table(code_table(train_log, "category"), "codes")
    t = with_code(log, "category", "cat_index", codes)
    dims = pivot_dims(cfg, None, None, None)
    train = with_membership(with_membership(with_code(train_log, "category", "cat_index", codes), "mcc", cfg.bad_mcc, "_bad"), "mcc", trash_mcc, "_trash")
    known = train.withColumns({"mcc": F.when(~F.col("_bad") & ~F.col("_trash"), F.col("mcc")),
                               "cat_index": F.when(F.col("cat_index") >= 0, F.col("cat_index"))})
    found = write_table(P.open_labels(known, dims), "labels")
    scal = scalar_features(t, cfg)
    frame = client_frame(log, cfg, fit_values(train_log, "category"))
    long = (P.pivot_long(t, dims, found)
            .union(unpivot(scal, [c for c in scal.columns if c != KEY]).where("x <> 0"))
            .union(unpivot(frame, feature_columns(frame)).select(KEY, "feature", F.coalesce("x", F.lit(float("nan"))).alias("x"))))
    return long_vectors(long, log.select(KEY))


def scored_features(log: DataFrame, cfg: FeatureConfig, lists: dict) -> DataFrame:
    """Both feature blocks of a prepared log by fitted value lists."""
    return cs.wide_join(build_features(log, cfg, lists), client_frame(log, cfg, lists["categories"]))


def client_feature_table(tx: DataFrame, rates: DataFrame | None, labels: DataFrame, cfg: FeatureConfig,
                         trash_mcc=(), materialize: str = "table") -> DataFrame:
    """Both feature blocks joined on the client, with labels (NULL for the
    unlabelled test clients).

    ``materialize``: "table" writes the prepared log as parquet under the
    shared checkpoint folder and reads it back (lineage cut; each aggregate
    scans only its columns); "persist" keeps it in executor memory/disk;
    "none" recomputes it per aggregate.
    """
    log = prepare_log(tx, rates, cfg)
    if materialize == "table":
        log = write_table(log, "prepared-log")
    elif materialize == "persist":
        log = log.persist(StorageLevel.MEMORY_AND_DISK)
    train_log = log.join(labels.select(KEY), KEY, "left_semi")
    return scored_features(log, cfg, fit_lists(train_log, cfg, trash_mcc)).join(labels, KEY, "left")
