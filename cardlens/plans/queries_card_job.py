"""The card job: seven encoded columns, one collapsed vector per client, train and score.

Rows are those within the tenure cut, with the merchant category of their code.  The
vector is the amount-weighted one-hots of week and period, the amount-share one-hots of
weekday, currency, merchant category and transaction category, the one-hot channel
of the client's first row, and the client's total amount.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardlens.functions import calendar as cal
from cardlens.functions.config import events_fixture
from cardlens.operators import asof as A
from cardlens.operators import boost as B
from cardlens.operators import encoding as E
from cardlens.operators import learn as L
from cardlens.operators import onehot as OH
from cardlens.operators import tenure as T
from cardlens.operators.dictionary import code_table, with_code
from cardlens.operators.metrics import roc_auc_by
from cardlens.operators.sequence import first_by
from cardlens.plans.catalog import query
from cardlens.plans.queries_learn import on_folds, probability, unlabelled, vector, with_groups
from cardlens.session import write_table
from cardlens.sources import views as V

KEY = "cl_id"
ENCODED = ["transaction_week", "period_number", "mcc_category", "iso_weekday", "channel", "currency", "category"]
SUMS = [("tw_", "transaction_week"), ("pn_", "period_number")]
SHARES = [("wd_", "iso_weekday"), ("cur_", "currency"), ("mc_", "mcc_category"), ("cat_", "category")]


def card_rows(spark, sf):
    t = T.tenure_cut(V.tx_e(spark, sf), events_fixture().max_transaction_day)
    return (A.lookup(t, V.mcc_dim(spark, sf), "mcc").withColumn("iso_weekday", cal.iso_weekday_or_zero("ts"))
            .withColumn("channel", F.coalesce("channel_type", F.lit("none"))))


def _encoded(encoder, rows, *extra):
    return encoder.transform(rows).select(KEY, "tx_id", *extra, *[f"{c}_vec" for c in ENCODED])


@query("one_hot")
def q_one_hot(spark, sf):
    rows = card_rows(spark, sf)
    return _encoded(E.fit_encoder(rows, ENCODED), rows)


@query("encode_pipeline")
def q_encode_pipeline(spark, sf):
    """Encoders fitted on train and test together, applied to each."""
    rows, labels = card_rows(spark, sf), V.cust_lbl(spark, sf).select(KEY)
    train, test = rows.join(labels, KEY, "left_semi"), rows.join(labels, KEY, "left_anti")
    encoder = E.fit_encoder(train.unionByName(test), ENCODED)
    return _encoded(encoder, train, F.lit("train").alias("part")).unionByName(_encoded(encoder, test, F.lit("test").alias("part")))


def card_vector(rows):
    """One row per client: the collapsed columns, the first row's channel and the total."""
    rows = write_table(rows, "card-rows")
    codes = write_table(code_table(rows, "channel", by_frequency=True), "codes")
    n = codes.count() - 1                       # the least frequent channel has no column
    first = with_code(first_by(rows, [KEY], "channel", ["ts", "tx_id"], "channel"), "channel", "channel_index", codes)
    first = first.select(KEY, *[(F.col("channel_index") == i).cast("double").alias(f"ch_{i}") for i in range(n)])
    total = rows.groupBy(KEY).agg(F.sum("amount").cast("double").alias("total_amount"))
    return OH.onehot_collapse_mixed(rows, SUMS + SHARES, [p for p, _ in SHARES]).join(first, KEY).join(total, KEY)


@query("card_vector")
def q_card_vector(spark, sf):
    return card_vector(card_rows(spark, sf))


def job_table(spark, sf):
    """(client vectors with labels, written; their columns; the labelled clients' rows)"""
    table = write_table(card_vector(card_rows(spark, sf)).join(V.cust_lbl(spark, sf), KEY, "left"), "card-vector")
    cols = L.feature_columns(table)
    return table, cols, L.labelled(table, F.col("target_flag")).select(KEY, "label", vector(cols))


@query("card_job_score")
def q_card_job_score(spark, sf):
    """Train on the labelled clients' vectors, score the others."""
    table, cols, data = job_table(spark, sf)
    forest = B.fit(B.bin_rows(data, len(cols), KEY), [B.classifier()], cols)
    return probability(B.predict(forest, unlabelled(table, cols)), KEY)


@query("card_vector_sparse")
def q_card_vector_sparse(spark, sf):
    """The collapsed columns of ``card_vector`` from sparse vectors: one row per client and feature that is not 0."""
    vectors, names = E.onehot_vectors(card_rows(spark, sf), SUMS + SHARES, share=[p for p, _ in SHARES])
    return (vectors.select(KEY, F.posexplode(vector_to_array("features")).alias("idx", "x")).where("x <> 0")
            .join(names, "idx").select(KEY, "feature", F.col("value").alias("label"), "x"))


@query("card_job_grid")
def q_card_job_grid(spark, sf):
    """The job's search over the minimum child weight: ten folds, 2000 rounds on two bins a feature; area
    under ROC of the hard prediction."""
    weights, folds = (1.0, 3.0), 10
    _, cols, data = job_table(spark, sf)
    data, names = B.with_folds(data, KEY, folds, (0,))
    binned = B.bin_rows(data, len(cols), KEY, max_bins=2, fold_columns=names)
    point = B.Settings(rounds=2000, depth=3, step=0.001, gamma=0.0, alpha=0.6, reg_lambda=0.8, subsample=0.5, colsample=1.0, seed=0)
    models = [m for w in weights for m in on_folds(replace(point, min_child_weight=w), folds=folds)]
    held = B.predict(B.fit(binned, models, cols), data, range(len(models)), folds=names)
    metrics = roc_auc_by(held.withColumn("hard", (F.col("prediction") > 0.5).cast("int")), "model", "label", "hard").withColumnRenamed("auc", "metric")
    return (with_groups(spark, metrics, [(w,) for w in weights for _ in range(folds)], "min_child_weight double")
            .groupBy("min_child_weight").agg(F.avg("metric").alias("avg_auc")))
