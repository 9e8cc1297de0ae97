"""The flagship feature table and the learning queries.

Learning queries have no SQL oracle (model fitting); the driver checks their
row counts only.
"""

from __future__ import annotations

from dataclasses import replace
from functools import partial, reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardlens.functions.config import events_fixture
from cardlens.operators import boost as B
from cardlens.operators import learn as L
from cardlens.operators.metrics import roc_auc_by, unlog_clip
from cardlens.plans import card_model as CM
from cardlens.plans import features as FT
from cardlens.plans.card_model import vector
from cardlens.plans.catalog import query
from cardlens.plans.queries_pivots import trash_mcc_fixture
from cardlens.session import at_once, scratch_path, write_table
from cardlens.sources import ingest as I
from cardlens.sources import views as V


def feature_table(spark, sf):
    return FT.client_feature_table(V.tx_e(spark, sf), V.fx(spark, sf), V.cust_lbl(spark, sf), events_fixture(),
                                   trash_mcc_fixture())


@query("client_feature_table")
def q_client_feature_table(spark, sf):
    return feature_table(spark, sf)


def train_set(spark, sf, regression=False, seeds=(), folds=4):
    """The feature table, its feature columns, the training rows (cl_id, label, features, a fold column per seed) and the
    same binned, written once: trainers pass over them many times."""
    table = write_table(feature_table(spark, sf), "features")
    cols = L.feature_columns(table)
    label = F.log1p(F.col("target_sum").cast("double")) if regression else F.col("target_flag")
    data = L.labelled(table, label).select("cl_id", "label", vector(cols))
    data, names = B.with_folds(data, "cl_id", folds, seeds)
    return table, cols, data, B.bin_rows(data, len(cols), fold_columns=names), names


def unlabelled(table, cols):
    return table.filter(F.col("target_flag").isNull()).select("cl_id", vector(cols))


def probability(scored, *keep):
    return scored.select(*keep, F.col("prediction").alias("probability_1"), (F.col("prediction") > 0.5).cast("double").alias("prediction"))


def on_folds(setting, fold_of=0, folds=4):
    """The setting once per fold, each leaving its fold out."""
    return [replace(setting, fold_of=fold_of, fold=f) for f in range(folds)]


def held_metrics(forest, data, names, metric):
    """(model, metric) of every model on the rows that it left out: ``auc`` or ``mse``."""
    held = B.predict(forest, data, range(len(forest.models)), folds=names)
    if metric == "auc":
        return roc_auc_by(held, "model", "label", "prediction").withColumnRenamed("auc", "metric")
    return held.groupBy("model").agg(F.avg(F.pow(F.col("prediction") - F.col("label"), 2)).alias("metric"))


def with_groups(spark, metrics, rows, columns):
    """Metrics with what their models are: ``rows`` holds one tuple of ``columns`` per model."""
    about = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"model int, {columns}")
    return about.join(metrics, "model", "left").drop("model")


@query("assemble_features")
def q_assemble_features(spark, sf):
    table = feature_table(spark, sf)
    a = L.assemble(table)
    return a.select("cl_id", vector_to_array("features").alias("features"))


@query("assemble_features_sparse")
def q_assemble_features_sparse(spark, sf):
    """The same features from sparse vectors: one row per client and feature that is not 0 (missing is NaN)."""
    vectors, names = FT.client_vectors(V.tx_e(spark, sf), V.fx(spark, sf), V.cust_lbl(spark, sf), events_fixture(), trash_mcc_fixture())
    return (vectors.select("cl_id", F.posexplode(vector_to_array("features")).alias("idx", "x")).where("x <> 0")
            .join(names, "idx").select("cl_id", "feature", "x"))


@query("feature_index")
def q_feature_index(spark, sf):
    # only the names are asked for: the plan is built, not run
    table = FT.client_feature_table(V.tx_e(spark, sf), V.fx(spark, sf), V.cust_lbl(spark, sf), events_fixture(),
                                    trash_mcc_fixture(), materialize="none")
    cols = L.feature_columns(table)
    return spark.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in cols])).alias("idx", "feature"))


@query("train_classifier")
def q_train_classifier(spark, sf):
    _, cols, data, binned, _ = train_set(spark, sf)
    return probability(B.predict(B.fit(binned, [B.classifier()], cols), data), "cl_id", "label")


@query("train_regressor")
def q_train_regressor(spark, sf):
    _, cols, data, binned, _ = train_set(spark, sf, regression=True)
    return B.predict(B.fit(binned, [B.regressor()], cols), data).select("cl_id", "label", "prediction")


GRID_SEEDS = range(100, 108)
DEPTHS, WEIGHTS = range(2, 9), range(1, 5)


def grid_scores(spark, sf):
    """(seed, max_depth, min_child_weight, score): the regressor on the flag, 200 rounds, each seed with its own
    folds; the score is the folds' mean negative squared error."""
    _, cols, data, binned, names = train_set(spark, sf, seeds=GRID_SEEDS)
    points = [(s, i, d, w) for i, s in enumerate(GRID_SEEDS) for d in DEPTHS for w in WEIGHTS]
    models = [m for s, i, d, w in points for m in on_folds(
        B.regressor(rounds=200, depth=d, step=0.1, min_child_weight=float(w), seed=s), fold_of=i)]
    metrics = held_metrics(B.fit(binned, models, cols), data, names, "mse")
    about = [(s, d, w) for s, _, d, w in points for _ in range(4)]
    return (with_groups(spark, metrics, about, "seed int, max_depth int, min_child_weight int")
            .groupBy("seed", "max_depth", "min_child_weight").agg((-F.avg("metric")).alias("score")))


@query("grid_search")
def q_grid_search(spark, sf):
    return grid_scores(spark, sf)


@query("best_params")
def q_best_params(spark, sf):
    """The best point of each seed's grid (ties: the smaller depth, then weight)."""
    scores = grid_scores(spark, sf)
    best = scores.groupBy("seed").agg(F.max_by(F.struct("max_depth", "min_child_weight", "score"),
                                               F.struct("score", -F.col("max_depth"), -F.col("min_child_weight"))).alias("x"))
    value = lambda c: F.struct(F.lit(c).alias("param"), F.col(f"x.{c}").cast("string").alias("value"))
    return best.select("seed", F.explode(F.array(*[value(c) for c in ("max_depth", "min_child_weight", "score")])).alias("p")).select("seed", "p.*")


@query("cv_classifier")
def q_cv_classifier(spark, sf):
    """The full classifier, four folds, mean AUC."""
    _, cols, data, binned, names = train_set(spark, sf, seeds=(1,))
    metrics = held_metrics(B.fit(binned, on_folds(B.classifier()), cols), data, names, "auc")
    return metrics.agg(F.count(F.lit(1)).cast("int").alias("folds"), F.avg("metric").alias("avg_auc"))


@query("cv_regressor")
def q_cv_regressor(spark, sf):
    """The full regressor on the log target, four folds: mean squared error and its root."""
    _, cols, data, binned, names = train_set(spark, sf, regression=True, seeds=(1,))
    metrics = held_metrics(B.fit(binned, on_folds(B.regressor()), cols), data, names, "mse")
    return metrics.agg(F.count(F.lit(1)).cast("int").alias("folds"), F.avg("metric").alias("avg_mse"), F.sqrt(F.avg("metric")).alias("rmse"))


@query("cv_repeated")
def q_cv_repeated(spark, sf):
    """The plain regressor on the flag over seven foldings: AUC of each and the mean of all."""
    seeds = range(7)
    _, cols, data, binned, names = train_set(spark, sf, seeds=seeds)
    models = [m for i in seeds for m in on_folds(B.plain(logistic=False), fold_of=i)]
    metrics = held_metrics(B.fit(binned, models, cols), data, names, "auc")
    each = with_groups(spark, metrics, [(s,) for s in seeds for _ in range(4)], "seed int").groupBy("seed").agg(F.avg("metric").alias("avg_auc"))
    mean = each.agg(F.avg("avg_auc")).scalar()
    return each.withColumn("mean_auc", mean)


@query("score_clients")
def q_score_clients(spark, sf):
    table, cols, _, binned, _ = train_set(spark, sf)
    return probability(B.predict(B.fit(binned, [B.classifier()], cols), unlabelled(table, cols)), "cl_id")


@query("score_spend")
def q_score_spend(spark, sf):
    """Second goal: spend of the unlabelled clients by the regressor on the log target,
    turned back (exp(p) - 1, not below 0), written as predictions and read back."""
    table, cols, _, binned, _ = train_set(spark, sf, regression=True)
    scored = B.predict(B.fit(binned, [B.regressor()], cols), unlabelled(table, cols))
    spend = scored.select("cl_id", unlog_clip("prediction").alias("spend"))
    return I.read_predictions(spark, I.write_predictions(spend, scratch_path(spark, "spend"), value_col="spend"))


@query("early_stopping")
def q_early_stopping(spark, sf):
    """Held-out loss of the classifier by round on one fold, stopped 30 rounds after its best one."""
    _, cols, _, binned, _ = train_set(spark, sf, seeds=(1,))
    forest = B.fit(binned, [replace(m, patience=30) for m in on_folds(B.classifier())], cols)
    best = spark.createDataFrame(list(enumerate(forest.best_round)), "fold int, best_round int")
    loss = B.held_out_loss(forest).withColumnRenamed("model", "fold")
    return loss.join(best, "fold").withColumn("is_best", F.col("round") + 1 == F.col("best_round"))


@query("feature_importance")
def q_feature_importance(spark, sf):
    _, cols, _, binned, _ = train_set(spark, sf)
    return B.importances(B.fit(binned, [B.classifier()], cols))


@query("select_features")
def q_select_features(spark, sf):
    """The feature table without the columns that the classifier never splits on."""
    table, cols, _, binned, _ = train_set(spark, sf)
    used = {r.feature for r in B.importances(B.fit(binned, [B.classifier()], cols)).where("importance > 0").collect()}
    return table.select("cl_id", *[c for c in cols if c in used])


@query("model_save_load")
def q_model_save_load(spark, sf):
    """Fit on the labelled clients' log, save, load, and score the log of the other clients, which the fit has not seen."""
    log, labels, rates = V.tx_e(spark, sf), V.cust_lbl(spark, sf), V.fx(spark, sf)
    seen = log.join(labels.select("cl_id"), "cl_id", "left_semi")
    unseen = log.join(labels.select("cl_id"), "cl_id", "left_anti")
    path = scratch_path(spark, "card-model")
    CM.fit_card_model(seen, rates, labels, events_fixture(), trash_mcc_fixture()).write().save(path)
    return CM.CardModel.load(path).with_rates(rates).transform(unseen)


@query("end_to_end")
def q_end_to_end(spark, sf):
    """Card-log CSV files -> parse -> convert -> features -> train both models -> score the unlabelled
    clients -> one prediction CSV per goal -> read back."""
    from cardlens.plans.queries_io import card_log_files
    train_p, test_p = card_log_files(spark, sf)
    train = I.parse_transactions(I.read_transactions_csv(spark, train_p, labelled=True))
    test = I.parse_transactions(I.read_transactions_csv(spark, test_p, labelled=False))
    labels = train.groupBy("cl_id").agg(F.max("target_flag").alias("target_flag"),
                                        F.max("target_sum").alias("target_sum"))
    rows = train.drop("target_flag", "target_sum").unionByName(test)
    rows = rows.withColumn("tx_id", F.xxhash64(*rows.columns))
    table = write_table(FT.client_feature_table(rows, V.fx(spark, sf), labels, events_fixture(), trash_mcc_fixture()), "features")
    cols = L.feature_columns(table)
    goals = [("flag", B.classifier(), F.col("target_flag"), F.col("prediction")),
             ("spend", B.regressor(), F.log1p(F.col("target_sum").cast("double")), unlog_clip("prediction"))]

    def submission(goal, setting, label, value):
        forest = B.fit(B.bin_rows(L.labelled(table, label).select("cl_id", "label", vector(cols)), len(cols)), [setting], cols)
        scored = B.predict(forest, unlabelled(table, cols)).select("cl_id", value.alias("value"))
        path = I.write_predictions(scored, scratch_path(spark, "submission"), value_col="value")
        return I.read_predictions(spark, path).withColumn("goal", F.lit(goal))
    return reduce(lambda a, b: a.unionByName(b), at_once(spark, [partial(submission, *g) for g in goals]))
