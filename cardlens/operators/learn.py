"""Encoding, boosted trees, cross-validation and scoring on MLlib.

The reference trains gradient-boosted trees on the client table; here the
same roles are played by MLlib's distributed GBT estimators, tuned with
``ParamGridBuilder`` and ``CrossValidator`` (folds from a deterministic hash
of the client id, so a re-run or a lost executor gives the same folds).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.operators.metrics import hash_folds

KEY = "cl_id"
NON_FEATURES = {KEY, "target_flag", "target_sum", "label", "fold"}


def feature_columns(table: DataFrame) -> list[str]:
    """Numeric columns of a client table that are features."""
    num = {"int", "bigint", "double", "float", "smallint", "tinyint"}
    return [c for c, t in table.dtypes if c not in NON_FEATURES and (t in num or t.startswith("decimal"))]


def assembler(cols: list[str], out: str = "features") -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep")


def assemble(table: DataFrame, cols: list[str] | None = None, out: str = "features") -> DataFrame:
    cols = cols or feature_columns(table)
    cast = table.select(*[F.col(c) for c in table.columns if c not in cols],
                        *[F.col(c).cast("double").alias(c) for c in cols])
    return assembler(cols, out).transform(cast)


def encoder_stages(cols: list[str]) -> list:
    """Frequency-ordered index (invalid rows skipped) then one-hot with the
    last (least frequent) category dropped, per column."""
    stages = []
    for c in cols:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}_index", handleInvalid="skip",
                                    stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCol=f"{c}_index", outputCol=f"{c}_vec", dropLast=True))
    return stages


def fit_encoder(union: DataFrame, cols: list[str]) -> PipelineModel:
    """Fit the encoders once on train and test together."""
    return Pipeline(stages=encoder_stages(cols)).fit(union)


#: rounds of the reference's grid search (200) and of its plain cross-validation (the library's 100)
GRID_ROUNDS, CV_ROUNDS = 200, 100


def classifier(max_iter: int = 300, max_depth: int = 7, step: float = 0.1, subsample: float = 0.9,
               min_instances: int = 4, seed: int = 101) -> GBTClassifier:
    return GBTClassifier(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth,
                         stepSize=step, subsamplingRate=subsample, minInstancesPerNode=min_instances, seed=seed)


def regressor(max_iter: int = 3000, max_depth: int = 3, step: float = 0.01, subsample: float = 0.9,
              min_instances: int = 3, seed: int = 101) -> GBTRegressor:
    return GBTRegressor(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth,
                        stepSize=step, subsamplingRate=subsample, minInstancesPerNode=min_instances, seed=seed)


def labelled(table: DataFrame, label_expr) -> DataFrame:
    return table.filter(F.col("target_flag").isNotNull()).withColumn("label", label_expr.cast("double"))


def auc_evaluator() -> BinaryClassificationEvaluator:
    """Area under ROC on the probability column (not the hard prediction)."""
    return BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="rawPrediction", metricName="areaUnderROC")


def rmse_evaluator() -> RegressionEvaluator:
    return RegressionEvaluator(labelCol="label", predictionCol="prediction", metricName="rmse")


def cross_validate(data: DataFrame, estimator, evaluator, grid, folds: int = 4, seed: int = 0,
                   parallelism: int = 2) -> tuple:
    """k-fold CV with hash folds on the client id; returns the fitted
    CrossValidatorModel and the average metric per grid point."""
    d = hash_folds(data, KEY, folds, seed)
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=evaluator, foldCol="fold", numFolds=folds,
                        parallelism=parallelism, seed=seed)
    model = cv.fit(d)
    return model, list(model.avgMetrics)


def probability_of_one(pred: DataFrame, out: str = "probability_1") -> DataFrame:
    return pred.withColumn(out, vector_to_array("probability")[1])


def importances(spark: SparkSession, model, cols: list[str]) -> DataFrame:
    """Feature importances by name (one row per feature)."""
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(i, c, float(v)) for i, (c, v) in enumerate(zip(cols, imp))],
                                 "idx int, feature string, importance double")


def save_model(model: PipelineModel, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def grid(estimator, depths=range(2, 9), min_instances=range(1, 5)):
    return (ParamGridBuilder().addGrid(estimator.maxDepth, list(depths))
            .addGrid(estimator.minInstancesPerNode, list(min_instances)).build())
