"""The fitted card job as one transformer: a transaction log in, a score per client out.

Holds everything that was learned: the configuration, the value lists and the category codes fitted on the training
clients, the feature columns, and the boosted trees of both goals.  It is saved with ``write().save(path)`` and
read back with ``CardModel.load(path)`` in any later session.
"""

from __future__ import annotations

import json
from functools import partial

from pyspark.ml.base import Transformer
from pyspark.ml.util import MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.functions.config import FeatureConfig
from cardlens.operators import boost as B
from cardlens.operators import learn as L
from cardlens.operators.metrics import unlog_clip
from cardlens.plans import features as FT
from cardlens.session import at_once, write_table

KEY = FT.KEY


def vector(cols: list[str]):
    return F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("features")


class CardModel(Transformer, MLWritable, MLReadable):
    """``transform(log)`` gives (cl_id, flag_probability, spend) for each client of the log.  ``rates`` are the exchange
    rates of the log's days (None: amounts are in one currency)."""

    def __init__(self, cfg: FeatureConfig, lists: dict, columns: list[str], flag: B.Forest, spend: B.Forest, rates: DataFrame | None = None):
        super().__init__()
        self.cfg, self.lists, self.columns, self.flag, self.spend, self.rates = cfg, lists, columns, flag, spend, rates

    def with_rates(self, rates: DataFrame | None) -> CardModel:
        return CardModel(self.cfg, self.lists, self.columns, self.flag, self.spend, rates)

    def features(self, log: DataFrame) -> DataFrame:
        """The fitted columns for each client.  Values that the training clients did not have get no column."""
        prepared = write_table(FT.prepare_log(log, self.rates, self.cfg), "prepared-log")
        return FT.scored_features(prepared, self.cfg, self.lists).select(KEY, vector(self.columns))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = write_table(self.features(dataset), "features")
        flag = B.predict(self.flag, rows).select(KEY, F.col("prediction").alias("flag_probability"))
        spend = B.predict(self.spend, rows).select(F.col(KEY).alias("_key"), unlog_clip("prediction").alias("spend"))
        return flag.join(spend, F.col(KEY).eqNullSafe(F.col("_key"))).drop("_key")

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: CardModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m = self.model
        spark = m.flag.trees.sparkSession
        B.save(m.flag, f"{path}/flag")
        B.save(m.spend, f"{path}/spend")
        m.lists["category_codes"].write.mode("overwrite").parquet(f"{path}/category_codes")
        about = {"config": m.cfg.to_json(), "columns": m.columns, "lists": {k: list(v) for k, v in m.lists.items() if k != "category_codes"}}
        spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


class _Reader(MLReader):
    def load(self, path: str) -> CardModel:
        spark = SparkSession.active()
        about = json.loads(spark.read.text(f"{path}/about").first().value)
        lists = {**about["lists"], "category_codes": spark.read.parquet(f"{path}/category_codes")}
        return CardModel(FeatureConfig.from_json(about["config"]), lists, about["columns"], B.load(spark, f"{path}/flag")[0], B.load(spark, f"{path}/spend")[0])


def fit_card_model(log: DataFrame, rates: DataFrame | None, labels: DataFrame, cfg: FeatureConfig, trash_mcc=(),
                   flag: B.Settings | None = None, spend: B.Settings | None = None) -> CardModel:
    """Fit value lists on the labelled clients' rows and both models on the labelled clients; statistics over all
    clients (month cohorts) are those of the whole log."""
    prepared = write_table(FT.prepare_log(log, rates, cfg), "prepared-log")
    lists = FT.fit_lists(prepared.join(labels.select(KEY), KEY, "left_semi"), cfg, trash_mcc)
    table = write_table(FT.scored_features(prepared, cfg, lists).join(labels, KEY, "left"), "features")
    cols = L.feature_columns(table)

    def fitted(label, setting):
        return B.fit(B.bin_rows(L.labelled(table, label).select(KEY, "label", vector(cols)), len(cols), KEY), [setting], cols)
    forests = at_once(table.sparkSession, [partial(fitted, F.col("target_flag"), flag or B.classifier()),
                                           partial(fitted, F.log1p(F.col("target_sum").cast("double")), spend or B.regressor())])
    return CardModel(cfg, lists, cols, *forests, rates)
