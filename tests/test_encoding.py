"""Written encoders, sparse vectors, and the saved card model."""

import math

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from cardlens.functions.config import DivisibleBy, FeatureConfig, events_fixture
from cardlens.operators import boost as B
from cardlens.operators import encoding as E
from cardlens.operators import learn as L
from cardlens.plans import card_model as CM
from cardlens.plans import features as FT
from cardlens.plans import queries_learn as Q
from cardlens.plans.queries_pivots import trash_mcc_fixture
from cardlens.session import scratch_path
from cardlens.sources import views as V

from .conftest import SF_SMALL


def test_encoder_equals_mllib(spark):
    rows = [(i, c, k) for i, (c, k) in enumerate([("a", 1), ("b", 2), ("a", 2), (None, 1), ("c", None), ("b", 10), ("a", 10), ("d", 10)])]
    df = spark.createDataFrame(rows, "id int, c string, k int")
    mine = E.fit_encoder(df, ["c", "k"]).transform(df)
    theirs = L.fit_encoder(df, ["c", "k"]).transform(df)
    want = {r.id: (r.c, r.k) for r in theirs.select("id", vector_to_array("c_vec").alias("c"), vector_to_array("k_vec").alias("k")).collect()}
    assert {r.id: (r.c_vec, r.k_vec) for r in mine.collect()} == want and len(want) == 6


def test_encoder_saved_and_unseen(spark):
    df = spark.createDataFrame([(1, "x", "only"), (2, "y", "only"), (3, "x", "only")], "id int, c string, one string")
    enc = E.Encoder.load(spark, E.fit_encoder(df, ["c", "one"]).save(scratch_path(spark, "encoder")))
    new = spark.createDataFrame([(7, "y", "only"), (8, "z", "only"), (9, None, "only"), (10, "x", "only")], "id int, c string, one string")
    assert {r.id: (r.c_vec, r.one_vec) for r in enc.transform(new).collect()} == {7: ([0.0], []), 10: ([1.0], [])}
    assert E.fit_encoder(df.limit(0), ["c"]).transform(df).count() == 0


def test_hundred_thousand_codes(spark):
    """A plan of constant size, and no label list on the driver."""
    rows = spark.range(200_000).select((F.col("id") % 50).alias("cl_id"), (F.col("id") % 100_000).cast("string").alias("code"),
                                       (F.col("id") % 7 + 1).cast("double").alias("amount"))
    vectors, names = E.onehot_vectors(rows, [("c_", "code"), ("k_", "cl_id")], share=["k_"])
    assert len(vectors._jdf.queryExecution().optimizedPlan().toString()) < 5000
    got = vectors.collect()
    assert len(got) == 50 and all(v.features.size == 99_999 + 49 for v in got)
    total = rows.agg(F.sum("amount")).first()[0]
    last = names.where("feature like 'c_%'").join(rows.select("code").distinct(), F.col("value") == F.col("code"), "right_outer")
    left_out = last.where("value is null").select("code").first().code
    expected = total - rows.where(F.col("code") == left_out).agg(F.sum("amount")).first()[0]
    assert sum(x for v in got for i, x in zip(v.features.indices, v.features.values) if i < 99_999) == pytest.approx(expected)
    assert names.count() == 99_999 + 49
    one = {int(i): x for v in got if v.cl_id == 3 for i, x in zip(v.features.indices, v.features.values)}
    at = {r.value: r.idx for r in names.where("feature like 'k_%'").collect()}
    assert "3" not in at or one[at["3"]] == 1.0


def test_sparse_vectors_edges(spark):
    long = spark.createDataFrame([(1, 2, 5.0), (1, 0, -1.0), (1, 1, 0.0), (2, 1, None), (None, 3, 2.0)], "cl_id long, idx int, x double")
    keys = spark.createDataFrame([(1,), (2,), (3,), (3,)], "cl_id long")
    out = {r.cl_id: r.features.toArray().tolist() for r in E.sparse_vectors(long, keys, 4).collect()}
    assert out == {1: [-1.0, 0.0, 5.0, 0.0], 2: [0.0] * 4, 3: [0.0] * 4}
    assert E.onehot_vectors(spark.createDataFrame([], "cl_id long, c string, amount double"), [("c_", "c")])[0].count() == 0


def test_sparse_features_equal_the_wide_table(spark):
    wide = Q.feature_table(spark, SF_SMALL)
    cols = L.feature_columns(wide)
    want = {(r.cl_id, c): (None if v is None or (isinstance(v, float) and math.isnan(v)) else float(v))
            for r in wide.collect() for c in cols for v in [r[c]] if v is None or v != 0}
    vectors, names = FT.client_vectors(V.tx_e(spark, SF_SMALL), V.fx(spark, SF_SMALL), V.cust_lbl(spark, SF_SMALL), events_fixture(), trash_mcc_fixture())
    name = {r.idx: r.feature for r in names.collect()}
    got = {(r.cl_id, name[int(i)]): (None if math.isnan(x) else x) for r in vectors.collect() for i, x in zip(r.features.indices, r.features.values)}
    assert set(got) == set(want)
    assert all(got[k] is None and want[k] is None or got[k] == pytest.approx(want[k], rel=1e-9) for k in want)


def test_config_round_trip():
    for cfg in (FeatureConfig(), events_fixture()):
        assert FeatureConfig.from_json(cfg.to_json()) == cfg
    with pytest.raises(ValueError):
        FeatureConfig(bad_mcc=lambda c: c == 1).to_json()
    assert DivisibleBy((2, 3))(4) is True


def test_saved_model_scores_an_unseen_log(spark):
    log, labels, rates = V.tx_e(spark, SF_SMALL), V.cust_lbl(spark, SF_SMALL), V.fx(spark, SF_SMALL)
    seen = log.join(labels.select("cl_id"), "cl_id", "left_semi")
    model = CM.fit_card_model(seen, rates, labels, events_fixture(), trash_mcc_fixture(), B.classifier(rounds=4, min_child_weight=0.5, alpha=0.0),
                              B.regressor(rounds=4, step=0.3))
    path = scratch_path(spark, "card-model")
    model.write().save(path)
    loaded = CM.CardModel.load(path).with_rates(rates)
    # a code and a category that the fit has not seen
    unseen = log.join(labels.select("cl_id"), "cl_id", "left_anti").withColumn("mcc", F.when(F.col("tx_id") % 3 == 0, 9999).otherwise(F.col("mcc"))) \
        .withColumn("category", F.when(F.col("tx_id") % 5 == 0, "new").otherwise(F.col("category")))
    a, b = model.transform(unseen), loaded.transform(unseen)
    assert sorted(a.collect()) == sorted(b.collect()) and b.columns == ["cl_id", "flag_probability", "spend"]
    assert b.count() == unseen.select("cl_id").distinct().count() and loaded.columns == model.columns
    assert not any("9999" in c or "new" in c for c in loaded.columns)
