"""Learning checks (SURVEY §5 (4)): a label derived from the features is
learnable, and a saved model scores the same after loading."""

from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from cardlens.operators import client_stats as cs
from cardlens.operators import learn as L
from cardlens.operators.metrics import roc_auc
from cardlens.session import scratch_path
from cardlens.sources import views as V

SF_MID = "/root/testdata/sf0.01"


def _table(spark):
    t = V.tx_e(spark, SF_MID)
    # every client counts as labelled here; the label is derived per test
    return cs.client_stats(t, "amount", ("sum", "mean", "max", "min", "count"), "amount_") \
        .withColumn("target_flag", F.lit(0))


def test_derived_label_is_learnable(spark):
    table = _table(spark)
    cols = L.feature_columns(table)
    med = table.approxQuantile("amount_sum", [0.5], 0.0)[0]
    data = L.assemble(L.labelled(table, (F.col("amount_sum") > med).cast("int")), cols)
    model = L.classifier(max_iter=10).fit(data)
    scored = L.probability_of_one(model.transform(data))
    auc = roc_auc(scored, "label", "probability_1").first().auc
    assert auc > 0.9


def test_save_load_same_scores(spark):
    table = _table(spark)
    cols = L.feature_columns(table)
    data = L.labelled(table, (F.col("amount_count") > 60).cast("int")).select(
        "cl_id", "label", *[F.col(c).cast("double").alias(c) for c in cols])
    pipe = Pipeline(stages=[L.assembler(cols), L.classifier(max_iter=5)]).fit(data)
    before = {r.cl_id: r.probability_1 for r in L.probability_of_one(pipe.transform(data)).collect()}
    loaded = L.load_model(L.save_model(pipe, scratch_path(spark, "model-test")))
    after = {r.cl_id: r.probability_1 for r in L.probability_of_one(loaded.transform(data)).collect()}
    assert before == after


def test_sizes_are_the_reference_s(spark):
    """Rounds, depths, weights and step of the two models; grid and folds of the search."""
    import inspect
    c, r = L.classifier(), L.regressor()
    assert (c.getMaxIter(), c.getMaxDepth(), c.getMinInstancesPerNode(), c.getStepSize()) == (300, 7, 4, 0.1)
    assert (r.getMaxIter(), r.getMaxDepth(), r.getMinInstancesPerNode(), r.getStepSize()) == (3000, 3, 3, 0.01)
    g = L.grid(c)
    assert {(p[c.maxDepth], p[c.minInstancesPerNode]) for p in g} == {(d, w) for d in range(2, 9) for w in range(1, 5)} and len(g) == 28
    assert inspect.signature(L.cross_validate).parameters["folds"].default == 4 and L.GRID_ROUNDS == 200
