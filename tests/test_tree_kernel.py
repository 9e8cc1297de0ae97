"""The JVM kernel against its plain form, models that share their trees, scoring by many models."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlens.operators import boost as B
from tests.test_boost import _arrays, binned, rows, trees_of


def plain_trees(b, models):
    """Tree rows of ``Local``, which sums node by node with numpy."""
    local, out = B.Local(*_arrays(b), b.sizes, b.missing, b.scale), []
    for i, m in enumerate(models):
        trees, _, loss = local.fit(m)
        out += [r for k, t in enumerate(trees) for r in B.tree_rows(i, k, t, b.cuts)]
        out += [(i, k, B.LOSS, B.LOSS, 0, x / b.scale, False, -1, 0.0, 0.0) for k, x in enumerate(loss)]
    return sorted(out, key=lambda r: r[:3])


def odd_rows():
    """Features alike, constant, of few bins, of missing values only, and one of 0 and missing."""
    return [(i, y, [*x, x[0], 1.0, float(i % 2), float(i % 3) if i % 5 else None, None, 0.0 if i % 4 else None]) for i, y, x in rows(23, 700, 5)]


def test_trees_are_those_of_the_plain_form(spark):
    _, b, _ = binned(spark, odd_rows(), 20, folds=4, seeds=(1, 2))
    models = [B.classifier(rounds=6, min_child_weight=0.5, gamma=0.1), B.classifier(rounds=4, depth=3, fold_of=1, fold=2, alpha=0.0, reg_lambda=0.0, min_child_weight=0.1),
              B.regressor(rounds=8, step=0.3), B.regressor(rounds=6, depth=8, step=0.3, min_child_weight=1.0, gamma=2.0, fold_of=0, fold=3),
              B.plain(rounds=5, depth=7, logistic=False, reg_lambda=0.0), B.plain(rounds=30, step=1.5, fold_of=0, fold=0, patience=2), B.plain(rounds=2, depth=0)]
    got = sorted((tuple(r) for r in B.fit(b, models, [f"f{i}" for i in range(11)]).trees.collect()), key=lambda r: r[:3])
    assert got == plain_trees(b, models) and len(got) > 400


@pytest.mark.parametrize("scale", [2.0 ** 20, 2.0 ** 32, 2.0 ** 36])
def test_sums_of_more_rows_than_one_number_holds(spark, scale):
    """Rows are counted below the gradients' sum: over all rows, over parts of them, or apart."""
    h = lambda k, n: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(n))
    df = spark.range(70_000).select(F.col("id").alias("cl_id"), (h(0, 3) + h(1, 2)).cast("double").alias("label"),
                                    F.array(*[h(k, 3 + 4 * k).cast("double") for k in range(6)]).alias("features"))
    b = replace(B.bin_rows(df, 6), scale=scale)
    models = [B.regressor(rounds=2, depth=4, step=0.5, gamma=0.0)]
    got = sorted((tuple(r) for r in B.fit(b, models, list("abcdef")).trees.collect()), key=lambda r: r[:3])
    assert got == plain_trees(b, models) and len(got) > 20


def test_models_of_other_child_weights_share_a_task_and_no_python_worker(spark):
    """Before, every model was fitted by a Python worker of its own."""
    _, b, _ = binned(spark, odd_rows(), 20, folds=4, seeds=(1,))
    models = [B.regressor(rounds=12, depth=d, step=0.3, min_child_weight=w, seed=s, fold_of=0, fold=1) for d in (2, 5) for w in (4.0, 1.0, 60.0, 1.0) for s in (5, 6)]
    groups = B._alike(models)
    assert sorted(map(len, groups)) == [4, 4, 4, 4] and sorted(i for g in groups for i in g) == list(range(16))
    out = B._fit_in_tasks(b, models)
    assert "Python" not in (plan := out._jdf.queryExecution().toString()) and "MapInArrow" not in plan
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[:3]) == plain_trees(b, models)


def test_many_models_score_in_parts(spark, monkeypatch):
    """Before, the trees of all models came to the driver and every worker at once."""
    df, b, names = binned(spark, odd_rows(), 20, folds=4, seeds=(1,))
    models = [B.plain(rounds=5, seed=s, fold_of=0, fold=f) for s in range(3) for f in range(4)]
    forest = B.fit(b, models, [f"f{i}" for i in range(11)])
    whole = sorted(map(str, B.predict(forest, df, range(12), folds=names).collect()))
    nodes = forest.trees.where("node >= 0").count()
    monkeypatch.setattr(B, "PART_NODES", nodes // 3)
    sent, arrays = [], B.Forest.arrays

    def watched(self, models):
        out = arrays(self, models)
        sent.append(sum(len(s.child) for s in out.values()))
        return out
    monkeypatch.setattr(B.Forest, "arrays", watched)
    assert sorted(map(str, B.predict(forest, df, range(12), folds=names).collect())) == whole
    assert len(sent) >= 3 and max(sent) <= nodes // 3 and sum(sent) == nodes


def test_rows_go_down_all_trees_at_once_as_down_each():
    r = np.random.default_rng(2)
    trees = []
    for _ in range(7):
        t = B.Tree()
        for node in (0, 1, 2, 4):
            if r.random() < 0.8 and node < len(t.child):
                t.split(node, int(r.integers(0, 3)), int(r.integers(0, 5)), bool(r.integers(0, 2)), 1.0)
        t.value = list(r.normal(size=len(t.child)))
        trees.append(t)
    bins = r.integers(0, 6, (500, 3)).astype(np.uint8)
    bins[r.random((500, 3)) < 0.1] = B.MISSING
    x = np.where(bins == B.MISSING, np.nan, bins.astype(float))
    cuts = [np.arange(6.0)] * 3
    table = [row for k, t in enumerate(trees) for row in B.tree_rows(0, k, t, cuts)]
    col = {n: np.array([row[i] if row[i] is not None else np.nan for row in table]) for i, n in enumerate(B.NAMES)}
    expected = np.full(500, 0.5)
    for t in trees:
        expected = expected + np.array(t.value)[t.walk(bins)]
    stand = B.Stand.of(col)
    assert (stand.margins(x, 0.5) == expected).all() and (stand.margins(x[:0], 0.5)).shape == (0,)


def test_rows_that_fit_a_quarter_of_the_heap_are_held_by_executors(spark, monkeypatch):
    """Before, rows beyond 64 MB of bins were fitted by a Spark pass per level, thousands of them; constant features hold no bins."""
    _, b, _ = binned(spark, odd_rows(), 20)
    varied = b.n_rows * int(np.count_nonzero(b.sizes + b.missing > 1))
    assert varied < b.n_rows * len(b.cuts)
    monkeypatch.setattr(B, "SMALL_BYTES", 0)
    ways, in_tasks, by_levels = [], B._fit_in_tasks, B._fit_by_levels
    monkeypatch.setattr(B, "_fit_in_tasks", lambda *a: ways.append("held") or in_tasks(*a))
    monkeypatch.setattr(B, "_fit_by_levels", lambda *a: ways.append("levels") or by_levels(*a))
    trees = []
    for heap in (4 * varied, 4 * varied - 4):
        monkeypatch.setattr(B, "executor_heap", lambda spark, heap=heap: heap)
        trees.append(trees_of(B.fit(b, [B.plain(rounds=2, depth=2)], [f"f{i}" for i in range(11)])))
    assert ways == ["held", "levels"] and trees[0] == trees[1]
