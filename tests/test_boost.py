"""Boosted trees: splits against brute force, both ways of fitting, many models at once, held-out loss, saving."""

import math
import random
import threading
import tracemalloc
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlens.operators import boost as B
from cardlens.operators.metrics import roc_auc, roc_auc_by
from cardlens.session import scratch_path


def rows(seed, n, n_features, missing=0.1, logistic=True):
    r, out = random.Random(seed), []
    for i in range(n):
        x = [round(r.gauss(0, 1), 1) if r.random() >= missing else r.choice([None, float("nan")]) for _ in range(n_features)]
        s = sum((v or 0) * (1 if j % 2 else -1) for j, v in enumerate(x[:4]) if v == v) + r.gauss(0, 0.5)
        out.append((i, float(s > 0) if logistic else s, x))
    return out


def binned(spark, data, max_bins=16, folds=0, seeds=(), n_features=None):
    df = spark.createDataFrame(data, "cl_id long, label double, features array<double>")
    df, names = B.with_folds(df, "cl_id", folds, seeds) if folds else (df, ())
    return df, B.bin_rows(df, n_features or len(data[0][2]), max_bins=max_bins, fold_columns=names), names


def trees_of(forest):
    return sorted((r.model, r.round, r.node, r.feature, r.bin, r.cut, r.missing_left, r.child, r.value, r.gain) for r in forest.trees.collect())


@pytest.mark.parametrize("alpha,lam,gamma,weight,logistic", [(0.0, 1.0, 0.0, 0.0, True), (1.0, 1.0, 0.4, 2.0, True), (0.5, 0.3, 0.0, 3.0, False)])
def test_first_split_is_the_best_of_all(spark, alpha, lam, gamma, weight, logistic):
    """One round of depth 1 against every feature, every cut and both places of the missing rows."""
    data = rows(7, 150, 5, logistic=logistic)
    df, b, _ = binned(spark, data, 200)
    m = B.Settings(rounds=1, depth=1, step=1.0, alpha=alpha, reg_lambda=lam, gamma=gamma, min_child_weight=weight, subsample=1.0, colsample=1.0, logistic=logistic)
    tree = {r.node: r for r in B.fit(b, [m], list("abcde")).trees.collect()}
    g = [(0.5 if logistic else 0.5) - y for _, y, _ in data]
    h = [0.25 if logistic else 1.0] * len(data)
    soft = lambda v: math.copysign(max(abs(v) - alpha, 0), v)
    score = lambda rs: soft(sum(g[i] for i in rs)) ** 2 / (sum(h[i] for i in rs) + lam)
    value = lambda rs: -soft(sum(g[i] for i in rs)) / (sum(h[i] for i in rs) + lam)
    everyone, best = range(len(data)), (0.0, None, None)
    for f in range(5):
        known = [i for i in everyone if data[i][2][f] is not None and data[i][2][f] == data[i][2][f]]
        rest = [i for i in everyone if i not in set(known)]
        for cut in sorted({data[i][2][f] for i in known}):
            low = [i for i in known if data[i][2][f] <= cut]
            for left in (low, low + rest):
                right = [i for i in everyone if i not in set(left)]
                if min(sum(h[i] for i in left), sum(h[i] for i in right)) >= max(weight, 1e-9) and left and right:
                    gain = score(left) + score(right) - score(everyone)
                    if gain > best[0] + 1e-7:
                        best = (gain, left, right)
    assert tree[0].gain == pytest.approx(best[0], abs=1e-5)
    got = sorted([tree[tree[0].child].value, tree[tree[0].child + 1].value])
    assert got == pytest.approx(sorted([value(best[1]), value(best[2])]), abs=1e-5)


def test_gain_penalty_prunes_from_below():
    t = B.Tree()
    c = t.split(0, 0, 0, False, 0.3)
    d = t.split(c, 1, 0, False, 0.9)
    t.split(d, 2, 0, False, 0.1)
    t.prune(0.4)
    # the weak lowest split goes, the weak root stays: below it a strong one does
    assert t.child[d] == -1 and t.child[c] == d and t.child[0] == c


def test_passes_per_level_and_one_task_per_model_give_the_same_trees(spark):
    df, b, names = binned(spark, rows(3, 300, 6), folds=3, seeds=(1, 2))
    models = [B.Settings(rounds=3, depth=3, seed=5, min_child_weight=1.0),
              B.Settings(rounds=4, depth=2, seed=6, fold_of=0, fold=1, min_child_weight=2.0),
              B.Settings(rounds=2, depth=4, seed=7, fold_of=1, fold=2, min_child_weight=0.5, logistic=False, alpha=0.1),
              B.Settings(rounds=12, depth=1, seed=8, fold_of=0, fold=0, patience=1, step=3.0, min_child_weight=0.5)]
    small = B.fit(b, models, list("abcdef"))
    large = B.fit(b, models, list("abcdef"), small_bytes=0)
    assert trees_of(small) == trees_of(large) and small.best_round == large.best_round


@pytest.mark.parametrize("joint", [0, 40, 4096])
def test_joint_histograms_and_sibling_sums_give_the_passes_trees(spark, monkeypatch, joint):
    """Deep trees, features of few and many bins, missing rows, subsampled rows."""
    monkeypatch.setattr(B, "JOINT", joint)
    data = [(i, y, [*x, float(i % 2), float(i % 3) if i % 5 else None, 1.0, x[0]]) for i, y, x in rows(13, 900, 4)]
    _, b, _ = binned(spark, data, 6, folds=3, seeds=(1,))
    models = [B.Settings(rounds=2, depth=6, min_child_weight=0.5, gamma=0.1, alpha=0.0, fold_of=0, fold=0),
              B.Settings(rounds=2, depth=5, min_child_weight=1.0, alpha=0.1, logistic=False, subsample=0.5)]
    local = B.Local(*_arrays(b), b.sizes, b.missing, b.scale)
    kept = [tuple(r) for i, m in enumerate(models) for k, t in enumerate(local.fit(m)[0]) for r in B.tree_rows(i, k, t, b.cuts)]
    large = [r for r in trees_of(B.fit(b, models, list("abcdefgh"), small_bytes=0)) if r[2] >= 0]
    assert sorted(kept) == large and len(large) > 60


def test_rows_in_memory_take_a_byte_per_bin():
    """Eight bytes did not fit executors; a tree's own numbers are a few per row."""
    import tracemalloc
    n, f = 20000, 100
    bins = np.asfortranarray(np.random.default_rng(1).integers(0, 30, (n, f)).astype(np.uint8))
    tracemalloc.start()
    B.Local(np.arange(n, dtype=np.uint64), np.arange(n) % 2.0, np.zeros((n, 0), np.int32), bins, np.full(f, 30), np.zeros(f, np.int64), 2.0 ** 20).fit(B.plain(rounds=1))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 8 * n * f / 2


def test_margins_written_between_rounds_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(B, "KEEP_ROUNDS", 2)
    _, b, _ = binned(spark, rows(4, 120, 4))
    m = [B.Settings(rounds=5, depth=2, min_child_weight=1.0)]
    assert trees_of(B.fit(b, m, list("abcd"), small_bytes=0)) == trees_of(B.fit(b, m, list("abcd")))


def test_models_of_one_call_equal_separate_fits(spark):
    _, b, _ = binned(spark, rows(5, 200, 5), folds=4, seeds=(0,))
    models = [replace(B.plain(rounds=6, seed=s), fold_of=0, fold=f, depth=d) for s in (1, 2) for f in range(4) for d in (2, 4)]
    together = trees_of(B.fit(b, models, list("abcde")))
    for i in (3, 12):
        alone = trees_of(B.fit(b, [models[i]], list("abcde")))
        assert [r[1:] for r in together if r[0] == i] == [r[1:] for r in alone]


def test_learns_and_scores_raw_values_as_binned_ones(spark):
    data = rows(6, 600, 6)
    df, b, _ = binned(spark, data, 64)
    forest = B.fit(b, [B.classifier(rounds=40, depth=4, min_child_weight=1.0)], list("abcdef"))
    scored = B.predict(forest, df)
    assert roc_auc(scored, "label", "prediction").first().auc > 0.95
    local = B.Local(*_arrays(b), b.sizes, b.missing, b.scale)
    _, margin, _ = local.fit(forest.models[0])
    by_key = dict(zip(local.key.astype(np.int64).tolist(), margin))
    for r in scored.withColumn("key", F.xxhash64(F.col("cl_id").cast("string"))).collect():
        assert r.margin == pytest.approx(by_key[r.key], abs=1e-9)


def _arrays(b):
    t = b.rows.toArrow()
    return (t["key"].to_numpy().astype(np.int64).view(np.uint64), t["label"].to_numpy(), B._folds(t["folds"]),
            np.frombuffer(b"".join(t["bins"].to_pylist()), np.uint8).reshape(t.num_rows, -1))


def test_not_below_mllib(spark):
    """Held-out AUC of a learnable label against MLlib's boosted trees of the same rounds and depth."""
    from pyspark.ml.functions import array_to_vector
    from cardlens.operators import learn as L
    data = rows(8, 800, 6, missing=0.0)
    df, b, names = binned(spark, data, 64, folds=4, seeds=(3,))
    forest = B.fit(b, [B.classifier(rounds=30, depth=3, min_child_weight=1.0, fold_of=0, fold=1)], list("abcdef"))
    own = roc_auc(B.predict(forest, df, folds=names), "label", "prediction").first().auc
    v = df.withColumn("features", array_to_vector("features"))
    theirs = L.classifier(max_iter=30, max_depth=3).fit(v.where("fold_3 <> 1")).transform(v.where("fold_3 = 1"))
    assert own > roc_auc(L.probability_of_one(theirs), "label", "probability_1").first().auc - 0.01 and own > 0.9


def test_held_out_rows_and_patience(spark):
    data = rows(9, 300, 5)
    df, b, names = binned(spark, data, folds=3, seeds=(1,))
    m = [B.classifier(rounds=60, depth=3, step=0.5, min_child_weight=1.0, fold_of=0, fold=f, patience=5) for f in range(3)]
    forest = B.fit(b, m, list("abcde"))
    held = B.predict(forest, df, models=range(3), folds=names)
    assert sorted(r.cl_id for r in held.collect()) == list(range(300))
    for i in range(3):
        loss = [r.cut for r in forest.trees.where(f"model = {i} and node = -1").orderBy("round").collect()]
        assert forest.best_round[i] == int(np.argmin(loss)) + 1 and len(loss) <= forest.best_round[i] + 5
    auc = {r.model: r.auc for r in roc_auc_by(held, "model", "label", "prediction").collect()}
    for i in range(3):
        assert auc[i] == roc_auc(held.where(f"model = {i}"), "label", "prediction").first().auc


def test_save_and_load(spark):
    df, b, _ = binned(spark, rows(10, 100, 4))
    forest = B.fit(b, [B.classifier(rounds=5, min_child_weight=1.0)], list("abcd"))
    loaded, extra = B.load(spark, B.save(forest, scratch_path(spark, "forest"), {"k": [1]}))
    assert extra == {"k": [1]} and loaded.columns == list("abcd") and loaded.models == forest.models
    assert sorted(B.predict(loaded, df).collect()) == sorted(B.predict(forest, df).collect())


def test_importances(spark):
    df, b, _ = binned(spark, rows(11, 400, 8, missing=0))
    forest = B.fit(b, [B.classifier(rounds=10, depth=3, min_child_weight=1.0)], list("abcdefgh"))
    imp = {r.feature: r.importance for r in B.importances(forest).collect()}
    assert sum(imp.values()) == pytest.approx(1) and len(imp) == 8 and min(imp[c] for c in "abcd") > max(imp[c] for c in "efgh")


def test_edge_rows(spark):
    one = [(1, 1.0, [None, 1.0]), (1, 1.0, [None, 1.0]), (None, 0.0, [None, float("nan")]), (2, None, [1.0, 2.0])]
    for data in (one, one[:1], []):
        df, b, _ = binned(spark, data, n_features=2) if data else binned(spark, [], n_features=2)
        for small in (B.SMALL_BYTES, 0):
            forest = B.fit(b, [B.classifier(rounds=2, min_child_weight=0.1, alpha=0.0)], ["x", "y"], small_bytes=small)
            assert B.predict(forest, df).count() == len(data)
    with pytest.raises(ValueError):
        B.bin_rows(df, 2, max_bins=1000)
    with pytest.raises(ValueError):
        B.fit(b, [], ["x", "y"])


def test_sizes_are_the_reference_s():
    c, r = B.classifier(), B.regressor()
    assert (c.rounds, c.depth, c.step, c.min_child_weight, c.gamma, c.subsample, c.colsample, c.alpha, c.seed) == (300, 7, 0.1, 4, 0.4, 0.9, 0.6, 1.0, 101)
    assert (r.rounds, r.depth, r.step, r.min_child_weight, r.gamma, r.subsample, r.colsample, r.alpha) == (3000, 3, 0.01, 3, 0.4, 0.9, 0.6, 1.0)


def test_splits_among_many_features_and_nodes_are_those_of_each_alone():
    """Nodes and features searched at once against one feature of one node at a time, with plain whole-number sums."""
    r = np.random.default_rng(5)
    sizes, missing = np.array([1, 7, 4, 9, 2]), np.array([0, 1, 0, 1, 1])
    layout, scale = B.Layout(sizes, missing), 4.0
    node, bins = r.integers(0, 6, 120), np.stack([r.integers(0, s + m, 120) for s, m in zip(sizes, missing)], axis=1)
    g, h = r.integers(-9, 10, 120).astype(float), r.integers(0, 5, 120).astype(float)
    hg, hh = B.histograms(bins + layout.starts, node, g, h, 7, layout.width)       # the seventh node has no rows
    for m in (B.classifier(min_child_weight=1.0), B.plain(alpha=0.5, min_child_weight=0.0), B.plain(min_child_weight=1e9)):
        gain, feature, bin_, left, lg, lh, tg, th = B.best_splits(hg, hh, layout, m, scale)
        soft = lambda a: max(abs(a) - m.alpha, 0.0)
        score = lambda a, b: soft(a) ** 2 / (b + m.reg_lambda)
        for i in range(7):
            mine, best = node == i, (0.0,)
            total_g, total_h = g[mine].sum() / scale, h[mine].sum() / scale
            for f in range(len(sizes)):
                for b in range(sizes[f] + missing[f]):
                    for missing_left in (False, True):
                        hole = bins[:, f] == sizes[f]
                        if missing_left and b == sizes[f]:
                            continue
                        low = mine & ((bins[:, f] <= b) & (~hole | (b == sizes[f])) | hole & missing_left)
                        a, c = g[low].sum() / scale, h[low].sum() / scale
                        if min(c, total_h - c) < max(m.min_child_weight, 0.5 / scale):
                            continue
                        x = round(score(a, c) + score(total_g - a, total_h - c) - score(total_g, total_h), 9)
                        if x > best[0]:
                            best = (x, f, b, missing_left, a, c)
            assert (tg[i], th[i]) == (total_g, total_h)
            assert gain[i] == pytest.approx(best[0], abs=1e-9)
            if best[0]:
                assert (feature[i], bin_[i], left[i], lg[i], lh[i]) == best[1:]


def test_split_search_scores_only_places_that_hold_rows():
    layout = B.Layout(np.full(300, 32), np.zeros(300, np.int64))
    hg, hh = np.zeros((64, layout.width)), np.zeros((64, layout.width))
    hg[:, ::16], hh[:, ::16] = 1.0, 8.0
    tracemalloc.start()
    B.best_splits(hg, hh, layout, B.plain(), 1.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 2 * hg.nbytes


def test_passes_over_several_packs_and_written_margins_give_the_tasks_trees(spark, monkeypatch):
    """Packs of a few rows each, margins written after every second round, a fold left out."""
    _, b, _ = binned(spark, rows(31, 300, 5), folds=3, seeds=(4,))
    models = [B.classifier(rounds=5, depth=3, min_child_weight=0.5, fold_of=0, fold=f) for f in range(2)]
    expected = trees_of(B.fit(b, models, list("abcde")))
    monkeypatch.setattr(B, "PACK_BYTES", 5 * 17)
    monkeypatch.setattr(B, "KEEP_NODES", 12)
    assert trees_of(B.fit(b, models, list("abcde"), small_bytes=0)) == expected


def test_a_pass_gives_one_pair_of_sums_per_node_and_keeps_margins():
    """Before, a pass gave a row per node, feature and bin and walked all trees since the written margins."""
    r = np.random.default_rng(3)
    n, bins = 200, r.integers(0, 8, (200, 4)).astype(np.uint8)
    row = (77, n, np.arange(n).astype("<i8").tobytes(), r.integers(0, 2, n).astype("<f8").tobytes(), np.zeros((n, 0), "<i4").tobytes(), bins.tobytes(), b"")
    p = B.Pass("a fit", [B.classifier(subsample=1.0, colsample=1.0)], np.full(4, 8), np.zeros(4, np.int64), 2.0 ** 20)
    g = B.Grower(p.models[0])
    p.growing = {0: (g.tree, g.open)}
    (at, sums), = B._level_sums(p, [row])
    assert at == (0, 0) and all(x.shape == (32,) for x in sums)
    g.level({node: x for _, node, x in B._level_splits(p, [(at, sums)])})
    tree, walks = g.done(), []
    monitored = B.Tree(**{k: getattr(tree, k) for k in tree.__dataclass_fields__})
    monitored.walk = lambda b: walks.append(1) or tree.walk(b)
    p.recent = {0: [monitored]}
    first, again = B._margin(p, row, bins, 0), B._margin(p, row, bins, 0)
    assert len(walks) == 1 and (first == again).all() and (first == np.array(tree.value)[tree.walk(bins)]).all()
    B._MARGINS.clear()          # another worker, or one that dropped them
    assert (B._margin(p, row, bins, 0) == first).all() and len(walks) == 2


def test_both_goals_of_the_card_model_are_fitted_side_by_side(spark, monkeypatch):
    from cardlens.functions.config import events_fixture
    from cardlens.plans import card_model as CM
    log = spark.createDataFrame([(i, float(i % 7), float(i % 3)) for i in range(60)], "cl_id long, x double, y double")
    labels = spark.createDataFrame([(i, int(i % 7 > 3), float(i % 7)) for i in range(0, 60, 2)], "cl_id long, target_flag int, target_sum double")
    monkeypatch.setattr(CM.FT, "prepare_log", lambda rows, rates, cfg: rows)
    monkeypatch.setattr(CM.FT, "fit_lists", lambda rows, cfg, trash: {})
    monkeypatch.setattr(CM.FT, "scored_features", lambda rows, cfg, lists: rows)
    both, fit = threading.Barrier(2), B.fit

    def meet(*a, **k):
        both.wait(120)          # breaks if the other goal waits for this one
        return fit(*a, **k)
    monkeypatch.setattr(B, "fit", meet)
    model = CM.fit_card_model(log, None, labels, events_fixture(), flag=B.classifier(rounds=2), spend=B.regressor(rounds=2))
    assert [f.models[0].logistic for f in (model.flag, model.spend)] == [True, False]


class Watched(np.ndarray):
    """Counts the rows that are gathered."""
    taken = 0

    def take(self, rows, *a, **k):
        Watched.taken += len(rows)
        return super().take(rows, *a, **k)


@pytest.mark.parametrize("even", [True, False])
@pytest.mark.parametrize("share", [1.0, 0.9, 0.65, 0.3])
def test_sums_of_most_rows_gather_no_more_than_the_others(even, share):
    r = np.random.default_rng(5)
    n = 4000
    bins = np.stack([r.integers(0, 5, n), r.integers(0, 7, n), np.where(r.random(n) < 0.1, B.MISSING, r.integers(0, 3, n)), r.integers(0, 30, n)], axis=1).astype(np.uint8)
    local = B.Local(np.arange(n).astype(np.uint64), r.normal(size=n), np.zeros((n, 0), np.int32), bins, np.array([5, 7, 3, 30]), np.array([0, 0, 1, 0]), 2.0 ** 20)
    columns = np.array([0, 2, 3])
    layout = B.Layout(local.sizes[columns], local.missing[columns])
    g, h = np.rint(r.normal(size=n) * 1000), np.full(n, 8.0) if even else np.rint(r.random(n) * 100)
    rows = np.sort(r.permutation(n)[:int(share * n)])
    groups = [(lo, hi, place.view(Watched)) for lo, hi, place in local.joined(columns, 200)]
    assert len(groups) == 2
    Watched.taken = 0
    sums = local.sums(columns, layout, groups, [rows], g, h)
    assert Watched.taken <= len(groups) * (min(len(rows), n - len(rows)) if even or share < 0.5 else 0)
    for out, w in zip(sums, (g, h)):
        expected = np.concatenate([np.bincount(local.places[f][rows], w[rows], local.sizes[f] + local.missing[f]) for f in columns])
        assert out.shape == (1, layout.width) and (out[0] == expected).all()
    two = local.sums(columns, layout, groups, [rows[::2], rows[1::2]], g, h)
    assert all((x.sum(axis=0) == s[0]).all() for x, s in zip(two, sums))


def test_both_ways_give_the_same_trees_where_most_rows_are_summed(spark, monkeypatch):
    monkeypatch.setattr(B, "JOINT", 40)
    data = [(i, y, [*x, float(i % 2), 1.0]) for i, y, x in rows(17, 900, 4)]
    _, b, _ = binned(spark, data, 6)
    models = [B.regressor(rounds=3, min_child_weight=1.0), B.classifier(rounds=3, min_child_weight=0.5)]
    assert trees_of(B.fit(b, models, list("abcdef"))) == trees_of(B.fit(b, models, list("abcdef"), small_bytes=0))
