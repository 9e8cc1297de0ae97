import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlens.llm import hard_negatives as H
from cardlens.llm import queries as Q

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, every=100, k=5, low=80, scale=256):
    best = {}
    for key, v, label in rows:
        if key is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = (label, [math.floor(scale * float(np.float32(x))) for x in v])
        best[key] = min(best.get(key, w), w)
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = set()
    for a, (label, v) in best.items():
        if a % every:
            continue
        ranked = sorted((-score(v, w), b, other) for b, (other, w) in best.items() if b != a)
        for p, b, _ in [x for x in ranked if x[2] == label][:k]:
            hit = [(n, c) for n, c, other in ranked if other != label and -low * p <= -100 * n <= -100 * p][:k]
            out |= {(a, b, i + 1, c, -p, -n) for i, (n, c) in enumerate(hit)}
    return out


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("windows", F.lit(1))
    got = [tuple(r) for r in H.hard_negatives(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def vectors(seed, n, dim, labels, spread):
    r = random.Random(seed)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = r.choice(centres)
        rows.append((i, [x + r.gauss(0, spread) for x in c], r.randrange(labels)))
    return rows


@pytest.mark.parametrize("seed,dim,labels,spread", [(1, 24, 3, 0.1), (2, 40, 2, 1.0), (3, 5, 8, 0.3), (4, 64, 1, 0.5)])
def test_equals_brute_force(spark, seed, dim, labels, spread):
    rows = vectors(seed, 400, dim, labels, spread)
    assert mined(spark, rows, every=20) == brute(rows, every=20)


def test_blocks_and_thresholds(spark, monkeypatch):
    # many small blocks: thresholds are carried from block to block
    monkeypatch.setattr(H, "BLOCK_ROWS", 16)
    monkeypatch.setattr(H, "ANCHOR_ROWS", 4)
    rows = vectors(9, 500, 32, 2, 0.4)
    assert mined(spark, rows, every=25, k=3, low=60) == brute(rows, every=25, k=3, low=60)


def test_edge_rows(spark):
    rows = [(0, [1.0, 0.5], 1), (0, [1.0, 0.5], 1), (1, [1.0, 0.5], 1), (2, [1.0, 0.5], 2), (3, [1.0, 0.5], 2), (3, [9.0, 9.0], 3), (4, None, 1),
            (5, [1.0, None], 1), (6, [1.0, float("nan")], 1), (7, [float("inf"), 0.0], 2), (8, [1.0, 0.5], None), (None, [1.0, 0.5], 1),
            (9, [], 1), (10, [], 2), (11, [1.0], 2), (12, [1.0, 0.45, 0.0, 0.0], 2), (100, [-1.0, 0.0], 1), (200, [0.0, 0.0], 2), (300, [], 3),
            (400, [0.9, 0.4], 2), (-100, [0.95, 0.5], 1), (14, [1e12, 1.0], 7), (15, [-0.001, 0.001], 1)]
    assert mined(spark, rows) == brute(rows)


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 1.0], i % 2) for i in range(300)]
    assert mined(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert mined(spark, []) == set()
    assert mined(spark, [(0, [1.0], 1)]) == set()


@pytest.mark.parametrize("seed", range(6))
def test_threshold_pairs_lose_none(seed):
    r = np.random.default_rng(seed)
    dim = int(r.integers(1, 70))
    fall = np.exp(-np.arange(dim) * r.choice([0, 0.05, 0.3]))
    q, x = (np.floor(256 * r.normal(size=(n, dim)) * fall) for n in (30, 200))
    scores = (q @ x.T).astype(np.int64)
    least = np.quantile(scores, r.choice([0.5, 0.9, 0.999], 30), axis=1).diagonal() if seed else np.full(30, -np.inf)
    a, b, s = H.threshold_pairs(q, H.suffix_norms(q), x, H.suffix_norms(x), least)
    want = {(i, j, int(scores[i, j])) for i, j in zip(*np.nonzero(scores >= least[:, None]))}
    assert set(zip(a.tolist(), b.tolist(), s.tolist())) == want and len(a) == len(want)


def test_index_leaves_dimensions_out():
    r = np.random.default_rng(1)
    x = np.floor(256 * r.normal(size=(500, 64)) * np.exp(-np.arange(64) * 0.2))
    norms = H.suffix_norms(x)
    least = np.square(norms[:5, 0]) * 0.9
    cut = H.indexed_groups(norms[:5], norms, least[:, None])
    assert cut.mean() < 3 and cut.max() < 8 and (cut == 0).any()
    a, b, _ = H.threshold_pairs(x[:5], norms[:5], x, norms, least)
    assert {(i, i) for i in range(5)} <= set(zip(a.tolist(), b.tolist()))
    assert (H.indexed_groups(norms[:5], norms, least[:, None] - least.max()) == 8).all()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding, r.label if r.label is None or r.vec_id % 7 else (r.label + 1) % 10)
            for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert {tuple(r) for r in Q.op11_hard_negatives(spark, sf).collect()} == brute(rows)


def test_anchors_are_not_broadcast(spark):
    """Copies of all anchors would be collected on the driver."""
    rows = spark.createDataFrame([(i, i % 3, [float(i % 7) / 8, float(i % 5) / 8]) for i in range(300)], "vec_id long, label long, embedding array<double>")
    assert "Broadcast" not in H.hard_negatives(rows)._jdf.queryExecution().toString()
