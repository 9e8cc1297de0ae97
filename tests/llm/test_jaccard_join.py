import random

import numpy as np
import pytest

from cardlens.llm import jaccard_join as J
from cardlens.llm import textkernel as K
from cardlens.llm.components import components
from cardlens.llm.jaccard_join import jaccard_components, keep_one

from .helpers import EDGES, jaccard_classes, key, near_copies, prose, shingles, table


def got(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()], key=key)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_all_pairs(spark, seed):
    rows = near_copies(seed)
    assert got(jaccard_components(table(spark, rows))) == sorted(jaccard_classes(rows), key=key)


def test_group_of_variants_at_the_threshold(spark):
    # one base, many variants: they link with the base, but often not with each other
    base = [f"w{i}" for i in range(100)]
    rows = []
    for i in range(60):
        t = list(base)
        for j in (i % 90, (7 * i + 13) % 95):
            t[j] = f"x{i}_{j}"
        rows.append((i, " ".join(t)))
    common = prose(5, 60)
    rows += [(1000 + i, common + " " + prose(100 + i, 25)) for i in range(40)]   # a passage that many share
    assert got(jaccard_components(table(spark, rows))) == sorted(jaccard_classes(rows), key=key)


def below_threshold(n, words=200, changed=5):
    """Variants of one text, none of which links with another: each has other words in ``changed`` places."""
    r, base, rows = random.Random(1), [f"w{i}" for i in range(words)], []
    for i in range(n):
        t = list(base)
        for j in range(changed):
            t[(r.randrange(words // changed - 8) + j * (words // changed)) + 3] = f"x{i}_{j}"
        rows.append((i, " ".join(t)))
    return rows


def test_candidates_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    counts = {}
    kept = J._crossing
    for n in (200, 800):
        def counted(*args, n=n):
            out = kept(*args)
            counts[n] = out.count()
            return out
        monkeypatch.setattr(J, "_crossing", counted)
        assert len({r[2] for r in got(jaccard_components(table(spark, below_threshold(n))))}) == n
    assert counts[800] <= 4 * max(counts[200], 10)


def test_signature_bounds_the_difference():
    r = np.random.default_rng(3)
    for n in (1, 50, 3000):
        a = np.unique(r.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: n // 2], r.integers(0, 1 << 63, n // 3).astype(np.uint64)]))
        bits = np.unpackbits((J.signature(a) ^ J.signature(b)).view(np.uint8)).sum()
        assert bits <= len(np.setxor1d(a, b)) and len(J.signature(a)) == J.SIGNATURE // 64
    assert not J.signature(a[:0]).any()


def test_edge_rows(spark):
    df = table(spark, EDGES, clash=["set_id", "n", "token", "group", "part", "row_number"])
    assert got(jaccard_components(df)) == sorted(jaccard_classes(EDGES), key=key)


def test_empty_table(spark):
    assert got(jaccard_components(table(spark, []))) == []
    assert keep_one(table(spark, [])).collect() == []


def test_keep_one(spark):
    rows = [(1000 + i, t) for i, t in near_copies(4)] + EDGES
    df = table(spark, rows, clash=["set_id", "apart", "row_number"])
    out = keep_one(df)
    assert out.columns == df.columns
    kept = [(r.doc_id, r.text) for r in out.collect()]
    classes = jaccard_classes(rows)
    n_groups = len({c for (i, n, c) in classes if n and c is not None})
    empty = [r for r in rows if not shingles(r[1])]
    assert len(kept) == n_groups + len(empty)
    assert sorted([k for k in kept if not shingles(k[1])], key=lambda r: str(r)) == sorted(empty, key=lambda r: str(r))
    assert {i for i, t in kept if shingles(t)} == {c for _, n, c in classes if n}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(30)] + [(100, 200 + i) for i in range(20)] + [(5, 5), (None, 3), (7, 6), (7, 6)]
    df = components(spark.createDataFrame(links, "a long, b long"))
    out = {r.node: r.component for r in df.collect()}
    assert out == {**{i: 0 for i in range(31)}, 100: 100, **{200 + i: 100 for i in range(20)}}
    assert df.count() == len(out)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_word_hashes_do_not_depend_on_blocks():
    import pyarrow as pa
    texts = ["Alpha beta  gamma", None, "", prose(9, 500), "beta", "gamma\tAlpha"]
    one = [s for *_, d, p in K.blocks(pa.array(texts)) for s in K.shingle_sets(d, p)]
    many = [s for *_, d, p in K.blocks(pa.array(texts), 10) for s in K.shingle_sets(d, p)]
    assert all(np.array_equal(a, b) for a, b in zip(one, many, strict=True))
    assert [len(s) for s in one] == [len(shingles(t)) for t in texts]
