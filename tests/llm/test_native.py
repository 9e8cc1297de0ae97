"""Sharding and fingerprints: SQL functions only."""

import hashlib
import re
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from cardlens.llm import fingerprints as P
from cardlens.llm import shards as S

from .helpers import EDGES, prose, table

ROWS = EDGES + [(100 + i, prose(i, 5 * i)) for i in range(120)] + [(300, "same text here"), (301, "same text here")]


def no_python(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow", plan)


# ---- shards
def test_shards_follow_the_law(spark):
    df = table(spark, ROWS, clash=["shard", "slot", "part", "_node"]).repartition(4)
    out = S.shard_rows(df, S.base_tree(24))
    assert no_python(out)
    rows = out.collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == \
        Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in ROWS)
    for s in {r["shard"] for r in rows}:
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert all(0 <= r["shard"] < 24 and r.grown_shard in (r["shard"], 24) for r in rows)
    by = {}
    assert all(by.setdefault(r.doc_id, r["shard"]) == r["shard"] for r in rows)
    assert S.shard_rows(table(spark, []), S.base_tree(24)).collect() == []


def test_draws_equal_a_plain_descent(spark):
    import math
    tree = [S.Leaf(0, 0, 0), S.Leaf(0, 0, 1, 2.5), S.Leaf(0, 1, 2, 0.5), S.Leaf(1, 2, 3), S.Leaf(2, 3, 4, 3.0), S.Leaf(2, 3, 5)]

    def draw(key, path, weight):
        h = xxhash.xxh64_intdigest(path.encode(), xxhash.xxh64_intdigest((key & (1 << 64) - 1).to_bytes(8, "little"), 42))
        return -math.log(((h >> 11) + 0.5) / 2 ** 53) / weight

    def descend(key):
        path, leaves = "tree", tree
        for a in ("region", "rack", "shard"):
            weights = {}
            for x in leaves:
                weights[getattr(x, a)] = weights.get(getattr(x, a), 0) + x.weight
            best = min(weights, key=lambda c: draw(key, f"{path}/{c}", weights[c]))
            path, leaves = f"{path}/{best}", [x for x in leaves if getattr(x, a) == best]
        return best
    out = S.with_shard(spark.range(-50, 2000), "id", tree, "shard").collect()
    assert all(r["shard"] == descend(r.id) for r in out)


def test_weights_and_movement(spark):
    keys = spark.range(20000)
    tree = S.base_tree(24)
    heavier = [S.Leaf(x.region, x.rack, x.shard, 3.0 if x.shard == 5 else 1.0) for x in tree]
    df = S.with_shard(S.with_shard(S.with_shard(keys, "id", tree, "a"), "id", heavier, "b"), "id", S.grown(tree), "c")
    rows = df.groupBy("a", "b", "c").count().collect()
    n = Counter()
    for r in rows:
        n[r.a] += r["count"]
        region = {x.shard: x.region for x in tree}
        if r.a != r.b:       # only into the region, and there the rack, whose weight grew
            assert region[r.b] == region[5] and (region[r.a] != region[5] or r.b == 5 or r.b // 4 == 1)
        assert r.c in (r.a, 24)
    assert max(n.values()) / min(n.values()) < 1.3
    moved = sum(r["count"] for r in rows if r.c == 24)
    assert 0.03 < moved / 20000 < 0.05
    share = sum(r["count"] for r in rows if r.b == 5) / 20000
    assert abs(share - 3 / 26) < 0.01


# ---- fingerprints
def chain(values):
    s = 42
    for x in values:
        s = xxhash.xxh64_intdigest((x & (1 << 64) - 1).to_bytes(8, "little"), s)
    return s - (1 << 64) if s >> 63 else s


def plain(text):
    w = [xxhash.xxh64_intdigest(x.encode(), 42) for x in re.split(r"[ \t\n\x0b\f\r]+", (text or "").lower()) if x]
    g = [chain(w[i:i + P.K_GRAM]) for i in range(len(w) - P.K_GRAM + 1)] if len(w) >= P.K_GRAM else ([chain(w)] if w else [])
    windows = [range(i, i + P.WINDOW) for i in range(len(g) - P.WINDOW + 1)] or ([range(len(g))] if g else [])
    at = list(dict.fromkeys(min(r, key=lambda i: (g[i] >> 24, -i)) for r in windows))
    return at, [g[i] for i in at]


def as_text(f):
    return ",".join(f"{p}:{h & (1 << 64) - 1:016x}" for p, h in zip(*f))


def near(a, b):
    a, b = set(a[1]), set(b[1])
    return len(a & b) / len(a | b) if a | b else 1.0


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_fingerprints_equal_plain_winnowing(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = [(i, t) for i, t in ROWS if i is not None and not (t and "\x00" in t)]
        out = P.fingerprints(table(spark, rows, clash=["_w", "_g", "fingerprint", "bucket"]).repartition(3))
        assert no_python(out)
        got = out.collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    tie = lambda t: (xxhash.xxh64_intdigest((t or "").encode(), 42) >> 1, t or "")
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0], *tie(r[1])))
    want = []
    for (i, t), (_, u) in zip(order, order[1:] + order[:1]):
        h = len(t) // 2
        e = t[:len(t) - h] + u[:h]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), as_text(plain(t)), as_text(plain(e)),
                     round(near(plain(t), plain(e)), 9), round(near(plain(t), plain(u)), 9)))
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 9), round(r.near_next, 9))
                  for r in got) == sorted(want)


def test_null_ids_one_row_and_no_rows(spark):
    out = P.fingerprints(table(spark, EDGES)).collect()
    assert len(out) == len(EDGES)
    by = {}
    for i, t in EDGES:
        by.setdefault(as_text(plain(t)), 0)
    (one,) = P.fingerprints(table(spark, [(1, "a b c d e f g")])).collect()
    assert one.near_next == 1.0 and one.n_chars == 13
    assert P.fingerprints(table(spark, [])).collect() == []


def test_shared_passage_shares_a_hash(spark):
    n = P.K_GRAM + P.WINDOW - 1
    passage = " ".join(f"q{i}" for i in range(n))
    rows = [(i, prose(i, 40) + " " + passage + " " + prose(i + 50, 40)) for i in range(12)]
    df = P.with_fingerprint(table(spark, rows), "text", "at", "hashes").collect()
    for r in df:
        inside = [(a, h) for a, h in zip(r.at, r.hashes) if 40 <= a <= 40 + n - P.K_GRAM]
        assert set(h for _, h in inside) & set.intersection(*[set(x.hashes) for x in df])


def test_one_id_in_a_third_of_the_rows(spark):
    rows = [(7 if i % 3 == 0 else i, prose(i, 30)) for i in range(300)]
    d = P.neighbours(table(spark, rows))
    assert d.where(F.col("next_text").isNull()).count() == 0 and d.count() == 300
    nexts = Counter(r.next_text for r in d.select("next_text").collect())
    assert set(nexts.values()) == {1} and len(nexts) == 300       # every row follows exactly one
