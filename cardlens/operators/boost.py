"""Regularised second-order boosted trees for many models at once.

A model is a setting (``Settings``): rounds, depth, step, gain penalty, L1 and L2 weights, minimum child weight, row and
column sampling, and the fold it leaves out.  All models of a call read the same rows, binned once at quantiles and
written once.

* A level of all trees of a round is one pass: every task adds the gradients and hessians of its rows up per (model,
  node, feature, bin), the partial histograms of a (model, node) meet in one task, which sums and searches them, and one row
  per (model, node) comes back.  So a pass serves every fold, seed and grid point.  The rows are packed as arrays and kept by the executors.
* Gradients are whole numbers (fixed point), so sums do not depend on the order of rows, tasks or retries.
* Margins are written to the shared folder every ``KEEP_ROUNDS`` rounds; between them a Python worker keeps those it has worked out, and
  walks the trees that it lacks.  A lost executor costs at most those rounds' walks.
* Where the binned rows are small (``fit``), executors hold them whole and ``TreeFit.java`` fits each group of like models in one task in the
  JVM, groups spread over tasks: no pass per level.  Of two siblings only the smaller is summed.  ``Local`` is its plain form, which tests hold
  it against.  All ways give the same trees.

Sampling is a hash of (seed, round, row or feature), so re-runs and other partitionings draw the same.
"""

from __future__ import annotations

import hashlib
import json
import math
import os
import uuid
from collections import OrderedDict
from dataclasses import asdict, dataclass, field, replace
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens.operators.metrics import hash_folds
from cardlens.operators.tree_kernel import executor_heap, fit_function, spec
from cardlens.session import at_once, send_package, write_table

SMALL_BYTES = 64 << 20
KEEP_ROUNDS = 50
KEEP_NODES = 100_000    # nodes of the trees that the written margins lack
PACK_BYTES = 24 << 20   # bins of a pack of rows
KEPT_BYTES = 256 << 20  # margins that a Python worker keeps between passes
CHUNK = 1 << 17         # numbers worked on at a time
PART_NODES = 1_000_000  # nodes of the trees that a worker holds to score rows by many models
JOINT = 4096            # places of the largest joint histogram; fits 16 bits
MISSING = 255           # bin of a missing value
LOSS = -1               # feature of the rows that carry the held-out loss
U64 = np.uint64
TREE = "model int, round int, node int, feature int, bin int, cut double, missing_left boolean, child int, value double, gain double"
NAMES = [x.split()[0] for x in TREE.split(", ")]


@dataclass(frozen=True)
class Settings:
    """One model.  ``logistic``: binary classification on margins, else squared error.  ``fold_of`` names the column of
    folds and ``fold`` the one left out (None: all rows train).  ``patience``: rounds without a better held-out
    loss after which the model stops (None: all rounds)."""
    rounds: int = 300
    depth: int = 7
    step: float = 0.1
    gamma: float = 0.4
    alpha: float = 1.0
    reg_lambda: float = 1.0
    min_child_weight: float = 4.0
    subsample: float = 0.9
    colsample: float = 0.6
    seed: int = 101
    logistic: bool = True
    fold_of: int | None = None
    fold: int | None = None
    patience: int | None = None


def classifier(**changes) -> Settings:
    """The card job's classifier."""
    return replace(Settings(), **changes)


def regressor(**changes) -> Settings:
    """The card job's regressor on the log target."""
    return replace(Settings(rounds=3000, depth=3, step=0.01, min_child_weight=3.0, seed=0, logistic=False), **changes)


def plain(**changes) -> Settings:
    """The library defaults that the reference's plain cross-validation uses: 100 rounds of depth 3, no sampling."""
    return replace(Settings(rounds=100, depth=3, gamma=0.0, alpha=0.0, min_child_weight=1.0, subsample=1.0, colsample=1.0, seed=0), **changes)


# ---------------------------------------------------------------- sampling and gradients

def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _draw(keys: np.ndarray, *salts: int) -> np.ndarray:
    """Uniform in [0, 1) per key."""
    s = np.zeros(1, U64)
    for salt in salts:
        s = _mix(s + U64(salt % (1 << 63)) + U64(0x9E3779B97F4A7C15))
    return (_mix(keys ^ s[0]) >> U64(11)).astype(np.float64) / 2.0 ** 53


def rows_drawn(keys: np.ndarray, m: Settings, round_: int) -> np.ndarray:
    return _draw(keys, 1, m.seed, round_) < m.subsample if m.subsample < 1 else np.ones(len(keys), bool)


def features_drawn(n: int, m: Settings, round_: int) -> np.ndarray:
    if m.colsample >= 1:
        return np.arange(n)
    order = np.argsort(_draw(np.arange(n, dtype=U64), 2, m.seed, round_), kind="stable")
    return np.sort(order[:max(1, int(m.colsample * n))])


def base_margin(m: Settings) -> float:
    """Score 0.5 before the first tree."""
    return 0.0 if m.logistic else 0.5


def gradients(m: Settings, y: np.ndarray, margin: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """Fixed-point gradients and hessians of the loss."""
    if m.logistic:
        p = 1.0 / (1.0 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-16)
    else:
        g, h = margin - y, np.ones(len(y))
    return np.rint(g * scale), np.rint(h * scale)


def losses(m: Settings, y: np.ndarray, margin: np.ndarray) -> np.ndarray:
    if m.logistic:
        return np.maximum(margin, 0) - margin * y + np.log1p(np.exp(-np.abs(margin)))
    return np.square(margin - y)


def fixed_point(n_rows: int, most: float) -> float:
    """A power of two by which gradients up to ``most`` of ``n_rows`` rows add up below 2**52."""
    return 2.0 ** min(30, 52 - int(np.ceil(np.log2(max(2.0, n_rows * max(1.0, most))))))


# ---------------------------------------------------------------- trees

@dataclass
class Tree:
    """Nodes in order of making; node i's children are child[i] and child[i] + 1, -1 at a leaf."""
    feature: list = field(default_factory=lambda: [-1])
    bin: list = field(default_factory=lambda: [0])
    missing_left: list = field(default_factory=lambda: [False])
    child: list = field(default_factory=lambda: [-1])
    value: list = field(default_factory=lambda: [0.0])
    gain: list = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bin_: int, missing_left: bool, gain: float) -> int:
        self.feature[node], self.bin[node], self.missing_left[node], self.gain[node] = feature, bin_, missing_left, gain
        at = self.child[node] = len(self.child)
        for _ in range(2):
            self.feature.append(-1)
            self.bin.append(0)
            self.missing_left.append(False)
            self.child.append(-1)
            self.value.append(0.0)
            self.gain.append(0.0)
        return at

    def prune(self, gamma: float) -> None:
        """From below: a split of two leaves with less gain than ``gamma`` is undone."""
        for node in reversed(range(len(self.child))):
            c = self.child[node]
            if c >= 0 and self.child[c] < 0 and self.child[c + 1] < 0 and self.gain[node] < gamma:
                self.child[node], self.feature[node], self.gain[node] = -1, -1, 0.0

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of each row of bins."""
        child, feature = np.array(self.child), np.array(self.feature)
        cut, left = np.array(self.bin), np.array(self.missing_left)
        at = np.zeros(len(bins), np.int64)
        go = np.flatnonzero(child[at] >= 0)
        while len(go):
            n = at[go]
            b = bins[go, feature[n]]
            right = np.where(b == MISSING, ~left[n], b > cut[n])
            at[go] = child[n] + right
            go = go[child[at[go]] >= 0]
        return at


def leaf_value(g: float, h: float, m: Settings) -> float:
    shrunk = math.copysign(max(abs(g) - m.alpha, 0.0), g)
    return -shrunk / (h + m.reg_lambda) * m.step if h > 0 else 0.0


class Layout:
    """Places of the drawn features' bins side by side: feature j has ``sizes[j]`` bins from ``starts[j]`` and, if any row of
    it is missing, one more place behind them.  So a cut between two places sends missing rows right of it."""

    def __init__(self, sizes: np.ndarray, missing: np.ndarray):
        self.sizes, self.missing = sizes, missing
        width = sizes + missing
        self.starts = np.cumsum(width) - width
        self.width = int(width.sum())
        self.feature = np.repeat(np.arange(len(sizes)), width)      # of each place
        self.holes = np.flatnonzero(missing)
        self.hole_at = (self.starts + sizes)[self.holes]


def best_splits(g: np.ndarray, h: np.ndarray, layout: Layout, m: Settings, scale: float):
    """Best split of each node by histograms [node, place]: (gain, feature, bin, missing left, left sums of g and h,
    sums of g and h); gain 0 where none is allowed.  Of equal gains the first in (feature, bin, missing right before left) order.
    Only cuts behind places that hold rows and leave both sides heavy enough are scored: behind an empty place it is the cut before."""
    n, n_features = len(g), len(layout.starts)
    end = int(layout.starts[1]) if n_features > 1 else layout.width
    total_g, total_h = g[:, :end].sum(axis=1) / scale, h[:, :end].sum(axis=1) / scale       # every feature has all rows
    least = max(m.min_child_weight, 0.5 / scale)

    def score(a, b):
        t = np.maximum(np.abs(a) - m.alpha, 0.0) if m.alpha > 0 else a
        return t * t / (b + m.reg_lambda if m.reg_lambda > 0 else np.maximum(b, 1e-12))
    root = score(total_g, total_h)

    def first_best(node, place, lg, lh):
        """(gain, place, left sums) of each node's first best cut, the cuts sorted by (node, place); gains are rounded so that equal splits tie."""
        best, at, left_g, left_h = np.zeros(n), np.zeros(n, np.int64), g[:, 0] / scale, h[:, 0] / scale
        ok = np.flatnonzero((lh >= least) & (total_h[node] - lh >= least))
        if not len(ok):
            return best, at, left_g, left_h
        node, place, lg, lh = node[ok], place[ok], lg[ok], lh[ok]
        gain = score(lg, lh)
        gain += score(total_g[node] - lg, total_h[node] - lh)
        gain -= root[node]
        starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        some = node[starts]
        best[some] = np.maximum(np.round(np.maximum.reduceat(gain, starts), 9), 0.0)
        near = np.flatnonzero(gain >= (best - 2e-9 - 1e-14 * best)[node])
        near = near[np.round(gain[near], 9) == best[node[near]]]
        some, first = np.unique(node[near], return_index=True)
        first = near[first]
        at[some], left_g[some], left_h[some] = place[first], lg[first], lh[first]
        return best, at, left_g, left_h
    filled = (g != 0) | (h != 0)
    node, place = np.repeat(np.arange(n), np.count_nonzero(filled, axis=1)), np.flatnonzero(filled)
    place -= node * layout.width
    mine = node * n_features + layout.feature[place]
    starts = np.flatnonzero(np.r_[True, mine[1:] != mine[:-1]]) if len(mine) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(mine)])

    def running(x):
        x = x[filled].astype(np.int64)          # whole numbers: no sum is rounded
        c = np.cumsum(x)
        c -= np.repeat(c[starts] - x[starts], sizes)
        return c / scale
    best, at, lg, lh = first_best(node, place, running(g), running(h))
    left = np.zeros(n, bool)
    if len(layout.holes) and h[:, layout.hole_at].any():       # features without missing rows have no other cuts
        cuts = layout.sizes[layout.holes]
        where = np.repeat(np.arange(len(cuts)), cuts)
        begin = np.cumsum(cuts) - cuts
        places = np.arange(len(where)) - begin[where] + layout.starts[layout.holes][where]

        def with_missing(x):
            x = x / scale
            c = np.cumsum(x[:, places], axis=1)
            before = np.zeros((n, len(cuts)))
            before[:, 1:] = c[:, begin[1:] - 1]
            return (c + (x[:, layout.hole_at] - before)[:, where]).ravel()
        gain, also, other_g, other_h = first_best(np.repeat(np.arange(n), len(places)), np.tile(places, n), with_missing(g), with_missing(h))
        left = (gain > best) | ((gain == best) & (gain > 0) & (also < at))
        best, at = np.where(left, gain, best), np.where(left, also, at)
        lg, lh = np.where(left, other_g, lg), np.where(left, other_h, lh)
    feature = layout.feature[at]
    return best, feature, at - layout.starts[feature], left, lg, lh, total_g, total_h


def histograms(places: np.ndarray, node: np.ndarray, g: np.ndarray, h: np.ndarray, n_nodes: int, width: int):
    """Sums per [node, place]; ``places`` holds each row's place per feature."""
    index = (places + (node * width)[:, None]).ravel()
    n = places.shape[1]
    return tuple(np.bincount(index, np.repeat(w, n), n_nodes * width).reshape(n_nodes, width) for w in (g, h))


def sums_by_row(by_row: np.ndarray, layout: Layout, nodes: list, g: np.ndarray, h: np.ndarray):
    """Sums of ``g`` and ``h`` per [node, place] over each node's rows; ``by_row`` holds each row's bins of the drawn features side by side."""
    out_g, out_h = (np.zeros((len(nodes), layout.width)) for _ in range(2))
    n = by_row.shape[1]
    step = max(1, CHUNK // max(1, n))
    even = h[0] if len(h) and (h == h[0]).all() else None      # of squared error: counting rows is enough
    for i, rows in enumerate(nodes):
        for lo in range(0, len(rows), step):
            part = rows[lo:lo + step]
            at = np.add(by_row[part], layout.starts, dtype=np.int64).ravel()
            out_g[i] += np.bincount(at, np.repeat(g[part], n), layout.width)
            out_h[i] += np.bincount(at, None if even is not None else np.repeat(h[part], n), layout.width)
    return out_g, out_h if even is None else out_h * even


MIN_GAIN = 1e-6


class Grower:
    """One tree, level by level: which nodes are open, and what a level's best splits make of them."""

    def __init__(self, m: Settings):
        self.m, self.tree, self.open, self.sums = m, Tree(), [0], {}

    def level(self, found: dict) -> None:
        """``found``: node -> (gain, feature, bin, missing left, left g, left h, g, h) of the open nodes that have rows."""
        below = []
        for node in self.open:
            if node not in found:
                continue
            gain, feature, bin_, left, lg, lh, g, h = found[node]
            self.sums[node] = (g, h)
            if gain > MIN_GAIN:
                c = self.tree.split(node, feature, bin_, left, gain)
                self.sums[c], self.sums[c + 1] = (lg, lh), (g - lg, h - lh)
                below += [n for n in (c, c + 1) if self.sums[n][1] >= 2 * self.m.min_child_weight]  # others cannot be split
        self.open = below

    def done(self) -> Tree:
        self.tree.prune(self.m.gamma)
        for node, (g, h) in self.sums.items():
            self.tree.value[node] = leaf_value(g, h, self.m)
        return self.tree


# ---------------------------------------------------------------- binned rows

@dataclass
class Binned:
    """Rows (key, label, folds, bins) written once, with what is needed to bin others: cuts[f] of each feature."""
    rows: DataFrame
    cuts: list
    missing: np.ndarray     # features with a missing value
    n_rows: int
    scale: float
    files: list[str]        # of the rows

    @property
    def sizes(self) -> np.ndarray:
        """Bins of each feature."""
        return np.array([max(1, len(c)) for c in self.cuts], np.int64)


def quantile_cuts(data: DataFrame, n_features: int, max_bins: int, vector: str = "features") -> list[np.ndarray]:
    """Cut points of each feature: its distinct approximate quantiles (values that occur).  One aggregate of
    mergeable sketches; ``n_features * max_bins`` numbers at most reach the driver."""
    probs = F.array(*[F.lit(float(p)) for p in np.linspace(0, 1, max_bins + 1)[1:]])
    at = lambda i: F.get(vector, F.lit(i))

    def some(lo):
        row = data.agg(*[F.percentile_approx(F.nanvl(at(i), F.lit(None).cast("double")), probs, F.lit(100 * max_bins)).alias(f"q{i}")
                         for i in range(lo, min(n_features, lo + 100))]).first()
        return [np.unique(np.array(q if q else [], np.float64)) for q in row]
    parts = at_once(data.sparkSession, [partial(some, lo) for lo in range(0, n_features, 100)])     # 100 sketches to a pass keep generated code small
    return [q for part in parts for q in part]


def to_bins(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """Bin of each value: the number of cuts below it; beyond the last cut as the last."""
    out = np.empty(x.shape, np.uint8)
    for f, c in enumerate(cuts):
        b = np.minimum(np.searchsorted(c, x[:, f], "left"), max(0, len(c) - 1))
        out[:, f] = np.where(np.isnan(x[:, f]), MISSING, b)
    return out


def _folds(column) -> np.ndarray:
    lists = column.to_pylist()
    return np.array(lists, np.int32).reshape(len(lists), len(lists[0]) if lists else 0)


def _held(m: Settings, folds: np.ndarray) -> np.ndarray:
    """Rows that the model leaves out."""
    return folds[:, m.fold_of] == m.fold if m.fold is not None and len(folds) else np.zeros(len(folds), bool)


def _matrix(column: pa.Array) -> np.ndarray:
    """list<double> column as a matrix; null as NaN."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def bin_rows(data: DataFrame, n_features: int, key: str = "cl_id", max_bins: int = 32, fold_columns: tuple = (),
             vector: str = "features") -> Binned:
    """Bin (key, label, ``vector`` array<double>) rows and write them.  Rows without a label are left out.  NaN and null are missing."""
    if not 2 <= max_bins <= 250:
        raise ValueError("max_bins from 2 to 250")
    data = write_table(data.where("label is not null").select(
        F.xxhash64(F.col(key).cast("string")).alias("key"), F.col(key).alias("id"), F.col("label").cast("double").alias("label"),
        F.array(*[F.col(c).cast("int") for c in fold_columns]).cast("array<int>").alias("folds"), F.col(vector).alias("x")), "training")
    cuts = quantile_cuts(data, n_features, max_bins, "x")

    def run(batches):
        for batch in batches:
            b = to_bins(_matrix(batch.column(4)), cuts) if n_features else np.zeros((batch.num_rows, 0), np.uint8)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array([r.tobytes() for r in b], pa.binary())], ["key", "id", "label", "folds", "bins"])
    id_type = data.schema["id"].dataType
    schema = T.StructType([T.StructField("key", T.LongType()), T.StructField("id", id_type), T.StructField("label", T.DoubleType()),
                           T.StructField("folds", T.ArrayType(T.IntegerType())), T.StructField("bins", T.BinaryType())])
    rows = write_table(_in_tasks(data, run, schema), "binned")
    n, most = rows.agg(F.count(F.lit(1)), F.max(F.abs("label"))).first()
    seen = _in_tasks(rows.select("bins"), _missing_task(n_features), "feature int").distinct().collect()    # a row per feature at most
    missing = np.zeros(n_features, np.int64)
    missing[[r.feature for r in seen]] = 1
    # a margin stays within the labels' range and the start; twice that leaves room
    return Binned(rows, cuts, missing, n, fixed_point(n, 2 * (most or 0) + 1), rows.inputFiles())


def _missing_task(n_features: int):
    def run(batches):
        seen = np.zeros(n_features, bool)
        for batch in batches:
            seen |= (np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(batch.num_rows, n_features) == MISSING).any(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(seen).astype(np.int32))], ["feature"])
    return run


def with_folds(data: DataFrame, key: str, folds: int, seeds) -> tuple[DataFrame, tuple]:
    """One column of hash folds per seed, and the columns' names."""
    names = []
    for s in seeds:
        names.append(f"fold_{s}")
        data = hash_folds(data, key, folds, s, out=names[-1])
    return data, tuple(names)


# ---------------------------------------------------------------- fitting: rows in memory

class Local:
    """All rows in memory, one byte per row and feature, by feature."""

    def __init__(self, key, label, folds, bins, sizes: np.ndarray, missing: np.ndarray, scale: float):
        self.key, self.label, self.folds, self.scale = key, label, folds, scale
        self.sizes, self.missing, self.n_features = sizes, missing, bins.shape[1]
        self.places = np.ascontiguousarray(bins.T)      # of each feature; no copy of bins that lie by feature
        if self.places.size and self.places.max() == MISSING:
            self.places = np.minimum(self.places, sizes.astype(np.uint8)[:, None])      # missing rows behind the last bin
        # columns that bin all rows alike give equal splits, of which the first counts; constant ones give none
        first: dict[bytes, int] = {}
        self.alike = np.array([first.setdefault(hashlib.blake2b(c).digest(), f) for f, c in enumerate(self.places)], np.int64)
        self.varies = np.array([(c != c[:1]).any() for c in self.places], bool)
        self._counts: dict[int, np.ndarray] = {}

    def worth_searching(self, columns: np.ndarray) -> np.ndarray:
        first = columns[np.sort(np.unique(self.alike[columns], return_index=True)[1])]
        some = first[self.varies[first]]
        return some if len(some) else columns[:1]

    def goes_right(self, rows: np.ndarray, feature: int, bin_: int, missing_left: bool) -> np.ndarray:
        place = self.places[feature].take(rows, mode="clip")
        right = place > bin_
        return right & (place != self.sizes[feature]) if missing_left and self.missing[feature] else right

    def joined(self, columns: np.ndarray, most: int) -> list[tuple]:
        """(first, end, place in the group's joint histogram of each row) of neighbouring drawn features whose joint histogram has at most ``most`` places."""
        widths = self.sizes[columns] + self.missing[columns]
        out, lo = [], 0
        while lo < len(columns):
            hi, size = lo + 1, int(widths[lo])
            while hi < len(columns) and size * int(widths[hi]) <= most:
                size *= int(widths[hi])
                hi += 1
            place = self.places[columns[lo]]
            if hi > lo + 1:
                place = place.astype(np.uint16)
                for j in range(lo + 1, hi):
                    place *= np.uint16(widths[j])
                    place += self.places[columns[j]]
            out.append((lo, hi, place))
            lo = hi
        return out

    def sums(self, columns: np.ndarray, layout: Layout, groups: list[tuple], nodes: list, g: np.ndarray, h: np.ndarray):
        """Sums of ``g`` and ``h`` per [node, place] over each node's rows, a few groups of features at a time."""
        rows = np.concatenate(nodes)
        n, all_ = len(rows), len(g)
        even = h[rows[0]] if n and (h == h[rows[0]]).all() else None      # of squared error: counting rows is enough
        if len(nodes) == 1 and 8 * n >= 5 * all_:
            # most rows: those outside weigh nothing, so no row is gathered
            inside = np.zeros(all_, bool)
            inside[rows] = True
            out_g, out_h = self._summed(columns, layout, groups, None, 1, all_, np.where(inside, g, 0.0), None if even is not None else np.where(inside, h, 0.0))
            if even is not None:        # all rows less those outside
                outside = np.flatnonzero(~inside)
                out_h = np.concatenate([self.counts(f) for f in columns])[None] - self._summed(columns, layout, groups, (outside, 0), 1, len(outside), None, True)[1]
        else:
            number = np.repeat(np.arange(len(nodes)), [len(x) for x in nodes]) if len(nodes) > 1 else 0
            out_g, out_h = self._summed(columns, layout, groups, (rows, number), len(nodes), n, g[rows], True if even is not None else h[rows])
        return out_g, out_h if even is None else out_h * even

    def counts(self, feature: int) -> np.ndarray:
        """All rows by place of a feature, counted once."""
        if feature not in self._counts:
            self._counts[feature] = np.bincount(self.places[feature], minlength=self.sizes[feature] + self.missing[feature]).astype(np.float64)
        return self._counts[feature]

    def _summed(self, columns: np.ndarray, layout: Layout, groups: list[tuple], taken, n_nodes: int, n: int, g, h):
        """Sums per [node, place] of two weights of ``n`` rows (None: not asked for; True: one a row); ``taken``: (rows, node of each), None for all rows."""
        widths = self.sizes[columns] + self.missing[columns]
        sizes = [int(np.prod(widths[lo:hi])) for lo, hi, _ in groups]
        step = min(len(groups), max(1, CHUNK // max(1, n)))
        asked = [(np.zeros((n_nodes, layout.width)), None if w is True else np.tile(w, step)) for w in (g, h) if w is not None]
        index = np.empty((step, n), np.int64)
        held = {t: np.empty(n, t) for t in (np.dtype(np.uint8), np.dtype(np.uint16))} if taken else {}
        for first in range(0, len(groups), step):
            part, size = groups[first:first + step], sizes[first:first + step]
            starts = np.cumsum(size) - size
            total = int(sum(size))
            base = taken[1] * total if taken else 0
            for j, (_, _, place) in enumerate(part):
                if taken:       # rows are within bounds: clipping spares the check
                    place = place.take(taken[0], out=held[place.dtype], mode="clip")
                np.add(place, base + starts[j], out=index[j])
            at = index[:len(part)].ravel()
            for out, w in asked:
                hist = np.bincount(at, None if w is None else w[:len(at)], n_nodes * total).reshape(-1, total)
                for j, (lo, hi, _) in enumerate(part):
                    x = hist[:, starts[j]:starts[j] + size[j]].reshape(n_nodes, *widths[lo:hi])
                    for f in range(lo, hi):
                        others = tuple(i for i in range(1, x.ndim) if i != f - lo + 1)
                        out[:, layout.starts[f]:layout.starts[f] + widths[f]] = x.sum(axis=others) if others else x
        found = iter([out for out, _ in asked])
        return tuple(next(found) if w is not None else None for w in (g, h))

    def grow(self, m: Settings, round_: int, margin: np.ndarray, held: np.ndarray) -> tuple[Tree, np.ndarray]:
        """(one tree, each row's value in it)"""
        g, h = gradients(m, self.label, margin, self.scale)
        drawn = rows_drawn(self.key, m, round_) & ~held
        columns = features_drawn(self.n_features, m, round_)
        if len(columns):
            columns = self.worth_searching(columns)
        layout = Layout(self.sizes[columns], self.missing[columns])
        grower = Grower(m)
        used, others = {0: np.flatnonzero(drawn)}, {0: np.flatnonzero(~drawn)}      # rows of each leaf; ``others`` only take its value
        kept: dict[int, tuple] = {}             # sums of open nodes
        most = min(JOINT, len(used[0]) // 16)
        joint = self.joined(columns, most) if most >= JOINT // 4 else None
        by_row = None
        parent = {}
        for _ in range(m.depth):
            open_ = [n for n in grower.open if len(used[n])]
            if not open_ or not len(columns):
                break
            # of two siblings the smaller is summed, the other is the rest of their parent; sums are whole numbers
            direct, rest = [], []
            for n in sorted({n if not n else n - (n - 1) % 2 for n in open_}):
                if not n:
                    direct.append(n)
                    continue
                small = n if len(used[n]) <= len(used[n + 1]) else n + 1
                direct.append(small)
                rest.append((small, 2 * n + 1 - small))
            if joint is not None and sum(len(used[n]) for n in direct) >= 2 * most * len(direct):
                hg, hh = self.sums(columns, layout, joint, [used[n] for n in direct], g, h)
            else:
                if by_row is None:
                    by_row = np.ascontiguousarray(self.places[columns].T)
                hg, hh = sums_by_row(by_row, layout, [used[n] for n in direct], g, h)
            now = {n: (hg[i], hh[i]) for i, n in enumerate(direct)}
            for small, large in rest:
                if large in grower.open:
                    pg, ph = kept[parent[small]]
                    now[large] = pg - now[small][0], ph - now[small][1]
            found, few = {}, max(1, CHUNK // max(1, layout.width))
            for lo in range(0, len(open_), few):
                part = open_[lo:lo + few]
                gain, feature, bin_, left, lg, lh, tg, th = best_splits(
                    np.stack([now[n][0] for n in part]), np.stack([now[n][1] for n in part]), layout, m, self.scale)
                for i, n in enumerate(part):
                    found[n] = (float(gain[i]), int(columns[feature[i]]), int(bin_[i]), bool(left[i]), float(lg[i]), float(lh[i]), float(tg[i]), float(th[i]))
            kept = now
            grower.level(found)
            tree = grower.tree
            for n in open_:
                c = tree.child[n]
                if c >= 0:
                    parent[c] = parent[c + 1] = n
                    for rows in (used, others):
                        mine = rows.pop(n)
                        right = self.goes_right(mine, tree.feature[n], tree.bin[n], tree.missing_left[n])
                        rows[c], rows[c + 1] = mine[~right], mine[right]
        tree = grower.done()
        out, value = np.empty(len(self.key)), {0: tree.value[0]}
        for n in range(1, len(tree.child)):     # below an undone split its node's value holds
            value[n] = tree.value[n] if tree.child[parent[n]] >= 0 else value[parent[n]]
        for rows in (used, others):
            for n, mine in rows.items():
                out[mine] = value[n]
        return tree, out

    def fit(self, m: Settings) -> tuple[list[Tree], np.ndarray, list[float]]:
        """(trees, margins of all rows, held-out loss sum after each round)"""
        held = _held(m, self.folds)
        margin = np.full(len(self.key), base_margin(m))
        trees, loss = [], []
        for r in range(m.rounds):
            tree, value = self.grow(m, r, margin, held)
            trees.append(tree)
            margin = margin + value
            if m.fold is not None:
                loss.append(held_loss(m, self.label[held], margin[held], self.scale))
                if stops(m, loss):
                    break
        return trees, margin, loss


def held_loss(m: Settings, y, margin, scale: float) -> int:
    """Fixed-point sum of the held-out loss."""
    return int(np.rint(losses(m, y, margin) * scale).sum())


def stops(m: Settings, loss: list) -> bool:
    return m.patience is not None and len(loss) - 1 - int(np.argmin(loss)) >= m.patience


def tree_rows(model: int, round_: int, tree: Tree, cuts: list[np.ndarray]) -> list[tuple]:
    """Nodes that can be reached, one row each, numbered level by level."""
    out, nodes = [], [0]
    for k, n in enumerate(nodes):
        f, child = tree.feature[n], -1
        if tree.child[n] >= 0:
            child = len(nodes)
            nodes += [tree.child[n], tree.child[n] + 1]
        # behind the last bin there are missing values only
        cut = None if f < 0 else float(cuts[f][tree.bin[n]]) if tree.bin[n] + 1 < len(cuts[f]) else float("inf")
        out.append((model, round_, k, f, tree.bin[n] if f >= 0 else 0, cut, f >= 0 and tree.missing_left[n], child, tree.value[n], tree.gain[n]))
    return out


def _tree_batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.bool_(), pa.int32(), pa.float64(), pa.float64()]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], NAMES)


def _in_tasks(df: DataFrame, function, schema) -> DataFrame:
    send_package(df.sparkSession)
    return df.mapInArrow(function, schema)


def _alike(models: list[Settings]) -> list[list[int]]:
    """Models that differ in their least child weight only, costly ones first: they share their trees as long as no split is too light for some."""
    groups: dict[Settings, list[int]] = {}
    for i, m in enumerate(models):
        groups.setdefault(replace(m, min_child_weight=0.0), []).append(i)
    return sorted(groups.values(), key=lambda g: -models[g[0]].rounds * models[g[0]].depth)


def _fit_in_tasks(data: Binned, models: list[Settings]) -> DataFrame:
    """One task per group of like models, in the JVM, on rows that its executor holds and that the caller has found to be small."""
    spark = data.rows.sparkSession
    fitted = fit_function(spark, data.files, data.n_rows, data.sizes, data.missing, data.cuts, data.scale, TREE)
    groups = [(k, bytearray(spec([(i, models[i]) for i in g]))) for k, g in enumerate(_alike(models))]
    todo = spark.createDataFrame(groups, "k int, spec binary").repartitionByRange(len(groups), "k")
    return todo.select(F.inline(fitted(F.col("spec"))))


# ---------------------------------------------------------------- fitting: one pass per level

def _pack_task(n_features: int):
    """Binned rows in; packs of at most ``PACK_BYTES`` of bins out, each one row of plain bytes, so that a pass hands a task arrays, not rows."""
    most = max(1, PACK_BYTES // max(1, n_features))

    def pack(t):
        folds = _folds(t["folds"])
        number = int.from_bytes(os.urandom(7), "little")        # written, so a pack keeps it
        columns = [t["key"].to_numpy().astype("<i8").tobytes(), t["label"].to_numpy().astype("<f8").tobytes(), folds.astype("<i4").tobytes(),
                   b"".join(t["bins"].to_pylist()), b""]
        return pa.RecordBatch.from_arrays([pa.array([number]), pa.array([t.num_rows]), *[pa.array([x], pa.binary()) for x in columns]], PACK_NAMES)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part, batch = batch.slice(0, most - n), batch.slice(most - n)
                held.append(part)
                n += part.num_rows
                if n == most:
                    yield pack(pa.Table.from_batches(held))
                    held, n = [], 0
        if held:
            yield pack(pa.Table.from_batches(held))
    return run


PACK = "pack long, n long, key binary, label binary, folds binary, bins binary, margins binary"
PACK_NAMES = [x.split()[0] for x in PACK.split(", ")]


@dataclass
class Pass:
    """What the tasks of one level need.  ``recent``: model -> trees of the rounds from ``stored`` on, which the packs' margins do not hold yet."""
    fit: str
    models: list[Settings]
    sizes: np.ndarray
    missing: np.ndarray
    scale: float
    stored: int = 0
    recent: dict = field(default_factory=dict)
    round_: int = 0
    growing: dict = field(default_factory=dict)     # model -> (tree so far, open nodes)
    losses: tuple = ()                              # models whose held-out loss so far is asked for


_MARGINS: OrderedDict = OrderedDict()       # of a Python worker: (fit, pack) -> {model: (rounds added, margins)}; what is not there is walked again


def _unpacked(p: Pass, row):
    _, n, key, label, folds, bins, _ = row
    folds = np.frombuffer(folds, "<i4").reshape(n, -1) if n else np.zeros((0, 0), np.int32)
    return np.frombuffer(key, "<i8").view(U64), np.frombuffer(label, "<f8"), folds, np.frombuffer(bins, np.uint8).reshape(n, len(p.sizes))


def _margin(p: Pass, row, bins: np.ndarray, i: int) -> np.ndarray:
    """Margins of model ``i`` after all its trees."""
    mine = _MARGINS.setdefault((p.fit, row[0]), {})
    _MARGINS.move_to_end((p.fit, row[0]))
    done, margin = mine.get(i, (-1, None))
    if done < p.stored:
        done = p.stored
        margin = np.frombuffer(row[6], "<f8").reshape(len(p.models), -1)[i] if row[6] else np.full(len(bins), base_margin(p.models[i]))
    for tree in p.recent.get(i, [])[done - p.stored:]:
        margin = margin + np.array(tree.value)[tree.walk(bins)]
        done += 1
    mine[i] = done, margin
    while len(_MARGINS) > 1 and sum(m.nbytes for x in _MARGINS.values() for _, m in x.values()) > KEPT_BYTES:
        _MARGINS.popitem(last=False)
    return margin


def _level_sums(p: Pass, rows):
    """((model, node), (sums of g, sums of h)) of each pack and open node over the drawn features' places; ((model, LOSS), held-out loss)."""
    for row in rows:
        key, label, folds, bins = _unpacked(p, row)
        for i in sorted({*p.growing, *p.losses}):
            m = p.models[i]
            margin, held = _margin(p, row, bins, i), _held(m, folds)
            if i in p.losses:
                yield (i, LOSS), held_loss(m, label[held], margin[held], p.scale)
            if i not in p.growing:
                continue
            tree, open_ = p.growing[i]
            used = np.flatnonzero(rows_drawn(key, m, p.round_) & ~held)
            at = tree.walk(bins)[used]
            order = np.argsort(at, kind="stable")
            at, used = at[order], used[order]
            found = [(node, used[lo:hi]) for node, lo, hi in zip(open_, np.searchsorted(at, open_), np.searchsorted(at, open_, "right")) if hi > lo]
            columns = features_drawn(len(p.sizes), m, p.round_)
            if not found or not len(columns):
                continue
            layout = Layout(p.sizes[columns], p.missing[columns])
            by_row = np.minimum(bins.take(columns, axis=1), p.sizes[columns].astype(np.uint8))      # missing rows behind the last bin
            g, h = gradients(m, label, margin, p.scale)
            for node, mine in found:        # a node at a time: no more than its histogram is held
                hg, hh = sums_by_row(by_row, layout, [mine], g, h)
                yield (i, node), (hg[0], hh[0])


def _level_splits(p: Pass, pairs):
    """The summed histograms' best split of each node, as ``best_splits`` gives it."""
    sums: dict[tuple, object] = {}
    for k, x in pairs:
        if k not in sums:
            sums[k] = x
        elif k[1] == LOSS:
            sums[k] += x
        else:
            for a, b in zip(sums[k], x):
                a += b
    for (i, node), x in sums.items():
        if node == LOSS:
            yield i, node, x
            continue
        columns = features_drawn(len(p.sizes), p.models[i], p.round_)
        layout = Layout(p.sizes[columns], p.missing[columns])
        gain, feature, bin_, left, *rest = (v[0] for v in best_splits(x[0][None], x[1][None], layout, p.models[i], p.scale))
        yield i, node, (float(gain), int(columns[feature]), int(bin_), bool(left), *map(float, rest))


def _spread(k: tuple[int, int]) -> int:
    return k[0] * 31 + k[1] + 1


def _add_margins(p: Pass):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                row = [row[c] for c in PACK_NAMES]
                bins = _unpacked(p, row)[3]
                row[6] = np.stack([_margin(p, row, bins, i) for i in range(len(p.models))]).astype("<f8").tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64() if j < 2 else pa.binary()) for j, x in enumerate(row)], PACK_NAMES)
    return run


def _fit_by_levels(data: Binned, models: list[Settings]) -> DataFrame:
    """One pass of the rows per level, shared by all models still growing.  The packs are kept by the executors between passes; a lost one is
    read from its file again.  A node's histograms meet in one task, which searches them; a row per open node comes back."""
    spark = data.rows.sparkSession
    sc = spark.sparkContext
    tasks = max(1, sc.defaultParallelism)
    rows = data.rows.select("key", "label", "folds", "bins").repartition(tasks)
    packs = write_table(_in_tasks(rows, _pack_task(len(data.cuts)), PACK), "packs")
    now = Pass(uuid.uuid4().hex, models, data.sizes, data.missing, data.scale)
    loss: list[list[float]] = [[] for _ in models]
    stopped: set[int] = set()
    written = []

    def keep(trees):
        if trees:
            written.append(write_table(spark.createDataFrame(trees, TREE), "trees"))
    held = packs.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
    pending, round_ = [], 0
    while True:
        active = [i for i, m in enumerate(models) if round_ < m.rounds and i not in stopped]
        # a model whose rounds are over still needs its last round's loss
        closing = [i for i, m in enumerate(models) if round_ == m.rounds and i not in stopped and m.fold is not None]
        if not active and not closing:
            break
        growers = {i: Grower(models[i]) for i in active}
        depth = 0
        while True:
            busy = [i for i in active if growers[i].open and depth < models[i].depth and i not in stopped]
            asked = tuple(i for i in active + closing if models[i].fold is not None) if not depth and round_ else ()
            if not busy and not asked:
                break
            level = replace(now, round_=round_, growing={i: (growers[i].tree, growers[i].open) for i in busy}, losses=asked)
            meet = min(tasks, len(asked) + sum(len(growers[i].open) for i in busy))
            sums = held.mapPartitions(partial(_level_sums, level)).partitionBy(meet, _spread)
            found: dict[int, dict] = {i: {} for i in busy}
            for i, node, x in sums.mapPartitions(partial(_level_splits, level)).collect():      # a row per open node
                if node == LOSS:
                    loss[i].append(x)
                    if stops(models[i], loss[i]):
                        stopped.add(i)
                else:
                    found[i][node] = x
            for i in busy:
                if i not in stopped:
                    growers[i].level(found[i])
            depth += 1
        for i in active:
            if i in stopped:
                continue
            tree = growers[i].done()
            now.recent.setdefault(i, []).append(tree)
            pending += tree_rows(i, round_, tree, data.cuts)
        round_ += 1
        if round_ - now.stored >= KEEP_ROUNDS or sum(len(t.child) for x in now.recent.values() for t in x) >= KEEP_NODES:
            packs = write_table(_in_tasks(packs, _add_margins(now), PACK), "margins")
            old, held = held, packs.rdd.map(tuple).persist(StorageLevel.MEMORY_AND_DISK)
            old.unpersist()
            now = replace(now, stored=round_, recent={})
            keep(pending)
            pending = []
    held.unpersist()
    pending += [(i, r, LOSS, LOSS, 0, x / data.scale, False, -1, 0.0, 0.0) for i in range(len(models)) for r, x in enumerate(loss[i])]
    keep(pending)
    out = spark.createDataFrame([], TREE)
    for t in written:
        out = out.union(t)
    return out


# ---------------------------------------------------------------- fitted models

@dataclass
class Forest:
    """Trees of fitted models (written), their settings, and the features' names."""
    trees: DataFrame
    models: list[Settings]
    columns: list[str]
    best_round: list[int]

    def arrays(self, models: list[int]) -> dict[int, Stand]:
        """model -> its trees up to the best round as arrays."""
        t = self.trees.where((F.col("node") >= 0) & F.col("model").isin(models)).select("model", "round", "node", "feature", "cut", "missing_left", "child", "value").toArrow()
        model = t["model"].to_numpy()
        order = np.lexsort([t["node"].to_numpy(), t["round"].to_numpy(), model])
        order = order[t["round"].to_numpy()[order] < np.array(self.best_round)[model[order]]]
        col = {n: t[n].to_numpy(zero_copy_only=False)[order] for n in t.column_names}
        model = col["model"]
        return {i: Stand.of({n: x[lo:hi] for n, x in col.items()})
                for i, lo, hi in zip(models, np.searchsorted(model, models), np.searchsorted(model, models, "right"))}

    def parts(self, models: list[int]) -> list[list[int]]:
        """The models in parts of at most ``PART_NODES`` nodes, or of one model."""
        nodes = {r.model: r["count"] for r in self.trees.where("node >= 0").groupBy("model").count().collect()} if len(models) > 1 else {}
        out, size = [[]], 0
        for i in models:
            if out[-1] and size + nodes.get(i, 0) > PART_NODES:
                out.append([])
                size = 0
            out[-1].append(i)
            size += nodes.get(i, 0)
        return out


@dataclass
class Stand:
    """A model's trees side by side: a row goes down all of them at once.  A leaf's child is itself."""
    roots: np.ndarray
    depth: int
    feature: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    child: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(col: dict) -> Stand:
        """Of tree rows sorted by round and node."""
        n = len(col["round"])
        starts = np.flatnonzero(np.r_[True, col["round"][1:] != col["round"][:-1]]) if n else np.zeros(0, np.int64)
        size = np.maximum.reduceat(np.maximum(col["node"], col["child"] + 1), starts) + 1 if n else starts
        roots = np.cumsum(size) - size
        at = np.repeat(roots, np.diff(np.r_[starts, n])) + col["node"]
        total = int(size.sum())
        out = Stand(roots, 0, np.zeros(total, np.int32), np.full(total, np.inf), np.ones(total, bool), np.arange(total), np.zeros(total))
        inner = col["child"] >= 0
        some = at[inner]
        out.feature[some], out.cut[some], out.missing_left[some] = col["feature"][inner], col["cut"][inner], col["missing_left"][inner]
        out.child[some] = (at - col["node"] + col["child"])[inner]
        out.value[at] = col["value"]
        below = roots
        while len(below := below[out.child[below] != below]):
            below = np.r_[out.child[below], out.child[below] + 1]
            out.depth += 1
        return out

    def margins(self, x: np.ndarray, start: float) -> np.ndarray:
        """Start plus the values of each row's leaves, added in the order of the rounds."""
        out = np.full(len(x), start)
        step = max(1, CHUNK // max(1, len(self.roots)))
        for lo in range(0, len(x) if len(self.roots) else 0, step):
            part = x[lo:lo + step]
            at = np.tile(self.roots, (len(part), 1))
            rows = np.arange(len(part))[:, None]
            for _ in range(self.depth):
                v = part[rows, self.feature[at]]
                right = v > self.cut[at]
                right |= np.isnan(v) & ~self.missing_left[at]
                at = self.child[at] + right
            out[lo:lo + step] = np.cumsum(np.c_[out[lo:lo + step], self.value[at]], axis=1)[:, -1]
        return out


def held_out_loss(forest: Forest) -> DataFrame:
    """(model, round, loss): summed held-out loss after each round, of the models that leave a fold out."""
    return forest.trees.where(F.col("node") == LOSS).select("model", "round", F.col("cut").alias("loss"))


def _best_rounds(trees: DataFrame) -> dict[int, int]:
    least = trees.where(F.col("node") == LOSS).groupBy("model").agg(F.min(F.struct("cut", "round")).alias("x"))
    return {r.model: r.round + 1 for r in least.select("model", "x.round").collect()}


def fit(data: Binned, models: list[Settings], columns: list[str], small_bytes: int | None = None) -> Forest:
    """Fit all models on the same binned rows.  ``best_round``: rounds after which the held-out loss was least (all rounds
    for a model without a held-out fold or without ``patience``).  Rows of at most ``small_bytes`` of bins (None: ``SMALL_BYTES`` or a
    quarter of an executor's heap, whichever is more) are held by the executors whole."""
    if not models:
        raise ValueError("no models")
    if small_bytes is None:
        small_bytes = max(SMALL_BYTES, executor_heap(data.rows.sparkSession) // 4)
    small = data.n_rows * max(1, np.count_nonzero(data.sizes + data.missing > 1)) <= small_bytes     # of constant features no bins are held
    trees = write_table((_fit_in_tasks if small else _fit_by_levels)(data, models), "trees")
    best = _best_rounds(trees)
    best = [best.get(i, m.rounds) if m.patience is not None else m.rounds for i, m in enumerate(models)]
    return Forest(trees, models, list(columns), best)


def predict(forest: Forest, rows: DataFrame, models=(0,), vector: str = "features", folds: tuple = ()) -> DataFrame:
    """``rows`` (array<double> ``vector``) once per model with columns model, margin, prediction: the probability of label 1
    for a logistic model, else the predicted value.  The vector column is dropped.  With ``folds`` (the fold columns, as
    binned) a model gets only the rows that it left out.  Many models are worked through in parts, whose results are written, so
    that neither the driver nor a worker holds all their trees."""
    parts = forest.parts(list(models))
    if len(parts) == 1:
        return _predicted(forest, rows, parts[0], vector, folds)[0]
    rows, written = write_table(rows, "to-score"), []
    for part in parts:
        out, shared = _predicted(forest, rows, part, vector, folds)
        written.append(write_table(out, "scored"))
        shared.destroy()
    return reduce(DataFrame.unionAll, written)


def _predicted(forest: Forest, rows: DataFrame, models: list[int], vector: str, folds: tuple):
    """(``predict`` of models whose trees are sent out at once, what was sent)"""
    settings = forest.models
    shared = rows.sparkSession.sparkContext.broadcast(forest.arrays(models))
    keep = [c for c in rows.columns if c != vector]
    where = rows.columns.index(vector)
    schema = T.StructType([*[rows.schema[c] for c in keep], T.StructField("model", T.IntegerType()), T.StructField("margin", T.DoubleType()),
                           T.StructField("prediction", T.DoubleType())])
    others = [i for i, c in enumerate(rows.columns) if c != vector]
    fold_at = [rows.columns.index(c) for c in folds]

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(where))
            for i in models:
                m, part, v = settings[i], batch, x
                if fold_at:
                    mine = batch.column(fold_at[m.fold_of]).to_numpy(zero_copy_only=False) == m.fold
                    part, v = batch.filter(pa.array(mine)), x[mine]
                margin = shared.value[i].margins(v, base_margin(m))
                p = 1.0 / (1.0 + np.exp(-margin)) if m.logistic else margin
                yield pa.RecordBatch.from_arrays([*[part.column(j) for j in others], pa.array(np.full(len(v), i, np.int32)), pa.array(margin), pa.array(p)],
                                                 schema.names)
    return _in_tasks(rows, run, schema), shared


def importances(forest: Forest, model: int = 0) -> DataFrame:
    """(idx, feature, importance): each feature's share of the model's total gain over its splits; 0 for unused ones."""
    spark = forest.trees.sparkSession
    names = spark.createDataFrame([(i, c) for i, c in enumerate(forest.columns)], "idx int, feature string")
    kept = F.col("round") < forest.best_round[model]
    gain = forest.trees.where((F.col("model") == model) & (F.col("child") >= 0) & kept).groupBy(F.col("feature").alias("idx")).agg(F.sum("gain").alias("gain"))
    total = gain.agg(F.sum("gain")).scalar()
    return names.join(gain, "idx", "left").select("idx", "feature", F.coalesce(F.try_divide("gain", total), F.lit(0.0)).alias("importance"))


def save(forest: Forest, path: str, extra: dict | None = None) -> str:
    """Trees, settings, feature names and ``extra`` (anything JSON holds) under ``path``."""
    spark = forest.trees.sparkSession
    forest.trees.write.mode("overwrite").parquet(f"{path}/trees")
    about = {"models": [asdict(m) for m in forest.models], "columns": forest.columns, "best_round": forest.best_round, "extra": extra or {}}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
    return path


def load(spark: SparkSession, path: str) -> tuple[Forest, dict]:
    about = json.loads(spark.read.text(f"{path}/about").first().value)
    return (Forest(spark.read.schema(TREE).parquet(f"{path}/trees"), [Settings(**m) for m in about["models"]], about["columns"], about["best_round"]),
            about["extra"])
