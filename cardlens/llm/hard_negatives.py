"""Hard negatives by threshold joins with norm bounds (L2AP).

Rows are packed into blocks, and each block of anchors meets each block of rows as one pair of matrices, so
a task holds a few bounded blocks however many rows there are.  In a pair of blocks:

* Dimensions stand in one global order, the strongest first.  A row's trailing dimensions whose norm, times the
  norm of any anchor's trailing dimensions, stays below that anchor's threshold are left out of the inverted index.
* Partial scores are accumulated over the index.  A pair whose partial score plus the product of the remaining
  norms stays below the threshold is dropped; survivors are scored in full.
* A window (the best ``k`` rows of a score range) starts with a high threshold, which is lowered until the window has
  ``k`` rows above it or the range ends; from then on its k-th score is the threshold for further blocks.

Bounds only ever rule out, so results are exact.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import in_tasks, write_table

BLOCK_ROWS = 4096
ANCHOR_ROWS = 256
BLOCK_BYTES = 4 << 20
GROUP = 8               # dimensions indexed at a time
START, FALL, STEPS = 0.9, 0.7, 8        # thresholds of an open window: START, START * FALL, ... of the largest score possible
CLOSE, CLOSE_STEPS = 0.05, 4            # and of a window with both ends: its range in CLOSE_STEPS parts
SLACK = 1e-9            # of the norms' product: more than rounding can take

_BLOCK = "block long, n int, dim int, ids binary, labels binary, matrix binary, windows binary"
_NAMES = [x.split()[0] for x in _BLOCK.split(", ")]


@dataclass
class Block:
    ids: np.ndarray
    labels: np.ndarray
    matrix: np.ndarray      # rows x dimensions, whole numbers as doubles
    windows: np.ndarray     # of anchors: (positive id, positive score) pairs, rows x k x 2


def pack(row_limit: int, k: int):
    """(vec_id, label, vector, windows) rows into blocks.  Shorter vectors are filled up with zeros."""
    def run(batches):
        held, width, number = [], 0, 0

        def block():
            matrix = np.zeros((len(held), width))
            for i, (_, _, v, _) in enumerate(held):
                matrix[i, :len(v)] = v
            small = np.abs(matrix).max(initial=0) <= 1 << 24     # exact in single precision
            windows = np.zeros((len(held), k, 2), np.int64)
            windows[:, :, 1] = -1
            for i, (*_, w) in enumerate(held):
                for j, x in enumerate(w or ()):
                    windows[i, j] = x["id"], x["score"]
            column = lambda j: np.array([h[j] for h in held], "<i8").tobytes()
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([len(held)], pa.int32()), pa.array([width], pa.int32()), pa.array([column(0)], pa.binary()),
                 pa.array([column(1)], pa.binary()), pa.array([matrix.astype("<f4" if small else "<f8").tobytes()], pa.binary()),
                 pa.array([windows.tobytes()], pa.binary())], _NAMES)
        for batch in batches:
            vectors = batch.column(2)
            at = vectors.offsets.to_numpy() - vectors.offsets[0].as_py()
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            for i, key, label, w in zip(range(len(vectors)), batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                v = flat[at[i]:at[i + 1]]
                if held and (len(held) >= row_limit or max(width, len(v)) * (len(held) + 1) * 8 > BLOCK_BYTES):
                    yield block()
                    held, width, number = [], 0, number + 1
                held.append((key, label, v, w))
                width = max(width, len(v))
        if held:
            yield block()
    return run


def unpack(n: int, dim: int, ids: bytes, labels: bytes, matrix: bytes, windows: bytes, order: np.ndarray) -> Block:
    m = np.frombuffer(matrix, "<f4" if len(matrix) == 4 * n * dim else "<f8").reshape(n, dim).astype(np.float64)
    full = np.zeros((n, len(order)))
    full[:, :dim] = m
    w = np.frombuffer(windows, "<i8").reshape(n, -1, 2) if n else np.zeros((0, 1, 2), np.int64)
    return Block(np.frombuffer(ids, "<i8"), np.frombuffer(labels, "<i8"), full[:, order], w)


def suffix_norms(m: np.ndarray) -> np.ndarray:
    """Norm of each row's dimensions from GROUP * g on, for each g (a last column of zeros)."""
    groups = -(-m.shape[1] // GROUP)
    squares = np.zeros((len(m), groups + 1))
    for g in range(groups):
        squares[:, g] = np.square(m[:, g * GROUP:(g + 1) * GROUP]).sum(axis=1)
    return np.sqrt(np.cumsum(squares[:, ::-1], axis=1)[:, ::-1])


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Whole-number inner products, row by row."""
    if not len(q):
        return np.zeros(0, np.int64)
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < 2 ** 53:
        return np.einsum("ij,ij->i", q, x).astype(np.int64)
    big = np.frompyfunc(int, 1, 1)
    return np.array([int((big(a) * big(b)).sum()) for a, b in zip(q, x)], np.int64)     # raises beyond 64 bits


def indexed_groups(q_norms: np.ndarray, x_norms: np.ndarray, room: np.ndarray) -> np.ndarray:
    """How many leading groups of each row go into the index: behind them, no anchor's ``room`` (its threshold,
    less rounding) is within reach.  Thresholds of 0 or less rule nothing out."""
    groups = x_norms.shape[1] - 1
    if not (room > 0).all():
        return np.full(len(x_norms), groups)
    covered = x_norms * (q_norms / room).max(axis=0) < 1
    covered[:, groups] = True
    return covered.argmax(axis=1)


def threshold_pairs(q: np.ndarray, q_norms: np.ndarray, x: np.ndarray, x_norms: np.ndarray,
                    least: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, row, score) of all pairs with score >= least[anchor]."""
    none = np.zeros(0, np.int64)
    if not len(q) or not len(x):
        return none, none, none
    groups = x_norms.shape[1] - 1
    room = least[:, None] - SLACK * q_norms[:, :1] * x_norms[:, 0].max()    # what a bound must reach
    cut = indexed_groups(q_norms, x_norms, room)
    rows = np.argsort(-cut, kind="stable")
    if (room > 0).all():
        rows = rows[:int((cut > 0).sum())]      # the others are out of every anchor's reach
    x, x_norms, cut = x[rows], x_norms[rows], cut[rows]
    partial = np.zeros((len(q), len(rows)))
    checks = {-(-groups // 4), -(-groups // 2), -(-3 * groups // 4)} - {groups}
    for g in range(groups):
        listed = int(np.searchsorted(-cut, -g))             # rows with this group in the index
        if not listed:
            break
        d = slice(g * GROUP, (g + 1) * GROUP)
        partial[:, :listed] += q[:, d] @ x[:listed, d].T
        if g + 1 in checks:
            bound = partial + q_norms[:, g + 1, None] * x_norms[None, :, g + 1]
            # a row out of the index by now has all its dimensions from its cut on left
            early = np.flatnonzero(cut <= g)
            if len(early):
                bound[:, early] = partial[:, early] + q_norms[:, cut[early]] * x_norms[early, cut[early]][None, :]
            alive = (bound >= room).any(axis=0)
            if alive.mean() < 0.7:
                rows, x, x_norms, cut, partial = rows[alive], x[alive], x_norms[alive], cut[alive], partial[:, alive]
    rest = q_norms[:, cut] * x_norms[np.arange(len(cut)), cut][None, :]
    a, b = np.nonzero(partial + rest >= room)
    scores = np.concatenate([none, *(exact_scores(q[a[i:i + 65536]], x[b[i:i + 65536]]) for i in range(0, len(a), 65536))])
    keep = scores >= least[a]
    return a[keep], rows[b[keep]], scores[keep]


class Windows:
    """The best ``k`` (score, id) of each window, scores falling, ids rising among equals."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.owner, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.n = n

    def add(self, owner, score, ids) -> None:
        o, s, i = np.concatenate([self.owner, owner]), np.concatenate([self.score, score]), np.concatenate([self.id, ids])
        order = np.lexsort((i, -s, o))
        o, s, i = o[order], s[order], i[order]
        again = np.zeros(len(o), bool)
        again[1:] = (o[1:] == o[:-1]) & (i[1:] == i[:-1]) & (s[1:] == s[:-1])   # found at a higher threshold before
        o, s, i = o[~again], s[~again], i[~again]
        rank = np.arange(len(o)) - np.searchsorted(o, o)
        self.owner, self.score, self.id = o[rank < self.k], s[rank < self.k], i[rank < self.k]

    def last(self) -> np.ndarray:
        """Score of each window's k-th row, -inf where there are fewer."""
        out = np.full(self.n, -np.inf)
        full = np.flatnonzero(np.bincount(self.owner, minlength=self.n) == self.k)
        out[full] = self.score[np.searchsorted(self.owner, full, "right") - 1]
        return out


def search_positives(anchors: Block, rows: Block, found: Windows) -> None:
    """Add the best rows of each anchor's own label."""
    for label in np.unique(anchors.labels):
        mine, theirs = np.flatnonzero(anchors.labels == label), np.flatnonzero(rows.labels == label)
        if not len(theirs):
            continue
        q, x = anchors.matrix[mine], rows.matrix[theirs]
        qn, xn = suffix_norms(q), suffix_norms(x)
        top = qn[:, 0] * xn[:, 0].max()
        for step in range(STEPS + 1):
            floor = np.maximum(found.last()[mine], top * START * FALL ** step if step < STEPS else -np.inf)
            a, b, score = threshold_pairs(q, qn, x, xn, floor)
            other = anchors.ids[mine[a]] != rows.ids[theirs[b]]
            found.add(mine[a[other]], score[other], rows.ids[theirs[b[other]]])
            open_ = found.last()[mine] < floor
            if not open_.any():
                break
            mine, q, qn, top = mine[open_], q[open_], qn[open_], top[open_]


def search_negatives(anchors: Block, rows: Block, low: np.ndarray, found: Windows) -> None:
    """Add the best rows of another label within each window (an anchor's j-th is number anchor * k + j)."""
    k = anchors.windows.shape[1]
    high = anchors.windows[:, :, 1].reshape(-1).astype(np.float64)
    low = low.reshape(-1).astype(np.float64)
    used = np.flatnonzero(high >= low)
    xn = suffix_norms(rows.matrix)
    for step in range(1, CLOSE_STEPS + 2):
        if not len(used):
            return
        floor = np.maximum(found.last()[used], np.maximum(low[used], high[used] * (1 - CLOSE * step)) if step <= CLOSE_STEPS else low[used])
        mine, at = np.unique(used // k, return_inverse=True)
        least = np.full(len(mine), np.inf)
        np.minimum.at(least, at, floor)
        q = anchors.matrix[mine]
        a, b, score = threshold_pairs(q, suffix_norms(q), rows.matrix, xn, least)
        apart = anchors.labels[mine[a]] != rows.labels[b]
        a, b, score = a[apart], b[apart], score[apart]
        for j in range(k):          # an anchor's pairs go to each of its windows that they lie in
            w = mine[a] * k + j
            inside = (score <= high[w]) & (score >= low[w])
            found.add(w[inside], score[inside], rows.ids[b[inside]])
        used = used[(found.last()[used] < floor) & (floor > low[used])]


def _runs(order: np.ndarray, k: int, low: int | None):
    """Joined blocks in (anchor block first); the best rows of each anchor (``low`` None) or window out."""
    def run(batches):
        name, anchors, lows, found = None, None, None, None

        def rows():
            if low is None:
                return pa.RecordBatch.from_arrays([pa.array(anchors.ids[found.owner]), pa.array(found.id), pa.array(found.score)],
                                                  ["anchor_id", "positive_id", "positive_score"])
            a, j = found.owner // k, found.owner % k
            w = anchors.windows[a, j]
            return pa.RecordBatch.from_arrays([pa.array(anchors.ids[a]), pa.array(w[:, 0]), pa.array(w[:, 1]), pa.array(found.id), pa.array(found.score)],
                                              ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])
        for batch in batches:
            for r in batch.to_pylist():
                if r["a_name"] != name:
                    if name is not None:
                        yield rows()
                    name = r["a_name"]
                    anchors = unpack(*(r[f"a_{c}"] for c in _NAMES[1:]), order)
                    score = anchors.windows[:, :, 1]
                    lows = None if low is None else np.where(score < 0, score + 1, low * (score // 100) + -(-low * (score % 100) // 100))
                    found = Windows(len(anchors.ids) * (1 if low is None else k), k)
                block = unpack(*(r[c] for c in _NAMES[1:]), order)
                if low is None:
                    search_positives(anchors, block, found)
                else:
                    search_negatives(anchors, block, lows, found)
        if name is not None:
            yield rows()
    return run


def _meet(anchors: DataFrame, blocks: DataFrame, parts: int) -> DataFrame:
    """Each block of anchors with each block of rows: rows are dealt to parts, anchors go to every part.  By merging: a broadcast
    (Spark sizes it by the written blocks, before their copies) would collect all copies of all anchors on the driver."""
    named = anchors.select(F.monotonically_increasing_id().alias("a_name"), *[F.col(c).alias(f"a_{c}") for c in _NAMES[1:]])
    sent = write_table(named, "anchor_blocks").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    dealt = blocks.select(F.pmod(F.xxhash64("ids"), F.lit(parts)).cast("int").alias("part"), *_NAMES[1:])
    return sent.hint("merge").join(dealt, "part").drop("part")


def valid_rows(rows: DataFrame, scale: int, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(vec_id, label, vector of whole numbers), one row per id."""
    x = rows.select(rows[id_col].cast("long").alias("vec_id"), rows[label_col].cast("long").alias("label"),
                    rows[vector_col].cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    x = x.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)
    x = x.groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("x")).select("vec_id", "x.label", "x.vector")
    # as doubles: Spark's own floor gives a long and fails beyond its range
    whole = lambda v: F.when(F.abs(v * scale) < 2.0 ** 53, F.floor(v * scale).cast("double")).otherwise(v * scale)
    return x.withColumn("vector", F.transform("vector", whole))


def hard_negatives(rows: DataFrame, every: int = 100, k: int = 5, low: int = 80, scale: int = 256, id_col: str = "vec_id",
                   label_col: str = "label", vector_col: str = "embedding") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with a null id, a null label, a null vector, or a null or non-finite component take no part.  Components are
    ``floor(scale * x)``; scores are inner products (whole numbers; one beyond 64 bits fails).  Anchors are
    rows whose id ``every`` divides.  An anchor's positives are its best ``k`` other rows of its label; for each, the best ``k``
    rows of other labels with ``low`` % to 100 % of the positive's score are returned.  Higher scores come first, ties by smaller id.

    Of several rows with one id the smallest (label, vector) counts, so repeated rows count once.  An empty vector scores 0;
    shorter vectors count as filled up with zeros.  An empty table gives an empty result; other columns are not read.
    """
    spark = rows.sparkSession
    valid = write_table(valid_rows(rows, scale, id_col, label_col, vector_col), "vectors")
    nothing = F.lit(None).cast("array<struct<id: long, score: long>>").alias("windows")
    plain = valid.select("vec_id", "label", "vector", nothing)
    blocks = write_table(in_tasks(plain, pack(BLOCK_ROWS, 1), _BLOCK), "blocks")
    count, total, dim = blocks.agg(F.count(F.lit(1)), F.sum("n"), F.max("dim")).first()
    parts = max(1, min(count, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    groups = max(1, -(-(total or 0) // (every * ANCHOR_ROWS)))
    # one number per dimension reaches the driver
    energy = np.zeros(max(1, dim or 0))
    for d, e in in_tasks(blocks.select("n", "dim", "matrix"), _energy, "d int, energy double").groupBy("d").agg(F.sum("energy")).collect():
        energy[d] = e
    order = np.argsort(-energy, kind="stable")

    chosen = plain.where(F.col("vec_id") % every == 0)
    anchors = in_tasks(chosen.repartition(groups), pack(ANCHOR_ROWS, 1), _BLOCK)
    found = in_tasks(_meet(anchors, blocks, parts), _runs(order, k, None), "anchor_id long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    positives = write_table(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= k), "positives")

    windows = positives.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))
                                                 .alias("windows"))      # k at most
    anchors = in_tasks(chosen.drop("windows").hint("merge").join(windows, F.col("vec_id") == F.col("anchor_id")).select("vec_id", "label", "vector", "windows")
                       .repartition(groups), pack(ANCHOR_ROWS, k), _BLOCK)
    found = in_tasks(_meet(anchors, blocks, parts), _runs(order, k, low),
                     "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    best = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _energy(batches):
    for batch in batches:
        for r in batch.to_pylist():
            m = np.frombuffer(r["matrix"], "<f4" if len(r["matrix"]) == 4 * r["n"] * r["dim"] else "<f8").reshape(r["n"], r["dim"])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(r["dim"], dtype=np.int32)), pa.array(np.square(m, dtype=np.float64).sum(axis=0))],
                                             ["d", "energy"])
