"""One-hot collapses of the card job: per client, the amount-weighted (or
amount-share-weighted) sum of each row's one-hot vector, and the
element-wise sum of numeric lists.

A sum of one-hot vectors weighted by amount is a conditional sum per index,
so it is computed as a sum per label and a pivot on the frequency-ordered index (the encoder's
order; the least frequent label gets no column, as with ``dropLast``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlens.operators.encoding import coded_sums, collapse_long
from cardlens.operators.pivots import TOTAL

KEY = "cl_id"


def onehot_collapse(tx: DataFrame, dims: list[tuple[str, str]], value: str = "amount",
                    share: bool = False, drop_last: bool = True) -> DataFrame:
    """Columns ``{prefix}{i}`` = sum of ``value`` over rows whose ``col`` has
    encoder index i (frequency descending, then text), divided by the client's
    total when ``share``.  The log is read once for all columns: it is summed by (client, label), and labels are counted,
    numbered and joined on those sums.  Only the numbers of labels, and so of columns, reach the driver
    (``encoding.onehot_vectors`` is the form for any number of them)."""
    return onehot_collapse_mixed(tx, dims, [p for p, _ in dims] if share else [], value, drop_last)


def onehot_collapse_mixed(tx: DataFrame, dims: list[tuple[str, str]], share: list[str], value: str = "amount", drop_last: bool = True) -> DataFrame:
    """``onehot_collapse`` with shares for the prefixes in ``share`` only."""
    sums, codes = collapse_long(tx, dims, value)
    cut = 1 if drop_last else 0
    sizes = {r.family: r.size - cut for r in codes.groupBy("family").agg(F.first("size").alias("size")).collect()}
    coded = coded_sums(sums, codes, {i for i, (p, _) in enumerate(dims) if p in set(share)}, drop_last)
    prefix = F.get(F.array(*[F.lit(p) for p, _ in dims]), F.col("family"))
    rows = coded.select(KEY, F.concat(prefix, F.col("code").cast("string")).alias("label"), "x").union(
        sums.where("family = -1").select(KEY, F.lit(TOTAL), F.lit(0.0)))
    labels = [f"{p}{j}" for i, (p, _) in enumerate(dims) for j in range(sizes.get(i, 0))]
    wide = rows.groupBy(KEY).pivot("label", [TOTAL, *labels]).agg(F.first("x"))
    return wide.select(KEY, *[F.coalesce(F.col(f"`{c}`"), F.lit(0.0)).alias(c) for c in labels])


def elementwise_sum(df: DataFrame, key: str, arr: str, out: str = "vec_sum", digits: int = 4) -> DataFrame:
    """Element-wise sum of numeric lists per key; ragged lists sum the
    elements present at each position.  The lists are exploded with their
    position and summed per (key, position), so a hot key is spread over
    tasks; only the final per-key vector (one entry per position) is
    assembled in one place."""
    e = df.select(key, F.posexplode(arr).alias("pos", "x"))
    s = e.groupBy(key, "pos").agg(F.round(F.sum(F.col("x").cast("double")), digits).alias("s"))
    return s.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("pos", "s"))).alias("_p")) \
        .select(key, F.col("_p.s").alias(out))

