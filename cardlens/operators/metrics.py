"""Target transforms, splits and evaluation metrics as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.operators.dictionary import code_table, with_code
from cardlens.session import ensure_checkpoint_dir


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def log_target(c) -> Column:
    """log(x + 1), rounded to 6 places."""
    return F.round(F.log1p(_c(c).cast("double")), 6)


def unlog_clip(p) -> Column:
    """exp(p) - 1, negative values clipped to 0."""
    return F.greatest(F.expm1(_c(p)), F.lit(0.0))


def with_global_stats(df: DataFrame, col: str) -> DataFrame:
    """Attach the column's global min and max to every row: a one-row
    aggregate used as a scalar subquery (evaluated once, no join)."""
    st = df.agg(F.struct(F.min(col).alias("mn"), F.max(col).alias("mx"))).scalar()
    return df.withColumns({"_mn": st.getField("mn"), "_mx": st.getField("mx")})


def minmax_scale(df: DataFrame, col: str, out: str) -> DataFrame:
    j = with_global_stats(df, col)
    scaled = F.try_divide(F.col(col) - F.col("_mn"), F.col("_mx") - F.col("_mn"))
    return j.withColumn(out, F.round(scaled, 6)).drop("_mn", "_mx")


def hash_folds(df: DataFrame, key: str, k: int, seed: int = 0, out: str = "fold") -> DataFrame:
    """Deterministic fold of each key: the first 32 bits of md5('key:seed') modulo
    ``k``, the same in any engine and on any re-run.  Another seed gives
    another partition.  A NULL key has fold 0."""
    h = F.conv(F.substring(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), 1, 8), 16, 10).cast("long")
    return df.withColumn(out, F.coalesce(h % k, F.lit(0)).cast("int"))


def string_index(df: DataFrame, col: str, out: str) -> DataFrame:
    """Frequency-ordered index (ties by label text); rows with a missing value
    are skipped.  The index is a table joined on the value."""
    return with_code(df.where(F.col(col).isNotNull()), col, out, code_table(df, col, by_frequency=True))


def roc_auc(df: DataFrame, label: str, score: str, partitions: int | None = None) -> DataFrame:
    """Exact ROC AUC (ties count one half) as a one-row DataFrame.

    Counts are first aggregated per distinct score; the distinct scores are
    range-partitioned by score and checkpointed (so every task agrees on the
    partition of each score), per-partition negative totals are prefix-summed
    over the partitions (one row each), and the within-partition prefix sums
    run per partition.  No step holds more than one range partition.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    is_pos = (F.col(label) == 1).cast("long")
    g = df.groupBy(score).agg(F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg"))
    g = g.repartitionByRange(n, score).withColumn("pid", F.spark_partition_id()).checkpoint()
    totals = g.groupBy("pid").agg(F.sum("neg").alias("pneg"))
    offs = totals.select("pid", F.coalesce(F.sum("pneg").over(
        Window.orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    j = g.join(F.broadcast(offs), "pid")
    within = F.coalesce(F.sum("neg").over(
        Window.partitionBy("pid").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    j = j.withColumn("below", F.col("off") + within)
    auc = F.try_divide(F.sum(F.col("pos") * (F.col("below") + 0.5 * F.col("neg"))),
                       (F.sum("pos") * F.sum("neg")).cast("double"))
    return j.agg(F.round(auc, 9).alias("auc"))


def roc_auc_by(df: DataFrame, key: str, label: str, score: str, partitions: int | None = None) -> DataFrame:
    """(key, auc): ``roc_auc`` of every key's rows.  Distinct scores are ranged by (key, score), so a
    key with most of the rows is cut like the single one; NULL where a key has one label only."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    is_pos = (F.col(label) == 1).cast("long")
    g = df.groupBy(key, score).agg(F.sum(is_pos).alias("pos"), F.sum(1 - is_pos).alias("neg"))
    g = g.repartitionByRange(n, key, score).withColumn("pid", F.spark_partition_id()).checkpoint()
    # a row per key and range: the negatives of the key's ranges before it
    totals = g.groupBy(key, "pid").agg(F.sum("neg").alias("pneg"))
    offs = totals.select(key, "pid", F.coalesce(F.sum("pneg").over(
        Window.partitionBy(key).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("off"))
    within = F.coalesce(F.sum("neg").over(
        Window.partitionBy(key, "pid").orderBy(score).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    j = g.withColumn("within", within).join(offs, [key, "pid"]).withColumn("below", F.col("off") + F.col("within"))
    auc = F.try_divide(F.sum(F.col("pos") * (F.col("below") + 0.5 * F.col("neg"))),
                       (F.sum("pos") * F.sum("neg")).cast("double"))
    return j.groupBy(key).agg(F.round(auc, 9).alias("auc"))


def rmse(df: DataFrame, pred: str, y: str) -> DataFrame:
    return df.agg(F.round(F.sqrt(F.avg(F.pow(F.col(pred) - F.col(y), 2))), 6).alias("rmse"))


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram between the global min and max; the maximum
    falls in the last bin."""
    j = with_global_stats(df, col)
    frac = F.try_divide(F.col(col) - F.col("_mn"), F.col("_mx") - F.col("_mn"))
    b = F.least(F.floor(frac * bins) + 1, F.lit(bins))
    return j.select(b.cast("int").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
