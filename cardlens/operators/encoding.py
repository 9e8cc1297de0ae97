"""Encoders as written code tables, and sparse vectors aggregated from long rows.

One long pass counts the labels of all columns; one table (family, value, code, size) numbers them: by falling
frequency, ties by text, the last one without a place (``dropLast``).  No label reaches the driver, so columns may have any
number of them.  Vectors are built from (key, feature index, value) rows, so a plan does not grow with the features.
"""

from __future__ import annotations

import json

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens.functions.stats import safe_div
from cardlens.session import scratch_path, write_table

KEY = "cl_id"


def number(counts: DataFrame, order: list[Column] | None = None) -> DataFrame:
    """(family, value, code, size), written: the 0-based place of each (family, value) of ``counts`` (family, value, n)
    within its family, by falling n and then value unless ``order`` says otherwise, and the family's size.  Values are
    range-partitioned and numbered per partition after the partitions before; no task holds a whole family."""
    order = order or [F.desc("n"), F.asc("value")]
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = write_table(counts.repartitionByRange(parts, "family", *order).withColumn("_part", F.spark_partition_id()), "labels")
    sizes = g.groupBy("family", "_part").agg(F.count(F.lit(1)).alias("_here"))      # a row per family and partition
    whole = Window.partitionBy("family")
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("family", "_part", F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_first"),
                         F.sum("_here").over(whole).cast("int").alias("size"))
    place = F.row_number().over(Window.partitionBy("family", "_part").orderBy(*order))
    return write_table(g.withColumn("_place", place).join(sizes, ["family", "_part"])
                       .select("family", "value", (F.col("_first") + F.col("_place") - 1).cast("int").alias("code"), "size"), "codes")


# ---------------------------------------------------------------- row encoders

class Encoder:
    """Fitted one-hot encoders of several columns."""

    def __init__(self, columns: list[str], codes: DataFrame):
        self.columns, self.codes = list(columns), codes

    def transform(self, rows: DataFrame, suffix: str = "_vec") -> DataFrame:
        """``rows`` with an array<double> ``{column}{suffix}`` per column.  Rows with a missing or unseen label are left out.
        Each lookup is Spark's size-based choice: small code tables are broadcast, large ones shuffled."""
        for i, c in enumerate(self.columns):
            own = self.codes.where(F.col("family") == i).select(F.col("value").alias("_value"), F.col("code").alias("_code"), F.col("size").alias("_size"))
            hot = F.transform(F.sequence(F.lit(0), F.col("_size") - 2), lambda j: (j == F.col("_code")).cast("double"))
            rows = (rows.join(own, F.col(c).cast("string") == F.col("_value"))
                    .withColumn(f"{c}{suffix}", F.when(F.col("_size") > 1, hot).otherwise(F.array().cast("array<double>")))
                    .drop("_value", "_code", "_size"))
        return rows

    def save(self, path: str) -> str:
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        self.codes.sparkSession.createDataFrame([(json.dumps(self.columns),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/columns")
        return path

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> Encoder:
        return cls(json.loads(spark.read.text(f"{path}/columns").first().value), spark.read.parquet(f"{path}/codes"))


def fit_encoder(rows: DataFrame, columns: list[str]) -> Encoder:
    """One pass for all columns.  A row with a missing label counts for the columns before that one only (encoders fitted
    one after another see the rows that those before have kept)."""
    entries, present = [], F.lit(True)
    for i, c in enumerate(columns):
        present = present & F.col(c).isNotNull()
        entries.append(F.when(present, F.struct(F.lit(i).alias("family"), F.col(c).cast("string").alias("value"))))
    counts = (rows.select(F.explode(F.array(*entries)).alias("e")).where("e is not null")
              .groupBy("e.family", "e.value").agg(F.count(F.lit(1)).alias("n")))
    return Encoder(columns, number(counts))


# ---------------------------------------------------------------- collapsed vectors

def collapse_long(rows: DataFrame, dims: list[tuple[str, str]], value: str = "amount", key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(sums, codes): sums (key, family, value, s) with the sum of ``value`` per key and label of each (prefix, column), all in one
    pass, family -1 holding the key's total; codes as ``number`` gives them, counted from the same aggregate."""
    v = F.col(value)
    entry = lambda i, label: F.struct(F.lit(i).alias("family"), label.alias("value"), v.alias("v"))
    entries = [entry(-1, F.lit(None).cast("string"))]
    entries += [F.when(F.col(c).isNotNull(), entry(i, F.col(c).cast("string"))) for i, (_, c) in enumerate(dims)]
    sums = write_table(rows.select(key, F.explode(F.array(*entries)).alias("e")).where("e is not null")
                       .groupBy(key, "e.family", "e.value").agg(F.sum("e.v").alias("s"), F.count(F.lit(1)).alias("n")), "collapsed")
    codes = number(sums.where("family >= 0").groupBy("family", "value").agg(F.sum("n").alias("n")))
    return sums.drop("n"), codes


def coded_sums(sums: DataFrame, codes: DataFrame, shares: set[int], drop_last: bool = True, key: str = KEY) -> DataFrame:
    """(key, family, code, x): the sums by code, over the key's total for families in ``shares``."""
    last = F.col("code") < F.col("size") - (1 if drop_last else 0)
    x = F.col("s").cast("double")
    out = sums.where("family >= 0").join(codes.where(last), ["family", "value"])
    if shares:
        total = sums.where("family = -1").select(key, F.col("s").cast("double").alias("_total"))
        out = out.join(total, key)
        x = F.when(F.col("family").isin(*sorted(shares)), F.round(safe_div(x, F.col("_total")), 6)).otherwise(x)
    return out.select(key, "family", "code", x.alias("x"))


def sparse_vectors(long: DataFrame, keys: DataFrame, size: int, key: str = KEY, out: str = "features") -> DataFrame:
    """(key, ``out`` sparse vector of length ``size``) from (key, idx, x) rows, at most one per (key, idx), for every row of
    ``keys``.  Zeros and nulls take no place.  A key's rows are its own features, which ``size`` bounds."""
    some = long.where("x is not null and x <> 0")
    pairs = some.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), "x"))).alias("_p"))
    none = F.array().cast("array<struct<idx:int,x:double>>")
    p = F.coalesce("_p", none)
    plain = keys.select(key).distinct().join(pairs, key, "left").select(key, F.struct(
        F.lit(0).cast("tinyint").alias("type"), F.lit(size).alias("size"), p["idx"].alias("indices"), p["x"].alias("values")).alias(out))
    path = scratch_path(plain.sparkSession, "sparse")
    plain.write.parquet(path)
    # a vector is stored as exactly this struct
    return plain.sparkSession.read.schema(T.StructType([plain.schema[key], T.StructField(out, VectorUDT())])).parquet(path)


def onehot_vectors(rows: DataFrame, dims: list[tuple[str, str]], share=(), value: str = "amount", drop_last: bool = True,
                   key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """The collapsed one-hots of ``dims`` (prefix, column) as one sparse vector per key, families side by side, those whose prefix is
    in ``share`` over the key's total; and (idx, feature, value): the index with the label behind it."""
    sums, codes = collapse_long(rows, dims, value, key)
    cut = 1 if drop_last else 0
    sizes = {r.family: r.size - cut for r in codes.groupBy("family").agg(F.first("size").alias("size")).collect()}   # a row per family
    first, total = {}, 0
    for i in range(len(dims)):
        first[i] = total
        total += sizes.get(i, 0)
    starts = F.create_map(*[x for i, f in first.items() for x in (F.lit(i), F.lit(f))])
    at = (F.try_element_at(starts, F.col("family")) + F.col("code")).alias("idx")
    shares = {i for i, (p, _) in enumerate(dims) if p in set(share)}
    long = coded_sums(sums, codes, shares, drop_last, key).select(key, at, "x")
    prefix = F.get(F.array(*[F.lit(p) for p, _ in dims]), F.col("family"))
    names = codes.where(F.col("code") < F.col("size") - cut).select(at, F.concat(prefix, F.col("code").cast("string")).alias("feature"), "value")
    return sparse_vectors(long, sums, total, key), names


def long_vectors(long: DataFrame, keys: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """(vectors, names) from (key, feature, x) rows: features are numbered by name, for any number of them."""
    long = write_table(long.where("x is not null"), "long")
    names = number(long.select(F.lit(0).alias("family"), F.col("feature").alias("value")).distinct().withColumn("n", F.lit(1)), [F.asc("value")])
    size = names.count()
    coded = long.join(names.select(F.col("value").alias("feature"), F.col("code").alias("idx")), "feature").select(key, "idx", "x")
    return sparse_vectors(coded, keys, size, key), names.select(F.col("code").alias("idx"), F.col("value").alias("feature"))


def unpivot(wide: DataFrame, columns: list[str], key: str = KEY) -> DataFrame:
    """(key, feature, x) rows of numeric columns."""
    entries = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("x")) for c in columns])
    return wide.select(key, F.explode(entries).alias("e")).select(key, "e.feature", "e.x")
