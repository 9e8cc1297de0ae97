"""Fitted dictionaries: value -> ordinal code, as tables joined on the value.

A code table of any size stays a table.  Only the lists that name the columns of
a wide table reach the driver, because a DataFrame's columns must be known when its
plan is built; open-ended dimensions have ``pivots.shares_long`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardlens.session import write_table


def fit_values(df: DataFrame, col: str | Column) -> list:
    """Sorted distinct non-null values of ``col``, the column names of a wide table."""
    c = F.col(col) if isinstance(col, str) else col
    return sorted(r.v for r in df.select(c.alias("v")).where("v is not null").distinct().collect())


def code_table(df: DataFrame, col: str, by_frequency: bool = False) -> DataFrame:
    """(value, code): 0-based rank of each distinct non-null value, by value, or by
    falling frequency (ties by value).  Distinct values are range-partitioned and
    numbered per partition after the partitions before; no task holds them all."""
    g = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("_n"))
    order = [F.desc("_n"), F.asc("value")] if by_frequency else [F.asc("value")]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    g = write_table(g.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "codes")
    sizes = g.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)     # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_first"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return g.withColumn("_place", place).join(offsets, "_part").select(
        "value", (F.col("_first") + F.col("_place") - 1).cast("int").alias("code"))


def with_code(df: DataFrame, col: str, out: str, codes: DataFrame) -> DataFrame:
    """``out`` = the code of ``col`` in a code table; -1 if missing."""
    t = codes.select(F.col("value").alias("_value"), F.col("code").alias("_code"))
    return (df.join(t, F.col(col) == F.col("_value"), "left")
            .withColumn(out, F.coalesce("_code", F.lit(-1))).drop("_value", "_code"))


def with_category_code(df: DataFrame, col: str, out: str, fitted_on: DataFrame | None = None) -> DataFrame:
    """Alphabetical ordinal code of a category, fitted on ``fitted_on`` (by default on ``df``)."""
    return with_code(df, col, out, code_table(df if fitted_on is None else fitted_on, col))


SHORT_LIST = 64


def with_membership(df: DataFrame, col: str, values, out: str) -> DataFrame:
    """``out`` = the row's ``col`` is in ``values`` (NULL value -> False).  ``values`` is a
    list, or a predicate that takes the column.

    Short lists stay an ``isin``; long lists (a parameter, so their size is
    known) become a small dimension table broadcast-joined on ``col``: a hash
    lookup per row and a constant-size plan."""
    if callable(values):
        return df.withColumn(out, F.coalesce(values(F.col(col)), F.lit(False)))
    values = list(values)
    if len(values) <= SHORT_LIST:
        flag = F.coalesce(F.col(col).isin(*values), F.lit(False)) if values else F.lit(False)
        return df.withColumn(out, flag)
    spark = df.sparkSession
    dim = spark.createDataFrame([(v,) for v in sorted(set(values))], [f"_{out}_v"]).withColumn(f"_{out}_hit", F.lit(True))
    j = df.join(F.broadcast(dim), F.col(col) == F.col(f"_{out}_v"), "left")
    return j.withColumn(out, F.coalesce(F.col(f"_{out}_hit"), F.lit(False))).drop(f"_{out}_v", f"_{out}_hit")
