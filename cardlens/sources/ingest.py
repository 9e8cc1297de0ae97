"""Scans and sinks in the card log's file formats.

Readers: transaction CSV (header, fixed schema), the same file as raw text
lines split by comma (header dropped by substring, short lines rejected,
trailing label fields optional), exchange-rate CSVs, the MCC dictionary.
Writers: the same formats, used to materialise the test tables in those
formats under the shared checkpoint folder, and the prediction sink.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardlens.functions import calendar as cal
from cardlens.session import scratch_path, write_table

TX_HEADER = "PERIOD,cl_id,MCC,channel_type,currency,TRDATETIME,amount,trx_category"
TX_COLUMNS = ["PERIOD", "cl_id", "MCC", "channel_type", "currency", "TRDATETIME", "amount", "trx_category"]
LABEL_COLUMNS = ["target_flag", "target_sum"]
TX_SCHEMA = T.StructType([
    T.StructField("PERIOD", T.StringType()), T.StructField("cl_id", T.LongType()),
    T.StructField("MCC", T.IntegerType()), T.StructField("channel_type", T.StringType()),
    T.StructField("currency", T.IntegerType()), T.StructField("TRDATETIME", T.StringType()),
    T.StructField("amount", T.DoubleType()), T.StructField("trx_category", T.StringType()),
    T.StructField("target_flag", T.DoubleType()), T.StructField("target_sum", T.DoubleType())])
RATE_SCHEMA = T.StructType([
    T.StructField("TICKER", T.StringType()), T.StructField("DATE", T.StringType()),
    T.StructField("OPEN", T.DoubleType()), T.StructField("WAPRICE", T.DoubleType())])


# ----------------------------------------------------------------------------- readers
def read_transactions_csv(spark: SparkSession, path: str, labelled: bool) -> DataFrame:
    """Header CSV with a fixed schema (no inference pass over the data)."""
    cols = TX_SCHEMA.fields if labelled else TX_SCHEMA.fields[:8]
    return spark.read.schema(T.StructType(cols)).option("header", True).csv(path)


def parse_transactions(raw: DataFrame) -> DataFrame:
    """Typed transactions: tolerant time/period parsing; a row whose time does
    not parse is dropped, a missing period is kept as NULL."""
    t = raw.select(
        cal.parse_period("PERIOD").alias("period"), "cl_id", F.col("MCC").alias("mcc"), "channel_type",
        "currency", cal.parse_trx_time("TRDATETIME").alias("ts"), "amount",
        F.col("trx_category").alias("category"),
        *[c for c in LABEL_COLUMNS if c in raw.columns])
    return t.filter(F.col("ts").isNotNull())


def read_text_fields(spark: SparkSession, path: str, header_marker: str = "PERIOD,cl_id,MCC,channel_type",
                     min_fields: int = 3) -> DataFrame:
    """Raw lines split by comma; the header line is dropped by substring and
    lines with fewer than ``min_fields`` fields are rejected."""
    lines = spark.read.text(path)
    return (lines.filter(~F.col("value").contains(header_marker))
            .select(F.split("value", ",").alias("f"))
            .filter(F.size("f") >= min_fields))


def sort_lines(spark: SparkSession, path: str, header_marker: str = "PERIOD,cl_id,MCC,channel_type",
               min_fields: int = 3) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) of a card log's lines: one scan, written once, so that every line is in one of them.

    Accepted rows are typed as by ``parse_transactions``, with the file and the text.  Rejected ones have ``file``, ``line`` (the
    text) and ``reason``: header, short (fewer than ``min_fields`` fields), client, time or amount (not readable; the first of them
    that fails).  A missing period or trailing label is no reason.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("line"))
    f = lines.withColumn("f", F.split("line", ","))
    typed = f.select(
        "file", "line", F.size("f").alias("_n"), field("f", 1).try_cast("long").alias("cl_id"), cal.parse_period(field("f", 0)).alias("period"),
        field("f", 2).try_cast("int").alias("mcc"), F.nullif(field("f", 3), F.lit("")).alias("channel_type"), field("f", 4).try_cast("int").alias("currency"),
        cal.parse_trx_time(field("f", 5)).alias("ts"), field("f", 6).try_cast("double").alias("amount"), field("f", 7).alias("category"),
        *[field("f", 8 + i).try_cast("double").alias(c) for i, c in enumerate(LABEL_COLUMNS)])
    reason = (F.when(F.col("line").contains(header_marker), "header").when(F.col("_n") < min_fields, "short")
              .when(F.col("cl_id").isNull(), "client").when(F.col("ts").isNull(), "time").when(F.col("amount").isNull(), "amount"))
    sorted_ = write_table(typed.withColumn("reason", reason).drop("_n"), "lines")
    return sorted_.where("reason is null").drop("reason"), sorted_.where("reason is not null").select("file", "line", "reason")


def field(arr: str, i: int) -> Column:
    """i-th field (0-based), NULL when the line is shorter."""
    return F.get(F.col(arr), i)


def optional_double(arr: str, i: int, default: float = 0.0) -> Column:
    """Trailing optional numeric field: missing or unparseable -> default."""
    return F.coalesce(field(arr, i).try_cast("double"), F.lit(default))


def read_rates_csv(spark: SparkSession, path: str, code: int, fallback_open: bool) -> DataFrame:
    """Exchange-rate CSV -> (code, day, rate).  With ``fallback_open`` a
    missing weighted price falls back to the open price.  ``_line`` orders lines by
    file, block and place, whichever task reads them."""
    r = spark.read.schema(RATE_SCHEMA).option("header", True).csv(path)
    rate = F.coalesce("WAPRICE", "OPEN") if fallback_open else F.col("WAPRICE")
    return r.select(F.lit(code).alias("code"), cal.epoch_day(cal.parse_rate_date("DATE")).alias("day"),
                    rate.alias("rate"), F.struct("_metadata.file_path", "_metadata.file_block_start",
                                                 F.monotonically_increasing_id().alias("n")).alias("_line"))


def last_per_day(rates: DataFrame) -> DataFrame:
    """One rate per (code, day); for duplicates the later line wins."""
    return rates.groupBy("code", "day").agg(F.max_by("rate", "_line").alias("rate"))


def read_mcc_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """Comma lines: field 0 is the MCC, field 2 its category."""
    f = spark.read.text(path).select(F.split("value", ",").alias("f"))
    return f.select(field("f", 0).try_cast("int").alias("mcc"), field("f", 2).alias("mcc_category"))


# ----------------------------------------------------------------------------- writers
def transaction_lines(tx: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Transactions in the card-log columns (text fields as the log writes them)."""
    t = tx if labels is None else tx.join(labels, "cl_id", "inner")
    cols = [F.date_format(F.trunc("ts", "MM"), cal.PERIOD_FORMAT).alias("PERIOD"), "cl_id",
            F.col("mcc").alias("MCC"), "channel_type", "currency",
            F.upper(F.date_format("ts", cal.TRX_TIME_FORMAT)).alias("TRDATETIME"),
            F.col("amount").cast("double").alias("amount"), F.col("category").alias("trx_category")]
    if labels is not None:
        cols += [F.col("target_flag").cast("double").alias("target_flag"),
                 F.col("target_sum").cast("double").alias("target_sum")]
    return t.select(*cols)


def write_csv(df: DataFrame, path: str) -> str:
    """Header CSV, one part file per task (a folder of parts, read back as one
    table); nothing is funnelled through a single task."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_lines(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").text(path)
    return path


def materialise(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, name)


def write_predictions(pred: DataFrame, path: str, id_col: str = "cl_id", value_col: str = "pred") -> str:
    """Prediction sink: columns ``_ID_``, ``_VAL_`` with a header."""
    return write_csv(pred.select(F.col(id_col).alias("_ID_"), F.col(value_col).alias("_VAL_")), path)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField("_ID_", T.LongType()), T.StructField("_VAL_", T.DoubleType())])
    return spark.read.schema(schema).option("header", True).csv(path)
