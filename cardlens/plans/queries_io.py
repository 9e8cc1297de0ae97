"""Queries over scans, sinks, set operations and row-level metrics
(A1-A4, A10-A11, A14-A15, B24-B26, C9, G3, H1-H2, K1, K4, K10, K11, K17)."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardlens.operators import metrics as M
from cardlens.plans.catalog import query
from cardlens.sources import ingest as I
from cardlens.sources import views as V


def card_log_files(spark, sf):
    """tx_e written as the card log: a labelled train CSV (clients with a
    label) and an unlabelled test CSV (the rest)."""
    tx, lbl = V.tx_e(spark, sf), V.cust_lbl(spark, sf)
    train = I.transaction_lines(tx, lbl)
    test = I.transaction_lines(tx.join(lbl.select("cl_id"), "cl_id", "left_anti"))
    return (I.write_csv(train, I.materialise(spark, "train")), I.write_csv(test, I.materialise(spark, "test")))


@query("scan_csv_roundtrip")
def q_scan_csv_roundtrip(spark, sf):
    train_p, test_p = card_log_files(spark, sf)
    train = I.parse_transactions(I.read_transactions_csv(spark, train_p, labelled=True))
    test = I.parse_transactions(I.read_transactions_csv(spark, test_p, labelled=False))
    both = train.drop(*I.LABEL_COLUMNS).unionByName(test)
    return both.select("cl_id", "mcc", "channel_type", "currency", F.col("ts").alias("trx_time"), "amount",
                       "category", "period")


def card_log_text(spark, sf, short_rows: bool = False):
    """The card log as raw comma lines with a header; labelled rows carry the two
    labels.  With ``short_rows`` the 'error' rows are cut to two fields (which
    the scan rejects)."""
    tx, lbl = V.tx_e(spark, sf), V.cust_lbl(spark, sf)
    t = tx.join(lbl, "cl_id", "left")
    base = [F.date_format(F.trunc("ts", "MM"), "dd/MM/yyyy"), F.col("cl_id").cast("string"),
            F.col("mcc").cast("string"), F.coalesce("channel_type", F.lit("")), F.col("currency").cast("string"),
            F.upper(F.date_format("ts", "ddMMMyy:HH:mm:ss")), F.col("amount").cast("string"), F.col("category")]
    labels = [F.col("target_flag").cast("double").cast("string"), F.col("target_sum").cast("double").cast("string")]
    line = (F.when((F.col("category") == "error") & F.lit(short_rows), F.concat_ws(",", *base[:2]))
            .when(F.col("target_flag").isNotNull(), F.concat_ws(",", *base, *labels))
            .otherwise(F.concat_ws(",", *base)))
    header = spark.range(1).select(F.lit(I.TX_HEADER).alias("value"))
    return I.write_lines(header.unionByName(t.select(line.alias("value"))), I.materialise(spark, "log-text"))


@query("scan_text_split")
def q_scan_text_split(spark, sf):
    f = I.read_text_fields(spark, card_log_text(spark, sf, short_rows=True))
    return f.select(I.field("f", 1).cast("long").alias("cl_id"), I.field("f", 2).cast("int").alias("mcc"),
                    I.field("f", 6).cast("double").alias("amount"), I.field("f", 7).alias("category"),
                    F.size("f").alias("n_fields"))


def damaged_log(spark, sf):
    """The card log as text with a header: 'error' rows cut to two fields, rows without a channel with an unreadable time, and
    'signup' rows with an unreadable amount."""
    t = V.tx_e(spark, sf)
    short = F.col("category") == "error"
    time = F.when(F.col("channel_type").isNull(), F.concat(F.lit("bad"), F.col("tx_id"))).otherwise(F.upper(F.date_format("ts", "ddMMMyy:HH:mm:ss")))
    amount = F.when(F.col("category") == "signup", "n/a").otherwise(F.col("amount").cast("string"))
    base = [F.date_format(F.trunc("ts", "MM"), "dd/MM/yyyy"), F.col("cl_id").cast("string"), F.col("mcc").cast("string"),
            F.coalesce("channel_type", F.lit("")), F.col("currency").cast("string"), time, amount, F.col("category")]
    line = F.when(short, F.concat_ws(",", *base[:2])).otherwise(F.concat_ws(",", *base))
    header = spark.range(1).select(F.lit(I.TX_HEADER).alias("value"))
    return I.write_lines(header.unionByName(t.select(line.alias("value"))), I.materialise(spark, "damaged-text"))


@query("rejected_lines")
def q_rejected_lines(spark, sf):
    """Lines that the scan does not accept, with the reason."""
    return I.sort_lines(spark, damaged_log(spark, sf))[1].select("line", "reason")


@query("sorted_lines")
def q_sorted_lines(spark, sf):
    """How many lines were accepted, and rejected for each reason."""
    accepted, rejected = I.sort_lines(spark, damaged_log(spark, sf))
    return accepted.select(F.lit("accepted").alias("reason"), "amount").union(rejected.select("reason", F.lit(None).cast("double"))).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("amount"))


@query("optional_targets")
def q_optional_targets(spark, sf):
    f = I.read_text_fields(spark, card_log_text(spark, sf))
    return f.select(I.field("f", 1).cast("long").alias("cl_id"), I.field("f", 6).cast("double").alias("amount"),
                    I.optional_double("f", 8).alias("target_flag"), I.optional_double("f", 9).alias("target_sum"))


@query("sink_predictions_roundtrip")
def q_sink_predictions_roundtrip(spark, sf):
    pred = V.cust_lbl(spark, sf).select("cl_id", F.round(F.log1p(F.col("target_sum").cast("double")), 6).alias("pred"))
    path = I.write_predictions(pred, I.materialise(spark, "predictions"))
    return I.read_predictions(spark, path)


@query("input_counts")
def q_input_counts(spark, sf):
    tx, lbl = V.tx_e(spark, sf), V.cust_lbl(spark, sf)
    part = F.when(F.col("target_flag").isNotNull(), "train").otherwise("test")
    rows = tx.join(lbl.select("cl_id", "target_flag"), "cl_id", "left").select(part.alias("source"))
    return rows.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("preview_top10")
def q_preview_top10(spark, sf):
    return V.tx_e(spark, sf).orderBy("cl_id", "ts", "tx_id").limit(10).select(
        "cl_id", "tx_id", "ts", "category", F.col("amount").cast("double").alias("amount"))


@query("union_train_test")
def q_union_train_test(spark, sf):
    tx, lbl = V.tx_e(spark, sf), V.cust_lbl(spark, sf)
    train = tx.join(lbl, "cl_id", "inner")
    test = tx.join(lbl.select("cl_id"), "cl_id", "left_anti")
    both = train.drop("target_flag", "target_sum").unionByName(test)
    return both.select("cl_id", "tx_id", F.col("amount").cast("double").alias("amount"))


@query("split_labelled")
def q_split_labelled(spark, sf):
    clients = V.tx_e(spark, sf).select("cl_id").distinct().join(V.cust_lbl(spark, sf), "cl_id", "left")
    train = clients.filter(F.col("target_flag").isNotNull()).select("cl_id", F.lit("train").alias("part"))
    test = clients.filter(F.col("target_flag").isNull()).select("cl_id", F.lit("test").alias("part"))
    return train.unionByName(test)


@query("target_log")
def q_target_log(spark, sf):
    return V.cust_lbl(spark, sf).select("cl_id", M.log_target("target_sum").alias("y_log"))


@query("target_unlog_clip")
def q_target_unlog_clip(spark, sf):
    p = M.log_target("target_sum") - 3.0
    return V.cust_lbl(spark, sf).select("cl_id", F.round(M.unlog_clip(p), 6).alias("pred"))


@query("minmax_scale")
def q_minmax_scale(spark, sf):
    return M.minmax_scale(V.cust_lbl(spark, sf).select("cl_id", F.col("target_sum").cast("double").alias("score")),
                          "score", "score_scaled").select("cl_id", "score_scaled")


@query("hash_split")
def q_hash_split(spark, sf):
    clients = V.tx_e(spark, sf).select("cl_id").distinct()
    return M.hash_folds(clients, "cl_id", k=10, seed=42).withColumn("is_train", (F.col("fold") < 8).cast("int"))


@query("string_index")
def q_string_index(spark, sf):
    return M.string_index(V.tx_e(spark, sf), "category", "category_index").select("cl_id", "tx_id", "category_index")


def scored_labels(spark, sf):
    """Documents' quality label against a score built from the toxic flag and
    the document id (ties on purpose)."""
    from cardlens.sources.tables import read_table
    lab = read_table(spark, sf, "labels")
    return lab.select(F.col("quality").cast("double").alias("label"),
                      (F.col("toxic") * 0.5 + (F.col("doc_id") % 7) / 10.0).alias("score"))


@query("roc_auc")
def q_roc_auc(spark, sf):
    return M.roc_auc(scored_labels(spark, sf), "label", "score")


@query("rmsle")
def q_rmsle(spark, sf):
    t = V.tx_e(spark, sf).groupBy("cl_id").agg(F.sum("amount").alias("total")).join(V.cust_lbl(spark, sf), "cl_id")
    return M.rmse(t.select(M.log_target(F.col("total") / 5).alias("p"), M.log_target("target_sum").alias("y")),
                  "p", "y")


@query("prediction_histogram")
def q_prediction_histogram(spark, sf):
    p = V.cust_lbl(spark, sf).select(F.col("target_sum").cast("double").alias("pred"))
    lin = M.histogram(p, "pred", 50).withColumn("scale", F.lit("linear"))
    log = M.histogram(p.select(F.log1p("pred").alias("pred")), "pred", 50).withColumn("scale", F.lit("log"))
    return lin.unionByName(log)
