import random

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F

from .helpers import prose, table
from .test_scans import labelled, passage


@pytest.fixture(scope="module")
def folder(spark):
    """documents, labels and benchmark with planted cases, as Parquet."""
    from cardlens.session import scratch_path
    r, (toxic_rows, labels) = random.Random(7), labelled(900, seed=3)
    rows = [(i, t) for i, t, _ in toxic_rows]
    bench = [(i, " ".join(passage(500 + i, 30))) for i in range(6)]
    rows += [(5000 + i, prose(90000 + i, 30) + " " + bench[i % 6][1] + " " + prose(91000 + i, 20)) for i in range(12)]
    base = prose(12345, 200, 3000).split()
    for k in range(8):
        t = list(base)
        t[r.randrange(200)] = f"z{k}"
        rows.append((6000 + k, " ".join(t)))
    rows += [(7000, prose(4, 60)), (7001, prose(4, 60)), (7001, prose(4, 60)), (7002, None), (7003, ""), (None, prose(5, 60))]
    path = scratch_path(spark, "pipeline_input")
    table(spark, rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, labels


def test_stages_take_effect(spark, folder):
    path, rows, labels = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    columns = docs.columns
    # toxicity
    a = C.drop_toxic(spark, docs, path)
    assert a.columns == columns
    kept = [r.doc_id for r in a.select("doc_id").collect()]
    bad = {i for i, _, t in labels if t}
    good = {i for i, _, t in labels if not t}
    assert len(bad & set(kept)) <= 0.03 * len(bad) and len(good - set(kept)) <= 0.02 * len(good)
    # near duplicates
    b = C.drop_near_duplicates(spark, docs, path)
    assert b.columns == columns
    ids = [r.doc_id for r in b.select("doc_id").collect()]
    assert sum(6000 <= (i or 0) < 6008 for i in ids) == 1 and ids.count(7000) == 1 and ids.count(7001) == 0
    assert {7002, 7003, None} <= set(ids)
    # decontamination
    c = C.drop_contaminated(spark, docs, path)
    assert c.columns == columns
    gone = {i for i, _ in rows} - {r.doc_id for r in c.select("doc_id").collect()}
    assert gone == {5000 + i for i in range(12)}
    assert c.count() == len(rows) - 12


def test_columns_of_clashing_names(spark, folder):
    path, rows, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for name in ("hit", "row_key", "set_id", "toxic_score", "label", "group", "item_id", "n"):
        docs = docs.withColumn(name, F.lit("x"))
    for _, stage in C.STAGES[:-1]:
        docs = C.write_table(stage(spark, docs, path), "stage")
        assert docs.columns[-2:] == ["item_id", "n"] and docs.where("hit <> 'x' or n <> 'x'").count() == 0
    assert 0 < docs.count() < len(rows) and C.STAGES[-1][1](spark, docs, path).count() > 0


def test_empty_tables(spark):
    from cardlens.session import scratch_path
    path = scratch_path(spark, "empty_input")
    table(spark, []).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    assert C.run(spark, path).collect() == []


def test_run_packs_what_the_stages_keep(spark, folder):
    path, rows, _ = folder
    out = C.run(spark, path).collect()
    ids = {r.doc_id for r in out}
    assert not ids & {5000 + i for i in range(12)} and 6000 in ids and 6001 not in ids and 7000 in ids
    by = {}
    for r in out:
        by.setdefault(r.sequence_id, []).append(r)
    for s in by.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == C.CAPACITY or at & (at - 1) == 0
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_duplicates", "decontamination", "packing"]
