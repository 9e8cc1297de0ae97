"""Training corpus from raw documents: toxic documents go, one of each group of near
duplicates stays, documents that overlap with the benchmark go, the rest is packed.

Each stage takes what the stage before kept, written as Parquet and read again.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.llm import balanced
from cardlens.llm.common import fresh, read, write_table
from cardlens.llm.decontaminate import contamination
from cardlens.llm.jaccard_join import keep_one
from cardlens.llm.queries import CAPACITY, END_ID, WORD_IDS
from cardlens.llm.toxicity import toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under 0.5 (operator 7)."""
    scored, names = toxicity(docs, read(spark, sf_dir, "labels"))
    return scored.where(F.col(names["toxic_score"]) < 0.5).select(*[f"`{c}`" for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity 0.8 (operator 8)."""
    return keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with a benchmark item (operator 5).

    The decision is made per (id, text), so a clean row never goes because another row has its id.
    """
    key = fresh(docs, "row_key")
    marked = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = fresh(marked, "hit")
    hit = contamination(marked, read(spark, sf_dir, "benchmark"), id_col=key).select(F.col("doc_id").alias(found)).distinct()
    return marked.join(hit, F.col(key) == F.col(found), "left_anti").drop(key)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' tokens in sequences of near equal cost, one row per piece (operator 3)."""
    return balanced.pieces(balanced.pack_balanced(docs, WORD_IDS, END_ID, CAPACITY))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("packing", pack_documents),
]

#: learned scores, hashing and packing are not SQL; tests hold the stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_table(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
