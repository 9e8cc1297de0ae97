"""Small Spark helpers shared by the operators of this folder."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardlens.session import write_table

__all__ = ["write_table", "documents", "fresh", "bit_table", "read", "in_tasks"]


BATCH_BYTES = 4 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def in_tasks(df: DataFrame, function, schema, tokenizer: bool = False) -> DataFrame:
    """``mapInArrow`` after the package's own source went to the executors, which
    need not have it installed.

    Python workers are used again by later tasks.  Those that need no ``tokenizer``
    first give back what tokenizing tasks have kept in their worker."""
    def task(batches):
        tokens = sys.modules.get("cardlens.llm.tokens")
        if tokens and not tokenizer:
            tokens.forget()
        return function(batches)
    conf = df.sparkSession.conf
    if int(conf.get(_BATCH, "67108864").rstrip("b")) > BATCH_BYTES:
        conf.set(_BATCH, str(BATCH_BYTES))      # for the session: a task holds a few batches of long texts at once
    sc = df.sparkSession.sparkContext
    if not getattr(sc, "_cardlens_sent", False):
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="cardlens-code-"), "cardlens_code.zip")
        with zipfile.ZipFile(archive, "w") as z:
            for folder, _, names in os.walk(top):
                for name in sorted(n for n in names if n.endswith(".py")):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(top)))
        sc.addPyFile(archive)
        sc._cardlens_sent = True
    return df.mapInArrow(task, schema)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, so that other columns (of whatever name) never reach a task."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bit_table(hashes: DataFrame, column: str, size_log2: int) -> np.ndarray:
    """A bitmap of 2**size_log2 bits with the top bits of every hash set, built by
    Spark.  At most 2**(size_log2 - 5) rows of 32 bits reach the driver however
    many hashes there are, so its size is fixed.  A bitmap lets false hits through
    (an exact join follows) and never loses one."""
    top = f"shiftrightunsigned(`{column}`, {64 - size_log2})"
    cells = (hashes.selectExpr(f"cast(shiftright({top}, 5) as int) as cell",
                               f"shiftleft(1L, cast({top} & 31 as int)) as bit")
             .groupBy("cell").agg(F.bit_or("bit").alias("bits")))
    table = np.zeros(1 << (size_log2 - 5), np.uint32)
    got = cells.toArrow()
    if got.num_rows:
        table[got["cell"].to_numpy()] = got["bits"].to_numpy().astype(np.uint32)
    return table.view(np.uint8)
