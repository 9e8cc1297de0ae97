"""Token counts of whole texts with the whole-token shortcut."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame

from . import textkernel as K
from .common import documents, in_tasks
from .tokens import byte_counts, whole_tokens


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit), one row per row.

    Which vocabulary strings are whole tokens is proven once, on the driver, and
    broadcast (the vocabulary file bounds it).  Null and empty texts have 0 bytes
    and 0 tokens; a null id stays null; repeated rows stay repeated; an empty
    table gives an empty result; other columns are not read.  Texts are counted
    whole, one at a time, and no row moves between tasks.
    """
    whole = docs.sparkSession.sparkContext.broadcast(frozenset(whole_tokens(tokenizer_path)))

    def run(batches):
        count = byte_counts(tokenizer_path, lambda: whole.value)
        for batch in batches:
            off, _ = K.text_column(batch.column(1))
            n = [count(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(off[1:] - off[:-1], pa.int64()), pa.array(n, pa.int64()),
                 pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])
    return in_tasks(documents(docs, id_col, text_col), run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean", tokenizer=True)
