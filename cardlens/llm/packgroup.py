"""What the two packing operators share: tokenizing a run of documents, cutting
overlong ones, and writing sequences.

A task packs the documents it reads, in groups of at most ``GROUP_TOKENS`` ids (one
longer document is its own group), so no row is shuffled, no key can be hot and
memory is bounded; a task that runs again gives the same sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import textkernel as K
from .common import documents, in_tasks
from .tokens import word_ids

GROUP_TOKENS = 2_000_000
TEXT_BYTES = 3 << 20      # of text that is tokenized at a time

SCHEMA = ("sequence_id long, n_tokens int, capacity int, doc_ids array<long>, doc_tokens array<long>, starts array<long>, "
          "cu_seqlens array<int>, position_resets array<int>, crc32 array<long>, cost double, input_ids binary")


class Group:
    """Documents of one group: their ids one after another, and the pieces they were cut to."""

    def __init__(self, doc_ids: list, ids: list[np.ndarray], capacity: int):
        self.doc_ids, self.ids, self.capacity = doc_ids, ids, capacity
        #: (document, start, length), none longer than the capacity
        self.pieces = [(d, s, min(capacity, len(x) - s)) for d, x in enumerate(ids) for s in range(0, len(x), capacity)]


def _groups(batches, path: str, end_id: int, capacity: int, group_tokens: int) -> Iterator[Group]:
    encode = word_ids(path, end_id)
    doc_ids, ids, total = [], [], 0
    for batch in batches:
        keys, text = batch.column(0), batch.column(1)
        for lo, hi, _, _ in K.blocks(text, TEXT_BYTES):
            for key, x in zip(keys.slice(lo, hi - lo).to_pylist(), encode(text.slice(lo, hi - lo))):
                if ids and total + len(x) > group_tokens:
                    yield Group(doc_ids, ids, capacity)
                    doc_ids, ids, total = [], [], 0
                doc_ids.append(key)
                ids.append(x)
                total += len(x)
    if ids:
        yield Group(doc_ids, ids, capacity)


def pack(docs: DataFrame, assign: Callable[[Group], list[tuple[int, float, list[tuple[int, int, int]]]]], tokenizer_path: str,
         end_id: int, capacity: int, id_bytes: int, id_col: str, text_col: str, group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """``assign`` gives a group's sequences as (size, cost, pieces); size is what the
    sequence is padded to (id 0).  One row per sequence; ``crc32`` has each segment's
    ids as little-endian unsigned 32-bit integers.  A tokenizer that keeps case or white space, and one with
    ids beyond ``id_bytes``, raise ``ValueError``."""
    kind = {2: "<u2", 4: "<u4"}[id_bytes]

    def run(batches):
        if word_ids(tokenizer_path, end_id).size > 1 << 8 * id_bytes:
            raise ValueError(f"ids of {tokenizer_path} need more than {id_bytes} bytes")
        first = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40
        made = 0
        for group in _groups(batches, tokenizer_path, end_id, capacity, group_tokens):
            rows, waiting = [], 0
            for size, cost, pieces in assign(group):
                row = np.zeros(size, kind)
                cu, crc = [0], []
                for d, s, n in pieces:
                    row[cu[-1]:cu[-1] + n] = group.ids[d][s:s + n]
                    crc.append(zlib.crc32(row[cu[-1]:cu[-1] + n].astype("<u4")))     # of the ids as written
                    cu.append(cu[-1] + n)
                rows.append((first + made, cu[-1], size, [group.doc_ids[p[0]] for p in pieces],
                             [len(group.ids[p[0]]) for p in pieces], [p[1] for p in pieces], cu, cu[:-1], crc, float(cost), row.tobytes()))
                made += 1
                waiting += size
                if waiting >= 1 << 20:
                    yield _batch(rows)
                    rows, waiting = [], 0
            if rows:
                yield _batch(rows)
    return in_tasks(documents(docs, id_col, text_col), run, SCHEMA, tokenizer=True)


_TYPES = [("sequence_id", pa.int64()), ("n_tokens", pa.int32()), ("capacity", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
          ("doc_tokens", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())), ("cu_seqlens", pa.list_(pa.int32())),
          ("position_resets", pa.list_(pa.int32())), ("crc32", pa.list_(pa.int64())), ("cost", pa.float64()), ("input_ids", pa.binary())]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _TYPES)], [n for n, _ in _TYPES])


def position_ids(resets: list[int], n_tokens: int) -> np.ndarray:
    """Position of every token of a sequence: counted from each reset."""
    at = np.asarray(resets, np.int64)
    return np.arange(n_tokens) - np.repeat(at, np.diff(np.append(at, n_tokens)))
