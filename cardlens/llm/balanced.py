"""Cost-balanced packing: falling pieces go to the cheapest sequence that still has room."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .packgroup import GROUP_TOKENS, Group, pack

LINEAR = 1.0                # per token: projections and feed-forward
QUADRATIC = 1.0 / 6144      # per token pair of a segment: attention, at a width of 1024
_NONE = (float("inf"), -1)


class CheapestTree:
    """By free capacity the cheapest open sequence, as a segment tree of minima."""

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.low = [_NONE] * (2 * self.base)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]

    def _refresh(self, free: int) -> None:
        i, low = self.base + free, self.low
        low[i] = self.heaps[free][0] if self.heaps[free] else _NONE
        i >>= 1
        while i:
            a, b = low[2 * i], low[2 * i + 1]
            low[i] = a if a <= b else b
            i >>= 1

    def put(self, free: int, cost: float, sequence: int) -> None:
        heapq.heappush(self.heaps[free], (cost, sequence))
        self._refresh(free)

    def take(self, need: int) -> tuple[float, int] | None:
        """Cheapest sequence with at least ``need`` free, taken out; None when there is none."""
        lo, hi, best, low = self.base + need, 2 * self.base, _NONE, self.low
        while lo < hi:
            if lo & 1:
                if low[lo] < best:
                    best = low[lo]
                lo += 1
            if hi & 1:
                hi -= 1
                if low[hi] < best:
                    best = low[hi]
            lo >>= 1
            hi >>= 1
        return None if best == _NONE else best

    def remove(self, free: int) -> None:
        heapq.heappop(self.heaps[free])
        self._refresh(free)


def balance(pieces: list[tuple[int, int, int]], capacity: int, linear: float, quadratic: float):
    """Sequences (size, cost, pieces).  The pieces' total fixes the sizes: full
    sequences and, for what is left, powers of two, so nothing is padded.  A piece
    that fits nowhere whole is cut to fill the cheapest sequence with room."""
    total = sum(p[2] for p in pieces)
    sizes = [capacity] * (total // capacity)
    left, bit = total % capacity, 1 << capacity.bit_length()
    while bit:
        if left & bit:
            sizes.append(bit)
        bit >>= 1
    free, held = list(sizes), [[] for _ in sizes]
    costs = [0.0] * len(sizes)
    tree = CheapestTree(capacity)
    for i, s in enumerate(sizes):
        heapq.heappush(tree.heaps[s], (0.0, i))
    for s in set(sizes):
        tree._refresh(s)
    for d, start, n in sorted(pieces, key=lambda p: -p[2]):
        while n:
            got = tree.take(n) or tree.take(1)
            cost, i = got
            tree.remove(free[i])
            part = min(n, free[i])
            cost += linear * part + quadratic * part * part
            held[i].append((d, start, part))
            costs[i] = cost
            free[i] -= part
            if free[i]:
                tree.put(free[i], cost, i)
            start, n = start + part, n - part
    return list(zip(sizes, costs, held))


def pack_balanced(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048, linear: float = LINEAR,
                  quadratic: float = QUADRATIC, id_bytes: int = 2, id_col: str = "doc_id", text_col: str = "text",
                  group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per packed sequence (columns as of ``packgroup.SCHEMA``; ``cost`` is the
    estimate ``linear * n + quadratic * n**2`` summed over its segments).

    A document longer than the capacity fills sequences of its own; its rest and the
    other documents go, by falling length, to the cheapest sequence with room.
    Sequences are ``capacity`` long, but each group's last few are powers of two, so
    no id is padding.  Null and empty texts are the end id alone.  A null id stays
    null; repeated rows are packed each; ties go by order of reading; an empty table
    gives no sequences; other columns are not read.
    """
    def assign(group: Group):
        full = [(capacity, linear * capacity + quadratic * capacity * capacity, [p]) for p in group.pieces if p[2] == capacity]
        return full + balance([p for p in group.pieces if p[2] < capacity], capacity, linear, quadratic)
    return pack(docs, assign, tokenizer_path, end_id, capacity, id_bytes, id_col, text_col, group_tokens)


def pieces(sequences: DataFrame) -> DataFrame:
    """One row per segment of packed sequences: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id and offset."""
    x = F.col("x")
    length = F.transform("doc_ids", lambda _, i: F.col("cu_seqlens")[i + 1] - F.col("cu_seqlens")[i]).alias("lengths")
    each = sequences.select("sequence_id", "doc_ids", "doc_tokens", "starts", "position_resets", "crc32", length)
    each = each.select("sequence_id", F.explode(F.arrays_zip("doc_ids", "starts", "lengths", "crc32", "doc_tokens", "position_resets")).alias("x"))
    return each.select(x["doc_ids"].alias("doc_id"), x["starts"].alias("start"), x["lengths"].cast("long").alias("length"),
                       x["crc32"].alias("ids_crc32"), x["doc_tokens"].alias("doc_tokens"), "sequence_id",
                       x["position_resets"].cast("long").alias("offset"))
