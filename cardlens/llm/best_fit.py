"""Best-fit-decreasing packing with a segment tree over free capacities."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .packgroup import GROUP_TOKENS, Group, pack


class FreeTree:
    """Counts of open sequences by free capacity, as a segment tree; finds the
    smallest free capacity that is large enough in O(log capacity)."""

    def __init__(self, capacity: int):
        self.base = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.base)

    def add(self, free: int, by: int) -> None:
        i = self.base + free
        while i:
            self.count[i] += by
            i >>= 1

    def least(self, need: int) -> int | None:
        """Smallest free capacity of at least ``need`` that some open sequence has."""
        i, count = self.base + need, self.count
        while not count[i]:
            while i & 1:            # last of its parent: go up
                i >>= 1
            if not i:
                return None
            i += 1                  # the next subtree to the right
            if i & (i - 1) == 0:    # past the right edge
                return None
        while i < self.base:
            i *= 2
            if not count[i]:
                i += 1
        return i - self.base


def best_fit_decreasing(lengths: list[int], capacity: int) -> list[list[int]]:
    """Item numbers of each bin: items by falling length (ties: in given order), each into
    the fullest bin that still holds it."""
    bins: list[list[int]] = []
    open_with: list[list[int]] = [[] for _ in range(capacity + 1)]
    tree = FreeTree(capacity)
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        free = tree.least(n)
        if free is None:
            b, free = len(bins), capacity
            bins.append([])
        else:
            b = open_with[free].pop()
            tree.add(free, -1)
        bins[b].append(i)
        open_with[free - n].append(b)
        tree.add(free - n, 1)
    return bins


def pack_best_fit(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 2048, id_bytes: int = 2,
                  id_col: str = "doc_id", text_col: str = "text", group_tokens: int = GROUP_TOKENS) -> DataFrame:
    """One row per packed sequence: its padded id row (``input_ids``, little-endian
    unsigned integers of ``id_bytes``, padding 0, ``capacity`` ids), ``cu_seqlens``
    (segment ends from 0), ``position_resets`` (offsets where positions start again
    from 0), and each segment's document, start in it and the document's length.

    Documents longer than the capacity are cut into full pieces and a rest, without
    loss; every id lies in exactly one segment.  Null and empty texts are the end
    id alone.  A null id stays null in ``doc_ids``; repeated rows are packed each;
    an empty table gives no sequences; other columns are not read.
    """
    def assign(group: Group):
        lengths = [p[2] for p in group.pieces]
        return [(capacity, sum(lengths[i] for i in b), [group.pieces[i] for i in b])
                for b in best_fit_decreasing(lengths, capacity)]
    return pack(docs, assign, tokenizer_path, end_id, capacity, id_bytes, id_col, text_col, group_tokens)
