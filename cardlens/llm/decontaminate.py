"""Benchmark decontamination with spaced-seed hashing.

A seed is a fixed mask over ``SPAN`` consecutive words; only the words at its ones
are hashed, so a substituted word under a zero does not hide a match.  Hashes of all
training documents meet those of the benchmark in a Spark join; on the
diagonal of each hit the two word sequences are searched for their best overlap.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textkernel as K
from .common import bit_table, documents, in_tasks, write_table

#: masks of seven words; whichever words of an overlap of MIN_WORDS or more are substituted, SIMILARITY equal
#: ones leave one seed whole (by enumeration up to 30 words; longer overlaps hold one of 13 to 30 as similar)
MASKS = ("10110011011", "11100110011", "11110100101", "11110111", "1101010111", "11000011111", "11011111", "101101111")
#: masks for items shorter than that: four of five words
SHORT_MASKS = ("1111", "10111", "11011", "11101")
SPAN = max(map(len, MASKS))
SHORT = 5                # words; shorter benchmark items cannot be told from chance and are not searched
MIN_WORDS = 13           # least overlap, or the whole item if that is shorter
SIMILARITY = 0.8         # least share of equal words in an overlap
CONTEXT = 64             # words kept on either side of a hit for verifying
FILTER_LOG2 = 26         # bits of the benchmark filter (8 MB, fixed)


def _offsets(mask: str) -> list[int]:
    return [i for i, c in enumerate(mask) if c == "1"]


#: offsets of each seed; short items are also found by the short masks
SEEDS = [_offsets(m) for m in MASKS + SHORT_MASKS]


def _seed_hashes(words: np.ndarray, which) -> list[tuple[int, np.ndarray]]:
    return [(k, K.grams(words, SEEDS[k]) ^ K.U64(k + 1)) for k in which if len(words) > max(SEEDS[k])]


def _which(n: int) -> range:
    """Seeds of a benchmark item of n words."""
    return range(len(MASKS)) if n >= MIN_WORDS + 2 else range(len(SEEDS)) if n >= SHORT else range(0)


def _item_words(batches):
    for batch in batches:
        for lo, hi, data, ptr in K.blocks(batch.column(1)):
            w = K.words(data, ptr, K.ALNUM)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(lo, hi - lo).cast(pa.int64()),
                 pa.ListArray.from_arrays(pa.array(w.ptr, pa.int32()), pa.array(w.hashes.view(np.int64)))], ["item_id", "words"])


def _item_hashes(batches):
    for batch in batches:
        for item, words in zip(batch.column(0).to_pylist(), batch.column(1)):
            w = np.array(words.values, np.int64).view(K.U64)
            for _, h in _seed_hashes(w, _which(len(w))):
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(np.full(len(h), item, np.int64)),
                                                  pa.array(np.arange(len(h), dtype=np.int64))], ["hash", "item", "at"])


def _regions(filter_, shorts):
    """Runs of a document's words around hashes that the filter lets through:
    doc_id, words before the run, the run's word hashes, and the passing hashes with their places."""
    which = range(len(SEEDS) if shorts else len(MASKS))

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for lo, hi, data, ptr in K.blocks(batch.column(1)):
                w = K.words(data, ptr, K.ALNUM)
                found_at, found = [], []
                for k, h in _seed_hashes(w.hashes, which):
                    ok = np.flatnonzero(K.has_bit(filter_.value, h, FILTER_LOG2))
                    doc = np.searchsorted(w.ptr, ok, "right") - 1
                    ok = ok[ok + max(SEEDS[k]) < w.ptr[doc + 1]]
                    found_at.append(ok)
                    found.append(h[ok])
                if not sum(map(len, found_at)):
                    continue
                at, h = np.concatenate(found_at), np.concatenate(found)
                order = np.argsort(at, kind="stable")
                at, h = at[order], h[order]
                doc = np.searchsorted(w.ptr, at, "right") - 1
                new = np.ones(len(at), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (at[1:] - at[:-1] > 2 * CONTEXT)
                firsts = np.flatnonzero(new)
                rows = []
                for a, b in zip(firsts, [*firsts[1:], len(at)]):
                    d = doc[a]
                    start = max(int(w.ptr[d]), int(at[a]) - CONTEXT)
                    stop = min(int(w.ptr[d + 1]), int(at[b - 1]) + SPAN + CONTEXT)
                    rows.append((ids[lo + int(d)].as_py(), start - int(w.ptr[d]), w.hashes[start:stop].view(np.int64),
                                 h[a:b].view(np.int64), at[a:b] - start))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), *[pa.list_(pa.int64())] * 3))],
                    ["doc_id", "skipped", "words", "hashes", "places"])
    return run


def overlap(text: np.ndarray, item: np.ndarray, shift: int) -> tuple[int, int, int] | None:
    """(first, last + 1, equal words) in item places of the best overlap on a diagonal, where item
    place i lies over text place i + shift: of all ranges of at least ``MIN_WORDS`` words (or the
    whole item) with ``SIMILARITY`` equal words, the one of most equal words, then of fewest words,
    then the first.  None if there is no such range."""
    lo, hi = max(0, -shift), min(len(item), len(text) - shift)
    need = min(MIN_WORDS, len(item))
    if hi - lo < need:
        return None
    same = item[lo:hi] == text[lo + shift:hi + shift]
    n = len(same)
    equal = np.concatenate([[0], np.cumsum(same)])
    surplus = equal - SIMILARITY * np.arange(n + 1)              # a range is similar enough if it does not fall
    least = np.minimum.accumulate(surplus)
    ends = np.arange(need, n + 1)
    a = np.searchsorted(-least, -(surplus[ends] + 1e-9))         # first place from which the range to each end is
    ends, a = ends[a <= ends - need], a[a <= ends - need]
    if not len(ends):
        return None
    places = np.append(np.flatnonzero(same), n)
    a = np.minimum(places[equal[a]], ends - need)                # different words at the front are left out
    k = np.lexsort((a, ends - a, equal[a] - equal[ends]))[0]
    return lo + int(a[k]), lo + int(ends[k]), int(equal[ends[k]] - equal[a[k]])


def _verify(batches):
    names = ["doc_id", "item", "doc_start", "doc_end", "item_start", "overlap_words", "matched_words"]
    for batch in batches:
        out = [[] for _ in names]
        ids, skipped, item_id, shift = (batch.column(i).to_pylist() for i in (0, 1, 3, 5))
        for i in range(batch.num_rows):
            text, item = np.array(batch.column(2)[i].values, np.int64), np.array(batch.column(4)[i].values, np.int64)
            found = overlap(text, item, shift[i])
            if found:
                a, b, same = found
                for c, v in zip(out, (ids[i], item_id[i], skipped[i] + a + shift[i], skipped[i] + b + shift[i], a, b - a, same)):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """Overlaps of documents with benchmark items: one row per (document, item text), its
    overlap of most equal words: doc_id, item_id, n_items, doc_start, doc_end (words), item_start,
    overlap_words, matched_words, similarity.

    Words are lower-cased runs of letters, digits and non-ASCII characters.  An overlap has at
    least ``MIN_WORDS`` words (or the whole item), ``SIMILARITY`` of them equal, wherever the others
    are substituted.  Items with equal words are one; item_id is the smallest and n_items counts them.  Items of fewer than ``SHORT``
    words, null and empty texts never match; a null id stays null; repeated document rows give one
    row; empty tables give an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    items = (in_tasks(documents(benchmark, item_col, item_text_col).withColumnRenamed("doc_id", "item_id"),
                      _item_words, "item_id long, words array<long>")
             .where(F.size("words") >= SHORT).groupBy("words")
             .agg(F.min("item_id").alias("item_id"), F.count(F.lit(1)).alias("n_items")))
    items = write_table(items.withColumn("item", F.xxhash64("words")), "items")
    hashes = write_table(in_tasks(items.select("item", "words"), _item_hashes, "hash long, item long, at long"), "item_hashes")
    shorts = not items.where(F.size("words") < MIN_WORDS + 2).isEmpty()
    filter_ = spark.sparkContext.broadcast(bit_table(hashes, "hash", FILTER_LOG2))
    regions = write_table(
        in_tasks(documents(docs, id_col, text_col), _regions(filter_, shorts),
                 "doc_id long, skipped long, words array<long>, hashes array<long>, places array<long>")
        .withColumn("region", F.monotonically_increasing_id()), "regions")
    hits = (regions.select("region", F.explode(F.arrays_zip("hashes", "places")).alias("x"))
            .select("region", F.col("x.hashes").alias("hash"), F.col("x.places").alias("place"))
            .join(hashes, "hash")
            .select("region", "item", (F.col("place") - F.col("at")).alias("shift")).distinct())
    # a diagonal is searched once, whole, however many hits it has
    joined = (hits.join(regions.select("region", "doc_id", "skipped", "words"), "region")
              .join(items.select("item", F.col("words").alias("item_words")), "item")
              .select("doc_id", "skipped", "words", "item", "item_words", "shift"))
    found = in_tasks(joined, _verify, "doc_id long, item long, doc_start long, doc_end long, item_start long, overlap_words long, matched_words long")
    best = (found.groupBy("doc_id", "item")
            .agg(F.max(F.struct("matched_words", (-F.col("overlap_words")).alias("o"), (-F.col("doc_start")).alias("s"),
                                "doc_end", "item_start")).alias("b")))
    return (best.join(items.select("item", "item_id", "n_items"), "item")
            .select("doc_id", "item_id", "n_items", (-F.col("b.s")).alias("doc_start"), F.col("b.doc_end").alias("doc_end"),
                    F.col("b.item_start").alias("item_start"), (-F.col("b.o")).alias("overlap_words"),
                    F.col("b.matched_words").alias("matched_words"),
                    (F.col("b.matched_words") / -F.col("b.o")).alias("similarity")))
