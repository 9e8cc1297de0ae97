"""Spelling variants: words one edit apart, and the frequent form that each rare one stands for.

Asymmetric q-chunks.  The longer word of a pair (either one of equal length) gives two disjoint chunks,
its first and its last ``q`` characters, ``q`` half its length.  One edit cannot touch both, so the
other word has one of them among its positional ``q``-grams: at the chunk's own place or, behind an
inserted character, one place earlier.  Only grams at those places can join, so only they go out.

What is left of both words beside the common chunk is again one edit apart.  The same cut is made
there, ``LEVELS`` times in all, which leaves few words per key even where many share a beginning.
The join verifies each meeting with the edit distance, so that no unrelated pair becomes a row.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import documents, in_tasks, write_table

WORD = "[A-Za-zÀ-ÿ]+"
MIN_LENGTH = 6
MIN_COUNT = 5
RATIO = 5           # a form is at least so many times as frequent
LEVELS = 3
FLUSH = 300_000     # distinct words that a task holds


def count_words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, delete_every: int | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words of the whole texts with at least ``min_length`` characters and ``min_count`` places.

    Words are maximal runs of ``WORD``, of which A-Z are lower-cased.  ``delete_every`` plants misspellings: with h the
    CRC-32 of ``<id>:<word>``, a word whose h it divides loses its character h mod length.  Null and
    empty texts have no words; a null id reads as empty; repeated rows count each; an empty table gives an empty result.
    """
    find = re.compile(WORD).findall

    def run(batches):
        held: dict[str, int] = {}

        def rows():
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                words = Counter(find(text.lower().decode())) if text else {}    # bytes: lower() knows A-Z only
                seed = crc32(f"{'' if key is None else key}:".encode())
                for word, n in words.items():
                    if len(word) < min_length:
                        continue
                    if delete_every:
                        h = crc32(word.encode(), seed)
                        if h % delete_every == 0:
                            i = h % len(word)
                            word = word[:i] + word[i + 1:]
                            if len(word) < min_length:
                                continue
                    held[word] = held.get(word, 0) + n
                if len(held) > FLUSH:
                    yield rows()
                    held.clear()
        yield rows()
    counts = in_tasks(documents(docs, id_col, text_col), run, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _keys(words: DataFrame, shorter: int, levels: int) -> DataFrame:
    """(key, word, n): the chunks of each word or, for ``shorter`` = 1, its grams that a word longer by one may
    have as chunks.  ``own`` is the length of the rest not yet in the key, ``of`` that of the partner's rest."""
    own = F.char_length("word")
    rows = words.select("word", "n", F.col("word").alias("rest"), own.alias("own"), (own + shorter).alias("of"),
                        (own + shorter).cast("string").alias("key"))
    q = F.expr("cast(of div 2 as int)")
    for _ in range(levels):
        front = F.struct(F.concat("key", F.lit("<"), F.substr("rest", F.lit(1), q)).alias("key"),
                         F.substr("rest", q + 1, F.col("own") - q).alias("rest"))
        back = F.struct(F.concat("key", F.lit(">"), F.substr("rest", F.col("own") - q + 1, q)).alias("key"),
                        F.substr("rest", F.lit(1), F.col("own") - q).alias("rest"))
        rows = (rows.select("word", "n", (F.col("own") - q).alias("own"), (F.col("of") - q).alias("of"), F.explode(F.array(front, back)).alias("x"))
                .select("word", "n", "own", "of", "x.key", "x.rest"))
    return rows.select(F.xxhash64("key").alias("key"), "word", "n")


def near_pairs(words: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(a, na, b, nb): all pairs of distinct ``words`` (word, n; each word once) exactly one inserted, deleted or replaced
    character apart, once each.  Words of one character or none, and null, are not compared."""
    words = words.where(F.char_length("word") > 1)
    chunks = _keys(words, 0, levels).select("key", F.col("word").alias("a"), F.col("n").alias("na"))
    grams = _keys(words, 0, levels).withColumn("same", F.lit(True)).union(_keys(words, 1, levels).withColumn("same", F.lit(False)))
    grams = grams.select("key", F.col("word").alias("b"), F.col("n").alias("nb"), "same")
    meets = (chunks["key"] == grams["key"]) & (~F.col("same") | (F.col("a") < F.col("b"))) & (F.levenshtein("a", "b", 1) == 1)
    return chunks.join(grams, meets).select("a", "na", "b", "nb").distinct()


def spelling_variants(words: DataFrame, ratio: int = RATIO, levels: int = LEVELS) -> DataFrame:
    """word, form, root, n, n_near, form_n of each row of ``words`` (word, n; each word once).

    ``n_near``: words one edit apart; ``form``: the most frequent of them (ties: the smallest in code-point order) if it has
    at least ``ratio`` times the word's n, else null, and ``form_n`` its n; ``root``: the last word on the way
    from form to form.  An empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its variant: ratio of 2 or more")
    words = write_table(words, "words")
    pairs = write_table(near_pairs(words, levels), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("m")).union(pairs.select("b", "a", "na"))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("m")).alias("less"), "near")).alias("best"))
    stands = -F.col("best.less") >= ratio * F.col("n")
    found = write_table(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(stands, F.col("best.near")).alias("form"),
        F.when(stands, -F.col("best.less")).alias("form_n")), "forms")
    # a step multiplies n by the ratio at least, which bounds the way; each round doubles the steps taken
    least, most = words.agg(F.min("n"), F.max("n")).first()
    steps = math.log(max(1, most or 1) / max(1, least or 1), ratio) + 1e-9
    roots = found.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(1, math.floor(steps))))):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = write_table(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
