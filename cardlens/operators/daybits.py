"""Sets of days as bits: distinct days, density and tenure coverage from one aggregate.

A client's days are bits of 128-bit words, merged with ``bit_or`` before and after the shuffle.  Whatever counts distinct
days, or distinct runs of N days, is then arithmetic on a few words per client.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardlens.functions.stats import r6, safe_div

KEY = "cl_id"
WORD = 128


def countable(parts) -> bool:
    """Whether runs of these lengths line up with the words: powers of two up to 128."""
    return all(n in (1, 2, 4, 8, 16, 32, 64, 128) for n in parts)


def day_words(tx: DataFrame, day: str, key: str = KEY) -> DataFrame:
    """(key, word, lo, hi, first, last): bit e of word e // 128 is set for each e = day + 1 that occurs.  A missing day sets no bit;
    a key without any day keeps a row."""
    e = F.col(day).cast("long") + 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), e.bitwiseAND(F.lit(63)).cast("int"))
    upper = e.bitwiseAND(F.lit(64)) != 0
    return (tx.select(key, F.shiftright(e, 7).alias("word"), F.when(~upper, bit).alias("lo"), F.when(upper, bit).alias("hi"), F.col(day).cast("long").alias("d"))
            .groupBy(key, "word").agg(F.bit_or("lo").alias("lo"), F.bit_or("hi").alias("hi"), F.min("d").alias("first"), F.max("d").alias("last")))


def _long(bits: int) -> Column:
    return F.lit(bits - (1 << 64) if bits >> 63 else bits).cast("long")


def runs(lo: str, hi: str, n: int) -> Column:
    """How many of a word's runs of ``n`` days, counted from its start, hold a day."""
    halves = [F.coalesce(F.col(c), F.lit(0).cast("long")) for c in (lo, hi)]
    if n == WORD:
        return (halves[0].bitwiseOR(halves[1]) != 0).cast("int")
    mask = _long(sum(1 << i for i in range(0, 64, n)))
    total = F.lit(0)
    for x in halves:
        step = 1
        while step < n:                     # bit p becomes that of days p to p + n - 1
            x = x.bitwiseOR(F.shiftrightunsigned(x, step))
            step *= 2
        total = total + F.bit_count(x.bitwiseAND(mask))
    return total


def day_sets(tx: DataFrame, day: str, parts=(), horizon: int | None = None, key: str = KEY) -> DataFrame:
    """Per key: ``len_days`` (distinct days), ``len_div_set_days`` (over last - first + 1) and, for each N of ``parts``,
    ``period_partN``: distinct floor((day + 1) / N) over ``horizon`` / N."""
    w = day_words(tx, day, key)
    g = w.groupBy(key).agg(F.sum(runs("lo", "hi", 1)).cast("long").alias("len_days"), F.min("first").alias("_mn"), F.max("last").alias("_mx"),
                           *[F.sum(runs("lo", "hi", n)).alias(f"_p{n}") for n in parts])
    density = r6(safe_div(F.col("len_days").cast("double"), (F.col("_mx") - F.col("_mn") + 1).cast("double")))
    return g.select(key, "len_days", density.alias("len_div_set_days"),
                    *[F.round(F.col(f"_p{n}") / (horizon / n), 6).alias(f"period_part{n}") for n in parts])
