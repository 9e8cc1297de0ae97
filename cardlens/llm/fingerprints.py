"""Document fingerprints by winnowing, in SQL functions alone.

Words (runs of non-blank characters, lower-cased) are hashed, ``K_GRAM`` consecutive
word hashes make one rolling hash, and of every ``WINDOW`` consecutive rolling hashes
the smallest is chosen, the rightmost on ties.  Any passage of ``K_GRAM + WINDOW - 1``
equal words shares a chosen hash, and each chosen hash keeps its word position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K_GRAM = 5
WINDOW = 8             # a power of two: the minimum is found by doubling
_LOW = 24              # low bits that hold the position in the numbers that windows compare
_MASK = (1 << _LOW) - 1


def with_fingerprint(df: DataFrame, text: str, positions: str, hashes: str) -> DataFrame:
    """``df`` with the chosen positions (first word, from 0) and hashes of column ``text``,
    in text order.  A text of fewer words than ``K_GRAM`` has one hash, that of all
    its words; one of no words has none; a text of fewer rolling hashes than
    ``WINDOW`` is one window.

    Windows compare numbers of the hash's upper 40 bits, then the position counted
    downwards, so that equal hashes give the rightmost.  The chosen hash is the whole one.
    """
    keep = df.columns
    words = f"filter(split(lower(`{text}`), '\\\\s+'), w -> w <> '')"
    df = df.withColumn("_w", F.expr(f"transform({words}, w -> xxhash64(w))"))
    gram = ", ".join(f"element_at(_w, i + {j})" for j in range(K_GRAM))
    df = df.withColumn("_g", F.expr(
        f"case when size(_w) >= {K_GRAM} then transform(sequence(1, size(_w) - {K_GRAM - 1}), i -> xxhash64({gram}))"
        " when size(_w) > 0 then array(xxhash64(_w)) else cast(array() as array<bigint>) end"))
    df = df.withColumn("_m1", F.expr(f"transform(_g, (g, i) -> shiftleft(shiftright(g, {_LOW}), {_LOW}) + ({_MASK} - (i & {_MASK})))"))
    width = 1
    while width < WINDOW:
        left = f"greatest(size(_m{width}) - {width}, 0)"
        df = df.withColumn(f"_m{2 * width}", F.expr(
            f"zip_with(slice(_m{width}, 1, {left}), slice(_m{width}, {width + 1}, {left}), (a, b) -> least(a, b))"))
        width *= 2
    # window j holds places j to j + WINDOW - 1, which tells the position's upper bits
    place = f"j + (({_MASK} - cast(c & {_MASK} as int) - j) & {_MASK})"
    df = df.withColumn(positions, F.expr(
        f"array_distinct(transform(if(size(_g) >= {WINDOW} or size(_g) = 0, _m{WINDOW}, array(array_min(_m1))), (c, j) -> {place}))"))
    return (df.withColumn(hashes, F.expr(f"transform(`{positions}`, p -> element_at(_g, p + 1))"))
            .select(*[F.col(f"`{c}`") for c in keep], positions, hashes))


def as_text(positions: str, hashes: str) -> Column:
    """``position:hash`` of each chosen hash (hash in 16 hex digits), comma-joined."""
    return F.expr(f"array_join(zip_with(`{positions}`, `{hashes}`, (p, h) -> concat(p, ':', lpad(lower(hex(h)), 16, '0'))), ',')")


def likeness(a: str, b: str) -> Column:
    """Share of the distinct hashes of either fingerprint that both have; 1 when neither has any."""
    return F.expr(f"coalesce(try_divide(size(array_intersect(`{a}`, `{b}`)), size(array_union(`{a}`, `{b}`))), 1D)")


def _bounds(rows: DataFrame, n: int) -> list[int]:
    """At most n - 1 ascending ids that cut the rows into about equal parts (an id that
    holds several parts' worth of rows is there several times)."""
    if n < 2:
        return []
    cuts = ", ".join(f"{i / n:.9f}D" for i in range(1, n))
    got = rows.agg(F.expr(f"percentile_approx(doc_id, array({cuts}), 100000)").alias("b")).first()["b"]
    return list(got or [])


def neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text, _pos, _hash (its fingerprint), next_text and next_hash of the row that
    follows by ascending id (null ids first, ties by the text's hash, then the text); the first
    row follows the last.

    One shuffle deals the rows to ranges of ids, about equal in rows; one id with very many
    rows is dealt on by the tie hash.  Each range also gets a copy of the next range's first row,
    so that no range needs another's rows.  Bounds and first keys (one per shuffle partition)
    are all that reaches the driver.  Rows alike in id and text share a range.
    """
    spark = docs.sparkSession
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.shiftrightunsigned(F.xxhash64("text"), 1))
    bounds = _bounds(rows.select("doc_id"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    if bounds:
        cut = F.array(*[F.lit(b).cast("long") for b in bounds])
        below = F.size(F.filter(cut, lambda b: b < F.col("doc_id")))
        equal = F.size(F.filter(cut, lambda b: b == F.col("doc_id")))
        bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(
            below + F.floor(F.col("tie") / float(1 << 63) * F.greatest(equal, F.lit(1))).cast("int"))
    else:
        bucket = F.lit(0)
    rows = rows.withColumn("bucket", bucket)
    firsts = sorted(rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "tie")).alias("k")).collect(), key=lambda r: r["bucket"])
    own = F.struct(F.col("bucket"), F.lit(False).alias("copy"))
    targets = F.array(own)
    if firsts:
        before = [firsts[-1], *firsts[:-1]]
        at = F.create_map(*[x for r, b in zip(firsts, before) for x in (
            F.lit(r["bucket"]), F.struct(F.lit(r["k"]["doc_id"]).cast("long").alias("id"), F.lit(r["k"]["tie"]).alias("tie"), F.lit(b["bucket"]).alias("to")))])
        mine = F.element_at(at, F.col("bucket"))
        is_first = F.col("doc_id").eqNullSafe(mine["id"]) & (F.col("tie") == mine["tie"])
        targets = F.when(is_first, F.array(own, F.struct(mine["to"].alias("bucket"), F.lit(True).alias("copy")))).otherwise(targets)
    rows = with_fingerprint(rows, "text", "_pos", "_hash")
    dealt = rows.select("doc_id", "tie", "text", "_pos", "_hash", F.explode(targets).alias("to")).select("doc_id", "tie", "text", "_pos", "_hash", "to.*")
    w = Window.partitionBy("bucket").orderBy("copy", F.col("doc_id").asc_nulls_first(), "tie", "text")
    return (dealt.withColumn("next_text", F.lead("text").over(w)).withColumn("next_hash", F.lead("_hash").over(w))
            .where("not copy").select("doc_id", "text", "_pos", "_hash", "next_text", "next_hash"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, n_hashes.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as many
    of the next document.  Null is the empty text, whose fingerprint is empty and like another
    empty one (1) and no other (0); a null id sorts first; equal texts have equal fingerprints;
    a table of one row is its own next; an empty table gives an empty result; other
    columns are not read.
    """
    d = neighbours(docs, id_col, text_col).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    d = d.withColumn("edited", F.concat(F.substr(F.col("text"), F.lit(1), (F.col("n_chars") - half).cast("int")),
                                        F.substr(F.col("next_text"), F.lit(1), half)))
    d = d.select("doc_id", "n_chars", "edited", "_pos", "_hash", "next_hash")
    d = with_fingerprint(d, "edited", "_epos", "_ehash")
    return d.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
                    as_text("_pos", "_hash").alias("fingerprint"), as_text("_epos", "_ehash").alias("edited_fingerprint"),
                    likeness("_hash", "_ehash").alias("near_edited"), likeness("_hash", "next_hash").alias("near_next"),
                    F.size("_hash").cast("long").alias("n_hashes"))
