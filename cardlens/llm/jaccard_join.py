"""N-gram Jaccard self-join with a vertically partitioned overlap count.

All distinct word shingles stand in one global order: a class that tells how often
a shingle repeats (the rarer, the earlier; from a fixed-size sketch that one pass
over all documents fills), then the shingle's hash.

* Candidates: two sets of Jaccard similarity ``t`` share one of the first
  ``n - ceil(t n) + 1`` shingles of that order, so only those are shuffled.  How many
  of them a pair shares bounds its overlap from above; pairs below the bound go.
* Overlaps: the order is cut into ``FRAGMENTS`` pieces.  Each candidate pair meets
  once per fragment, the partial overlaps are counted there, and one sum per pair
  gives the exact overlap.
* No group of similar texts is expanded to all its pairs.  Equal sets are one class.
  The first round compares each class with a few leaders of its posting lists; classes
  it connects need no more links among them.  The second round tests every remaining
  candidate pair between different components, so no link between components is lost.
  Knowing both sizes, it needs only the first ``n - overlap + 1`` shingles of either set
  (``overlap``: the least that links the sizes), which leaves out the frequent ones.
* Many variants of one text that link with few others share prefixes all the same.  Each class has a signature: the parity
  of its shingles in ``SIGNATURE`` buckets.  Two sets differ in at least as many shingles as their signatures in bits, so
  the join of the second round drops pairs that differ too much before they become rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkernel as K
from .common import bit_table, documents, fresh, in_tasks, write_table
from .components import components

THRESHOLD = 80          # percent
SHINGLE = 5             # words
FRAGMENTS = 4
SKETCH_LOG2 = 20        # cells of the repeat sketch: 2**20 bytes, whatever the input
FLUSH = 1_000_000       # shingles that a task counts at a time
HASH_LEADERS = 6        # of the first round
BAND = 0.1              # size bands of the second round: factors of exp(BAND)
CANDIDATE_BITS = 25     # 4 MB bitmap of classes that have candidates
SIGNATURE = 1024        # bits

_RECORD = "kind tinyint, doc_id long, n long, set_id long, signature array<long>"


def _sets(batches: Iterator[pa.RecordBatch], shingle: int):
    for batch in batches:
        ids, text = batch.column(0), batch.column(1)
        for lo, hi, data, ptr in K.blocks(text):
            yield ids.slice(lo, hi - lo), K.shingle_sets(data, ptr, shingle)


def signature(s: np.ndarray) -> np.ndarray:
    """Parity of a set's shingles per bucket, as 64-bit words."""
    odd = np.bincount((s >> K.U64(20) & K.U64(SIGNATURE - 1)).astype(np.int64), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _survey(shingle: int):
    """Rows of kind 0: one per document (its set's size, id and signature).  Rows of kind 1:
    sketch cells (in doc_id) of shingles that repeat within a run of documents, with counts (in n)."""
    names = ["kind", "doc_id", "n", "set_id", "signature"]
    words = SIGNATURE // 64

    def run(batches):
        held, size, seen = [], 0, set()

        def repeats():
            g, c = np.unique(np.concatenate(held) if held else np.zeros(0, K.U64), return_counts=True)
            cells = K.bits_of(g[c > 1], SKETCH_LOG2)
            count = np.bincount(cells, c[c > 1], 1 << SKETCH_LOG2) if len(cells) else np.zeros(0)
            at = np.flatnonzero(count)
            return pa.RecordBatch.from_arrays([pa.array(np.ones(len(at), np.int8)), pa.array(at.astype(np.int64)),
                                               pa.array(count[at].astype(np.int64)), pa.array(np.zeros(len(at), np.int64)),
                                               pa.nulls(len(at), pa.list_(pa.int64()))], names)
        for ids, sets in _sets(batches, shingle):
            marks = [K.set_id(s) for s in sets]
            signs = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * words, pa.int32()),
                                             pa.array(np.concatenate([np.zeros(0, np.int64), *map(signature, sets)])))
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(sets), np.int8)), ids.cast(pa.int64()),
                                              pa.array([len(s) for s in sets], pa.int64()), pa.array(marks, pa.int64()), signs], names)
            for m, s in zip(marks, sets):
                if m not in seen:          # copies are one class; they make nothing frequent
                    seen.add(m)
                    held.append(s)
                    size += len(s)
            if size >= FLUSH:
                yield repeats()
                held, size, seen = [], 0, set()
        yield repeats()
    return run


def _ordered(s: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    c = classes[K.bits_of(s, SKETCH_LOG2)]
    at = np.argsort(c, kind="stable")
    return s[at], c[at]


def _prefixes(shingle: int, threshold: int, classes):
    """(token, set_id, n, pos) of each class's prefix in the global order."""
    def run(batches):
        seen = set()
        for _, sets in _sets(batches, shingle):
            tokens, marks, sizes, counts = [], [], [], []
            for s in sets:
                n = len(s)
                if not n:
                    continue
                m = K.set_id(s)
                if m in seen:
                    continue
                if len(seen) > 1_000_000:
                    seen.clear()
                seen.add(m)
                p = n - -(-threshold * n // 100) + 1
                tokens.append(_ordered(s, classes.value)[0][:p])
                marks.append(m)
                sizes.append(n)
                counts.append(p)
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(np.array(marks, np.int64), counts)),
                     pa.array(np.repeat(np.array(sizes, np.int64), counts)),
                     pa.array(np.concatenate([np.arange(c) for c in counts]), pa.int64())], ["token", "set_id", "n", "pos"])
    return run


def _runs(batches):
    """Postings sorted by (token, set_id) in; those of tokens that more than one class has out."""
    names = ["token", "set_id", "n", "pos"]
    held = None                 # first row of a token, not sent until a second class comes
    last = (None, None)         # token and class of the row before
    for batch in batches:
        columns = [batch.column(i).to_numpy() for i in range(4)]
        t = columns[0]
        # rows alone in their token within the batch (not its first or last) cannot match: skipped at once
        same = t[1:] == t[:-1]
        lone = np.zeros(len(t), bool)
        if len(t) > 2:
            lone[1:-1] = ~same[1:] & ~same[:-1]
        out = []
        for row in zip(*(c[~lone].tolist() for c in columns)):
            if row[0] != last[0]:
                held = row
            elif row[1] != last[1]:     # equal: the same class from another task
                if held:
                    out.append(held)
                    held = None
                out.append(row)
            last = row[:2]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)


def _segments(shingle: int, classes, wanted):
    """(set_id, fragment, part) of the classes in the bitmap ``wanted``: the set cut
    along the global order.  Repeating shingles are the last fragment, the others
    are cut by hash range."""
    def run(batches):
        for _, sets in _sets(batches, shingle):
            marks, pieces, parts = [], [], []
            ids = np.array([K.set_id(s) for s in sets], np.int64)
            keep = K.has_bit(wanted.value, ids.view(K.U64), CANDIDATE_BITS)
            for i in np.flatnonzero(keep):
                s, c = _ordered(sets[i], classes.value)
                rare = int(np.searchsorted(c, 1))
                cut = (s[:rare] >> K.U64(32)).astype(np.int64) * (FRAGMENTS - 1) >> 32
                at = [*np.searchsorted(cut, range(FRAGMENTS - 1)).tolist(), rare, len(s)]
                for f in range(FRAGMENTS):
                    if at[f] < at[f + 1]:
                        marks.append(ids[i])
                        pieces.append(f)
                        parts.append(s[at[f]:at[f + 1]].view(np.int64))
            if marks:
                ends = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(marks, pa.int64()), pa.array(pieces, pa.int32()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts)))],
                    ["set_id", "fragment", "part"])
    return run


def _may_link(pairs: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b, na, nb, met) without those whose overlap cannot reach the threshold.  Beyond the prefix that ends first,
    a set of size n has ``ceil(t n) - 1`` shingles left, so the overlap is at most the number of
    prefix shingles that both have (``met``) plus the larger of the two rests."""
    need = _least_overlap(F.col("na"), F.col("nb"), threshold)
    rest = F.ceil(threshold * F.greatest("na", "nb") / 100) - 1
    return pairs.where(F.col("met") + rest >= need).drop("met")


def _linked(base: DataFrame, pairs: DataFrame, shingle: int, threshold: int, order) -> DataFrame:
    """Of the candidate pairs (a, b, na, nb) those that reach the threshold: partial
    overlaps per fragment, summed per pair."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    wanted = base.sparkSession.sparkContext.broadcast(bit_table(ends, "set_id", CANDIDATE_BITS))
    segments = write_table(in_tasks(base, _segments(shingle, order, wanted), "set_id long, fragment int, part array<long>")
                           .join(ends, "set_id", "left_semi")
                           .groupBy("set_id", "fragment").agg(F.any_value("part").alias("part")), "segments")
    a = segments.select(F.col("set_id").alias("a"), "fragment", F.col("part").alias("part_a"))
    b = segments.select(F.col("set_id").alias("b"), "fragment", F.col("part").alias("part_b"))
    each = pairs.withColumn("fragment", F.explode(F.array(*[F.lit(f) for f in range(FRAGMENTS)])))
    partial = (each.join(a, ["a", "fragment"]).join(b, ["b", "fragment"])
               .select("a", "b", "na", "nb", F.size(F.array_intersect("part_a", "part_b")).cast("long").alias("shared")))
    return write_table(partial.groupBy("a", "b", "na", "nb").agg(F.sum("shared").alias("shared"))
                       .where(100 * F.col("shared") >= threshold * (F.col("na") + F.col("nb") - F.col("shared")))
                       .select("a", "b"), "linked")


def _stars(shared: DataFrame, threshold: int) -> DataFrame:
    """Pairs of each class with its token's leaders.  One row per token and pair.

    Leaders are the class that has the token earliest (the fewest shingles of its own
    before it, so the likeliest origin of the others), the longest class, and the smallest by
    some hashes, which are the same classes over many tokens."""
    tie = F.xxhash64("set_id").bitwiseAND(F.lit((1 << 20) - 1))
    rank = [F.col("pos") * (1 << 20) + tie, F.col("n") * -(1 << 20) + tie, *[F.xxhash64("set_id", F.lit(r)) for r in range(HASH_LEADERS)]]
    lead = shared.groupBy("token").agg(*[x for i, r in enumerate(rank) for x in (
        F.min_by("set_id", r).alias(f"s{i}"), F.min_by("n", r).alias(f"n{i}"))])
    leaders = F.array_distinct(F.array(*[F.struct(F.col(f"s{i}").alias("s"), F.col(f"n{i}").alias("n")) for i in range(len(rank))]))
    near = F.filter(leaders, lambda x: (x["s"] != F.col("set_id")) & (100 * x["n"] >= threshold * F.col("n"))
                    & (100 * F.col("n") >= threshold * x["n"]))
    met = shared.join(lead, "token").select("set_id", "n", F.explode(near).alias("x"))
    a_first = F.col("set_id") < F.col("x.s")
    return met.select(F.least("set_id", "x.s").alias("a"), F.greatest("set_id", "x.s").alias("b"),
                      F.when(a_first, F.col("n")).otherwise(F.col("x.n")).alias("na"),
                      F.when(a_first, F.col("x.n")).otherwise(F.col("n")).alias("nb"))


def _least_overlap(na, nb, threshold: int):
    return F.ceil(threshold * (na + nb) / (100 + threshold))


def _crossing(shared: DataFrame, parts: DataFrame, signatures: DataFrame, threshold: int) -> DataFrame:
    """All pairs (a, b, na, nb) of classes of different components that may link, once each.

    A posting goes to one key per size band of a possible partner, while its place is within
    the prefix that such a partner asks for.  Keys of a single component go.  In a key, the members of its largest
    component are not compared with each other; all other pairs of different components are, in the join's
    condition: sizes, places and signatures must allow a link.
    """
    words = [f"s{i}" for i in range(SIGNATURE // 64)]
    named = (shared.join(parts.withColumnRenamed("node", "set_id"), "set_id", "left")
             .withColumn("part", F.coalesce("component", "set_id")).drop("component"))
    apart = named.groupBy("token").agg(F.min("part").alias("x"), F.max("part").alias("y")).where("x <> y").select("token")
    band = lambda n: F.floor(F.log(n.cast("double")) / BAND).cast("int")
    n = F.col("n")
    low, high = F.ceil(threshold * n / 100), F.floor(100 * n / threshold)
    smallest = F.greatest(low, F.floor(F.exp(F.col("other") * BAND)) - 1)    # partner in that band, at least
    keyed = (named.join(apart, "token").withColumn("own", band(n))
             .withColumn("other", F.explode(F.sequence(band(low), band(high))))
             .where(F.col("pos") < n - _least_overlap(n, smallest, threshold) + 1)
             .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other")))
    key = ["token", "lo", "hi"]
    several = (keyed.groupBy(*key).agg(F.min("part").alias("x"), F.max("part").alias("y"), F.min("own").alias("s"), F.max("own").alias("t"))
               .where("x <> y and s = lo and t = hi").select(*key))
    keyed = write_table(keyed.join(several, key).join(signatures, "set_id").select(
        *key, "part", "own", "set_id", "n", "pos", *[F.get("signature", F.lit(i)).alias(w) for i, w in enumerate(words)]), "crossing")
    major = (keyed.groupBy(*key, "part").agg(F.count(F.lit(1)).alias("m"))
             .groupBy(*key).agg(F.max(F.struct("m", "part")).alias("x")).select(*key, F.col("x.part").alias("major")))
    side = lambda t, x: t.select(*key, F.col("part").alias(f"p{x}"), F.col("own").alias(f"own_{x}"), F.col("set_id").alias(x),
                                 F.col("n").alias(f"n{x}"), F.col("pos").alias(f"at_{x}"), *[F.col(w).alias(f"{x}{w}") for w in words],
                                 *[c for c in t.columns if c == "major"])
    minor = side(keyed.join(major, key).where("part <> major"), "a")
    na, nb = F.col("na"), F.col("nb")
    need = _least_overlap(na, nb, threshold)
    differ = sum((F.bit_count(F.col(f"a{w}").bitwiseXOR(F.col(f"b{w}"))) for w in words[1:]), F.bit_count(F.col(f"a{words[0]}").bitwiseXOR(F.col(f"b{words[0]}"))))
    b = side(keyed, "b").withColumnsRenamed({k: f"b_{k}" for k in key})
    meets = ((F.col("pa") != F.col("pb")) & ((F.col("pb") == F.col("major")) | (F.col("pa") < F.col("pb")))
             & ((F.col("own_a") != F.col("own_b")) | (F.col("lo") == F.col("hi")))
             & (100 * na >= threshold * nb) & (100 * nb >= threshold * na)
             & (F.col("at_a") < na - need + 1) & (F.col("at_b") < nb - need + 1) & (differ <= na + nb - 2 * need))
    for k in key:
        meets = (F.col(k) == F.col(f"b_{k}")) & meets
    met = minor.join(b, meets)
    first = F.col("a") < F.col("b")
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.when(first, na).otherwise(nb).alias("na"),
                      F.when(first, nb).otherwise(na).alias("nb")).distinct()


def _with_met(pairs: DataFrame, shared: DataFrame) -> DataFrame:
    """Pairs with ``met``, the number of prefix shingles that both have: one row per pair."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("set_id")).distinct()
    prefix = shared.join(ends, "set_id", "left_semi").groupBy("set_id").agg(F.collect_list("token").alias("tokens"))
    have = lambda x: prefix.select(F.col("set_id").alias(x), F.col("tokens").alias(f"t{x}"))
    return (pairs.join(have("a"), "a").join(have("b"), "b")
            .select("a", "b", "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("met")))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       shingle: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, set_id, group (a number of the
    component, null without shingles).

    Two rows link when ``100 * |intersection| >= threshold * |union|`` of their
    shingle sets; component_id is the smallest id reachable by links.  Null or
    empty texts have no shingles and link with nothing (their component is their
    own id).  Repeated rows and equal sets link.  A null id takes part but is never
    a component's name; a component with no other id has null.  An empty table
    gives an empty result; other columns are not read.  Sets are told apart by
    64-bit hashes of shingles and of sets.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    base = documents(docs, id_col, text_col)
    survey = write_table(in_tasks(base, _survey(shingle), _RECORD), "survey")
    rows = survey.where("kind = 0").select("doc_id", "n", "set_id")
    signatures = survey.where("kind = 0 and n > 0").groupBy("set_id").agg(F.any_value("signature").alias("signature"))
    cells = survey.where("kind = 1").groupBy("doc_id").agg(F.sum("n").alias("n")).toArrow()  # 2**SKETCH_LOG2 rows at most
    classes = np.zeros(1 << SKETCH_LOG2, np.uint8)
    if cells.num_rows:
        classes[cells["doc_id"].to_numpy()] = np.log2(cells["n"].to_numpy()).astype(np.uint8)
    order = sc.broadcast(classes)

    columns = "token long, set_id long, n long, pos long"
    postings = in_tasks(base, _prefixes(shingle, threshold, order), columns)
    shared = write_table(in_tasks(postings.repartition("token").sortWithinPartitions("token", "set_id"), _runs, columns), "postings")

    stars = _stars(shared, threshold).groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("met"))
    first = _linked(base, write_table(_may_link(stars, threshold), "pairs"), shingle, threshold, order)
    parts = write_table(components(first), "parts")
    crossing = write_table(_crossing(shared, parts, signatures, threshold), "pairs")
    second = _linked(base, write_table(_may_link(_with_met(crossing, shared), threshold), "pairs"), shingle, threshold, order)
    whole = components(first.union(second))

    # names are worked out per class, so that a group of copies is one row, and given to the rows last
    classes = rows.where("n > 0").groupBy("set_id").agg(F.min("doc_id").alias("least_id"))
    placed = write_table(classes.join(whole.withColumnRenamed("node", "set_id"), "set_id", "left")
                         .select("set_id", "least_id", F.coalesce("component", "set_id").alias("part")), "classes")
    least = write_table(placed.groupBy("part").agg(F.min("least_id").alias("least")), "least")
    named = write_table(placed.join(least, "part").select("set_id", "part", "least"), "named")
    linked = rows.where("n > 0").join(named, "set_id").select(
        "doc_id", F.col("n").alias("n_shingles"), F.col("least").alias("component_id"), "set_id", F.col("part").alias("group"))
    # linked with nothing, and not one hot key of the join
    return linked.union(rows.where("n = 0").select("doc_id", "n", "doc_id", "set_id", F.lit(None).cast("long")))


def _with_set_id(docs: DataFrame, text_col: str, shingle: int) -> tuple[DataFrame, str]:
    """``docs`` with the id of each row's shingle set (0 without shingles), and the column's name."""
    name, where = fresh(docs, "set_id"), docs.columns.index(text_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())])

    def run(batches):
        for batch in batches:
            for lo, hi, data, ptr in K.blocks(batch.column(where).cast(pa.string())):
                marks = pa.array([K.set_id(s) for s in K.shingle_sets(data, ptr, shingle)], pa.int64())
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, marks], schema.names)
    return in_tasks(docs, run, schema), name


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
             threshold: int = THRESHOLD) -> DataFrame:
    """Rows of ``docs``, all columns, with one row of each component of ``jaccard_components``: that of the
    smallest id (a null id only where there is no other), one of its repeats.  Rows without shingles all stay."""
    found = jaccard_components(docs, id_col, text_col, shingle, threshold).where("group is not null")
    chosen = (found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "set_id")).alias("c"))
              .select(F.col("c.doc_id").alias("chosen_id"), F.col("c.set_id").alias("chosen_set"), F.lit(True).alias("chosen")))
    rows, mark = _with_set_id(docs, text_col, shingle)
    number, key = fresh(rows, "row_number"), F.col(f"`{id_col}`").cast("long")
    # rows without shingles are told apart by a number; of the others one per (set, id) goes on
    apart = F.when(F.col(mark) == 0, F.monotonically_increasing_id()).otherwise(F.lit(0))
    one = Window.partitionBy(mark, key, fresh(rows, "apart")).orderBy(F.lit(0))
    rows = rows.withColumn(fresh(rows, "apart"), apart).withColumn(number, F.row_number().over(one)).where(F.col(number) == 1)
    sides = rows.join(chosen, (F.col(mark) == chosen["chosen_set"]) & key.eqNullSafe(chosen["chosen_id"]), "left")
    return sides.where((F.col(mark) == 0) | chosen["chosen"]).select(*[rows[f"`{c}`"] for c in docs.columns])

