"""Toxicity by multiple-instance learning.

Only documents carry labels.  A document is a bag of sentences; a sentence's score is
a function of its words and word beginnings, and the document's score is their
noisy-or with one leak: 1 - (1 - leak) * product of (1 - sentence score).  The leak is
the share of marked documents that no sentence accounts for; a document has it once,
however long it is, and a sentence whose words tell too little scores 0.  Training maximizes
the likelihood of the document labels through the noisy-or, so the weights find the
offending sentences, which scoring then reports.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textkernel as K
from .common import documents, fresh, in_tasks

FEATURES_LOG2 = 18
PREFIX_BYTES = (4, 5)            # beginnings of words, for inflected forms
MAX_TRAINING_ROWS = 8_000        # labelled documents the model is fitted on, taken in hash order
MIN_DOCUMENTS = 5                # a feature of fewer training documents has no weight
BASE = -6.0                      # a sentence's log odds before its words: what they must outweigh
FLOOR = 3.0                      # least sum of weights that counts (a chance of 5 %): weak words of many sentences must not add up,
FLOOR_FROM = 100                 # from this step of the fit on, so that what they explained goes to the leak
SUM_AT_ONCE = 4_000_000
STEPS = 200
RATE = 0.1
SPARSITY = 2.0                   # L1 penalty: a weight must pay for the pull of this many documents,
SPARSITY_SHARE = 0.01            # or of this share of the positive ones, if fewer
PRUNE_FROM, PRUNE_EVERY = 40, 20  # steps at which features with weight 0 leave

_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n"]] = True


def bags(data: np.ndarray, ptr: np.ndarray):
    """Features of all sentences of a block: (features, sentence of each, document of
    each sentence, first byte, last byte + 1 of each).  Words are lower-cased runs of
    letters, digits and non-ASCII characters; a sentence ends at . ! ? or a line end."""
    w = K.words(data, ptr, K.ALNUM)
    n = len(w.hashes)
    doc = np.searchsorted(w.ptr, np.arange(n), "right") - 1
    stop = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_STOP[data], out=stop[1:])
    mark = stop[w.starts]
    new = np.ones(n, bool)
    new[1:] = (mark[1:] != mark[:-1]) | (doc[1:] != doc[:-1])
    sentence = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    last = np.append(first[1:], n) - 1 if n else first
    rows = [w.hashes] + [w.prefix(p) for p in PREFIX_BYTES]
    feats = np.stack([K.bits_of(h, FEATURES_LOG2).astype(np.int32) for h in rows], axis=1).ravel()
    return feats, np.repeat(sentence, len(rows)), doc[first], w.starts[first], w.ends[last] if n else w.ends


def _training_bags(batches):
    mask = (1 << FEATURES_LOG2) - 1
    for batch in batches:
        for lo, hi, data, ptr in K.blocks(batch.column(1)):
            feats, sentence, doc, _, _ = bags(data, ptr)
            bound = np.searchsorted(doc, np.arange(hi - lo + 1))     # sentences of each document
            out, sizes = [], []
            for d in range(hi - lo):
                a, b = np.searchsorted(sentence, (bound[d], bound[d + 1]))
                key = np.unique((sentence[a:b] - bound[d]).astype(np.int64) << FEATURES_LOG2 | feats[a:b])
                out.append((key & mask).astype("<u4").tobytes())
                sizes.append(np.bincount(key >> FEATURES_LOG2, minlength=bound[d + 1] - bound[d]).astype("<u4").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(2).slice(lo, hi - lo).cast(pa.int32()), pa.array(out, pa.binary()),
                                              pa.array(sizes, pa.binary())], ["label", "bag", "sizes"])


def _softplus(x):
    return np.logaddexp(0, x)


def _excess(s: np.ndarray, base: float, floor: float = FLOOR) -> np.ndarray:
    """-log of the chance that a sentence does not offend, by the sum of its words' weights:
    nothing up to ``floor``, so that any number of such sentences adds nothing."""
    return np.where(s > floor, _softplus(s + base) - _softplus(base), 0)


def _sums(index: np.ndarray, values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """Sum of ``values[at]`` per index.  In parts, as the wide temporary arrays are what the driver's memory is needed for."""
    out = np.zeros(n)
    for i in range(0, len(index), SUM_AT_ONCE):
        out += np.bincount(index[i:i + SUM_AT_ONCE], values[at[i:i + SUM_AT_ONCE]], n)
    return out


def fit_noisy_or(labels: np.ndarray, bags_: np.ndarray, sizes: np.ndarray, sentences: np.ndarray) -> np.ndarray:
    """Weights by full-batch Adam on the document likelihood, with an L1 penalty, so that only
    features that tell many documents apart keep a weight.  The last two are the leak (-log of
    the chance that it does not mark a document) and ``BASE``.

    ``bags_`` holds the features of all sentences of all documents one after another, ``sizes``
    the number of each sentence, ``sentences`` the number of sentences of each document.
    """
    size = 1 << FEATURES_LOG2
    weights = np.zeros(size + 2)
    weights[-1] = -30.0
    labels, sentences = labels[sentences > 0], sentences[sentences > 0]     # no sentence, nothing to learn
    if not len(labels) or labels.max() == 0:
        return weights
    first = np.concatenate([[0], np.cumsum(sentences)])
    total = int(first[-1])
    doc = np.repeat(np.arange(len(labels), dtype=np.int32), sentences)
    bound = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])[first]
    seen = np.zeros(size, np.int32)
    for a, z in zip(bound, bound[1:]):
        seen[np.unique(bags_[a:z])] += 1
    keep = seen[bags_] >= MIN_DOCUMENTS
    row = np.repeat(np.arange(total, dtype=np.int32), sizes)[keep]
    used = np.flatnonzero(seen >= MIN_DOCUMENTS)
    number = np.zeros(size, np.int32)
    number[used] = np.arange(len(used))
    at = number[bags_[keep]]
    del keep
    w, b = np.zeros(len(used)), BASE                             # b: log of the leak
    m, v, mb, vb = np.zeros(len(used)), np.zeros(len(used)), 0.0, 0.0
    penalty = min(SPARSITY, SPARSITY_SHARE * (labels > 0).sum()) / len(labels)
    for step in range(1, STEPS + 1):
        s = _sums(row, w, at, total)
        floor = 0.0 if step < FLOOR_FROM else FLOOR
        a = np.bincount(doc, _excess(s, BASE, floor), len(labels)) + np.exp(b)
        pull = np.where(labels > 0, -np.exp(-a) / np.maximum(-np.expm1(-a), 1e-9), 1.0) / len(labels)
        g = np.where(s >= floor, pull[doc] / (1 + np.exp(-s - BASE)), 0)
        gw, gb = _sums(at, g, row, len(used)), pull.sum() * np.exp(b)
        m, v = 0.9 * m + 0.1 * gw, 0.99 * v + 0.01 * gw * gw
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        scale = RATE / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-7)
        w = w - scale * m / (1 - 0.9 ** step)
        w = np.sign(w) * np.maximum(np.abs(w) - scale * penalty, 0)
        b -= RATE * mb / (1 - 0.9 ** step) / (np.sqrt(vb / (1 - 0.99 ** step)) + 1e-7)
        if step >= PRUNE_FROM and step % PRUNE_EVERY == 0:
            alive = w != 0
            here = alive[at]
            at, row = (np.cumsum(alive) - 1)[at[here]], row[here]
            used, w, m, v = used[alive], w[alive], m[alive], v[alive]
    weights[used], weights[-2], weights[-1] = w, np.exp(b), BASE
    return weights


def held_out(id_column) -> F.Column:
    """One row in five, by the CRC-32 of the id's text, is never learned from."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          label_id_col: str = "doc_id", max_rows: int = MAX_TRAINING_ROWS) -> np.ndarray:
    """Weights learned from the whole texts of at most ``max_rows`` labelled, not held-out
    documents of any length.

    Rows without a label or an id are not used; of several labels of a document the
    highest counts.  Without positive labels every score is 0.
    """
    marks = (labels.select(labels[label_id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label"))
             .where("doc_id is not null and label is not null").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("label").alias("label"))
             .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    sample = (documents(docs, id_col, text_col).where("text is not null")
              .join(F.broadcast(marks), "doc_id")                # max_rows small rows
              .groupBy("doc_id", "label").agg(F.min("text").alias("text")))   # repeated rows count once
    got = in_tasks(sample.select("doc_id", "text", "label"), _training_bags, "label int, bag binary, sizes binary").toArrow()
    if not got.num_rows:
        return fit_noisy_or(*[np.zeros(0, np.uint32)] * 4)
    marked = got["label"].to_numpy()
    # chunk by chunk, so that no second copy of all bags is made
    parts = [[K.text_column(chunk) for chunk in got[c].chunks] for c in ("bag", "sizes")]
    bag, sizes = (np.concatenate([body[off[0]:off[-1]].view("<u4") for off, body in p]) for p in parts)
    sentences = np.concatenate([np.diff(off) for off, _ in parts[1]]) // 4
    del got, parts
    return fit_noisy_or(marked, bag, sizes, sentences)


_EXTRA = [("toxic_score", T.DoubleType()), ("n_offending", T.LongType()), ("worst_start", T.LongType()),
          ("worst_end", T.LongType()), ("worst_score", T.DoubleType())]


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with five further columns, and their names: the document's score, the number
    of offending sentences (score >= 0.5), and the worst sentence's place (bytes of the UTF-8
    text) and score (null when there is none).  Names that ``docs`` already has are lengthened."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    where = docs.columns.index(text_col)
    names = {}
    for name, _ in _EXTRA:
        names[name] = fresh(docs, name)
    schema = T.StructType([*docs.schema.fields, *[T.StructField(names[n], t) for n, t in _EXTRA]])

    def run(batches):
        w = sent.value
        for batch in batches:
            for lo, hi, data, ptr in K.blocks(batch.column(where).cast(pa.string())):
                feats, sentence, doc, start, end = bags(data, ptr)
                n = hi - lo
                # a feature counts once a sentence
                key = np.unique(sentence << FEATURES_LOG2 | feats)
                s = np.bincount(key >> FEATURES_LOG2, w[key & (1 << FEATURES_LOG2) - 1], len(doc))
                c = _excess(s, w[-1])
                p = -np.expm1(-c)
                order = np.lexsort((np.arange(len(doc)), -s, doc))
                has = np.zeros(n, bool)
                has[doc] = True
                total = -np.expm1(-np.where(has, np.bincount(doc, c, n) + w[-2], 0))
                top = np.zeros(n, np.int64)
                top[doc[order[::-1]]] = order[::-1]             # the best of each document is written last
                pick = lambda x: pa.array([v if h else None for v, h in zip(x, has)])
                worst = (start[top] - ptr[:-1], end[top] - ptr[:-1], p[top]) if len(doc) else (np.zeros(n, np.int64),) * 2 + (np.zeros(n),)
                extra = [pa.array(total), pa.array(np.bincount(doc[p >= 0.5], minlength=n)),
                         pick(worst[0].tolist()).cast(pa.int64()), pick(worst[1].tolist()).cast(pa.int64()),
                         pick(worst[2].tolist()).cast(pa.float64())]
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, n).columns, *extra], schema.names)
    return in_tasks(docs, run, schema), names


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[str, str]]:
    """``train`` on the labelled, not held-out rows, then ``score`` every row's whole text.

    The score uses nothing but the text.  Null and empty texts have no sentence and score 0;
    null ids are scored and never learned from; repeated rows are scored each; an empty table
    gives an empty result.
    """
    return score(docs, train(docs, labels, id_col, text_col), text_col)
