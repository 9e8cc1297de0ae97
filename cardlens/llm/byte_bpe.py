"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier 1: a minimal perfect hash of the vocabulary resolves whole pre-tokens that are
entries themselves, all distinct pre-tokens of a block at once.  Tier 2: the others are
merged, lowest rank first, by a heap over the linked bytes of the pre-token.

The vocabulary file bounds what is broadcast.  No row moves between tasks.
"""

from __future__ import annotations

import base64
import heapq
import re
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import textkernel as K
from .common import documents, fresh, in_tasks
from .tokens import MAX_KEPT, UNSAFE

PER_BUCKET = 3          # keys in a bucket of the perfect hash, on average
TRIALS = 64             # displacements tried at a time
NARROW = 0x250          # code points of Latin texts


def read_ranks(path: str) -> dict[bytes, int]:
    """token bytes -> rank, of a rank file (base64 and number per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def key_hashes(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """64-bit hash of each byte string data[offsets[i]:offsets[i + 1]]."""
    n = len(data)
    power, inverse = K._powers(n + 1)
    total = np.zeros(n + 1, K.U64)
    np.cumsum(K.BYTE_VALUES[data] * power[:n], out=total[1:])
    a, b = offsets[:-1], offsets[1:]
    return K.mix((total[b] - total[a]) * inverse[a] + (b - a).astype(K.U64) * K.U64(K.STEP))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (lengths[0] of them), starts[1], ..."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


@dataclass
class Vocabulary:
    """Token bytes by rank, and the minimal perfect hash from token bytes to rank.

    A key's bucket holds a displacement; key and displacement give one of exactly as many slots as
    there are keys, each taken once.  A bucket of one key names its slot outright (as -slot - 1)."""
    blob: np.ndarray            # all tokens, one after another
    offsets: np.ndarray         # token i of the blob
    ranks: np.ndarray           # its rank
    displacement: np.ndarray    # of each bucket
    slots: np.ndarray           # slot -> token of the blob

    def find(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rank of each byte string, -1 where it is no entry.  Every hit is compared byte by byte."""
        n = len(offsets) - 1
        if not n or not len(self.slots):
            return np.full(n, -1, np.int64)
        h = key_hashes(data, offsets)
        d = self.displacement[(h % K.U64(len(self.displacement))).astype(np.int64)]
        slot = np.where(d < 0, -d - 1, _slots(h, d, len(self.slots)))
        entry = self.slots[slot]
        start, length = self.offsets[entry], self.offsets[entry + 1] - self.offsets[entry]
        own = offsets[1:] - offsets[:-1]
        same = own == length
        at = np.flatnonzero(same & (own > 0))
        differs = data[_ranges(offsets[at], own[at])] != self.blob[_ranges(start[at], own[at])]
        if len(at):
            same[at[np.add.reduceat(differs, np.cumsum(own[at]) - own[at], dtype=np.int64) > 0]] = False
        return np.where(same, self.ranks[entry], -1)

    def table(self) -> dict[bytes, int]:
        body, at = self.blob.tobytes(), self.offsets.tolist()
        return {body[a:b]: r for a, b, r in zip(at, at[1:], self.ranks.tolist())}


def _slots(h: np.ndarray, d, n: int) -> np.ndarray:
    d = np.asarray(d).astype(np.int64).view(K.U64)
    return (K.mix(h + d * K.U64(0x9E3779B97F4A7C15)) % K.U64(n)).astype(np.int64)


def perfect_hash(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(displacement of each bucket, key in each slot) for distinct hashes; large buckets are placed first."""
    n = len(h)
    if len(np.unique(h)) != n:
        raise ValueError("two vocabulary entries have the same 64-bit hash")
    n_buckets = -(-n // PER_BUCKET)
    bucket = (h % K.U64(max(1, n_buckets))).astype(np.int64)
    displacement, taken, slots = np.zeros(n_buckets, np.int64), np.zeros(n, bool), np.zeros(n, np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    size = np.bincount(bucket, minlength=n_buckets)
    first = np.cumsum(size) - size
    for b in np.argsort(-size, kind="stable").tolist():
        if size[b] < 2:
            break
        keys = by_bucket[first[b]:first[b] + size[b]]
        tried = 0
        while True:
            d = np.arange(tried, tried + TRIALS)
            at = _slots(h[keys][None, :], d[:, None], n)
            ordered = np.sort(at, axis=1)
            good = ~taken[at].any(axis=1) & (ordered[:, 1:] != ordered[:, :-1]).all(axis=1)
            if good.any():
                i = int(np.argmax(good))
                break
            tried += TRIALS
        displacement[b] = d[i]
        taken[at[i]] = True
        slots[at[i]] = keys
    single = np.flatnonzero(size == 1)
    free = np.flatnonzero(~taken)
    displacement[single] = -free - 1
    slots[free] = by_bucket[first[single]]
    return displacement, slots


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    ranks = read_ranks(path)
    blob = np.frombuffer(b"".join(ranks), np.uint8)
    offsets = np.cumsum([0, *map(len, ranks)])
    return Vocabulary(blob, offsets, np.fromiter(ranks.values(), np.int64, len(ranks)), *perfect_hash(key_hashes(blob, offsets)))


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: of all neighbouring parts the pair of lowest rank (the leftmost of equals)
    is joined until no pair is an entry.  O(n log n) for n bytes."""
    n = len(piece)
    rank_of, push, pop = ranks.get, heapq.heappush, heapq.heappop
    shift = n.bit_length()
    mask = (1 << shift) - 1
    end = list(range(1, n + 2))         # part that starts at i: piece[i:end[i]]
    before = list(range(-1, n))         # start of the part before it
    # pair of the part at i with the next one: rank and place in one number, -1 without an entry
    now = [-1 if (r := rank_of(piece[i:i + 2])) is None else r << shift | i for i in range(n - 1)]
    now += [-1, -1]
    heap = [x for x in now if x >= 0]
    heapq.heapify(heap)
    while heap:
        x = pop(heap)
        i = x & mask
        if now[i] != x:                 # the pair changed since
            continue
        gone = end[i]
        j = end[i] = end[gone]
        now[gone] = now[i] = -1
        if j < n:
            before[j] = i
            if (r := rank_of(piece[i:end[j]])) is not None:
                now[i] = r << shift | i
                push(heap, now[i])
        h = before[i]
        if h >= 0:
            if (r := rank_of(piece[h:j])) is not None:
                now[h] = r << shift | h
                push(heap, now[h])
            else:
                now[h] = -1
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


def _narrow(pattern: str):
    """The pattern for texts of characters below NARROW, with its Unicode classes written out, for the faster ``re``;
    None if it uses other classes."""
    import regex
    l, n, white = ("".join(re.escape(c) for c in map(chr, range(NARROW)) if regex.match(p, c)) for p in (r"\p{L}", r"\p{N}", r"\s"))
    out = pattern.replace(r"[^\s\p{L}\p{N}]", f"[^{white}{l}{n}]").replace(r"\p{L}", f"[{l}]").replace(r"\p{N}", f"[{n}]")
    out = out.replace(r"\S", f"[^{white}]").replace(r"\s", f"[{white}]")
    return None if re.search(r"\\[pPdDwWbB]", out) else re.compile(out)


class Splitter:
    """Pre-tokens of a text as the library's own pattern engine cuts it.

    That engine knows an older Unicode version.  In a text with a character that may differ, such characters
    are replaced, one for one, by a stand-in of the class they have there; the places found cut the text itself."""

    STAND_IN = {r"\p{L}": "é", r"\p{N}": "²", r"\s": " "}
    OTHER = "¤"

    def __init__(self, pattern: str):
        import regex
        self.pattern = regex.compile(pattern)
        self.narrow = _narrow(pattern)
        self.beyond = re.compile(f"[^\x00-{chr(NARROW - 1)}]")
        self.known: dict[str, str] = {}
        self.engines = None

    def _class(self, c: str) -> str:
        if c not in self.known:
            import tiktoken
            if self.engines is None:
                single = {bytes([i]): i for i in range(256)}
                self.engines = [(x, tiktoken.Encoding("class", pat_str=p, mergeable_ranks=single, special_tokens={}))
                                for p, x in self.STAND_IN.items()]
            self.known[c] = next((x for x, e in self.engines if e.encode_ordinary(c)), self.OTHER)
        return self.known[c]

    def __call__(self, text: str) -> list[str]:
        if self.narrow and (text.isascii() or not self.beyond.search(text)):
            return self.narrow.findall(text)
        if not UNSAFE.search(text):
            return self.pattern.findall(text)
        like = UNSAFE.sub(lambda m: self._class(m[0]), text)
        return [text[m.start():m.end()] for m in self.pattern.finditer(like)]


class Encoder:
    """Ids of texts.  Each distinct pre-token of a call is resolved once; answers are kept up to a bound."""

    def __init__(self, vocabulary: Vocabulary, pattern: str):
        self.vocabulary = vocabulary
        self.ranks = vocabulary.table()
        self.split = Splitter(pattern)
        self.kept: dict[str, bytes] = {}

    def resolve(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of distinct pre-tokens: the perfect hash first, the heap for those it lacks."""
        offsets, data = K.text_column(pa.array(pieces, pa.large_string()))
        rank = self.vocabulary.find(data, offsets)
        body = rank.astype("<u4").tobytes()
        out = [body[i:i + 4] for i in range(0, len(body), 4)]
        for i in np.flatnonzero(rank < 0).tolist():
            out[i] = array("I", merge(pieces[i].encode(), self.ranks)).tobytes()
        return out

    def __call__(self, texts: list[str]) -> list[bytes]:
        """Packed ids (unsigned 32-bit little-endian) of each text."""
        lists = [self.split(t) for t in texts]
        new = list(set().union(*lists).difference(self.kept))
        known = self.kept
        known.update(zip(new, self.resolve(new)))
        out = [b"".join(map(known.__getitem__, x)) for x in lists]
        if len(known) > MAX_KEPT:       # full: this call's new pieces are not kept
            for piece in new:
                del known[piece]
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens and ids (binary: unsigned 32-bit little-endian token ids) of each whole text, one row per row.

    Null and empty texts have no ids (an empty binary); a null id stays null; repeated rows stay repeated; an
    empty table gives an empty result; other columns are not read.  Texts of any length are encoded whole.  Special
    strings are ordinary text.  A pre-token of a vocabulary without some single byte raises ``KeyError``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary(ranks_path))
    name = (ranks_path, pattern)

    def run(batches):
        if name not in _ENCODERS:
            _ENCODERS[name] = Encoder(shared.value, pattern)
        encoder = _ENCODERS[name]
        for batch in batches:
            for lo, hi, _, _ in K.blocks(batch.column(1)):
                ids = encoder([x or "" for x in batch.column(1).slice(lo, hi - lo).to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo).cast(pa.int64()), pa.array([len(x) // 4 for x in ids], pa.int64()),
                     pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids"])
    return in_tasks(documents(docs, id_col, text_col), run, "doc_id long, n_tokens long, ids binary", tokenizer=True)


def decode(rows: DataFrame, ranks_path: str, ids_col: str = "ids", out: str = "decoded") -> tuple[DataFrame, str]:
    """``rows`` with the bytes (binary) that the ids of ``ids_col`` (as ``encode`` writes them) stand for, and the new
    column's name, lengthened if ``rows`` has one of that name.  Null stays null; an id that the vocabulary lacks
    raises ``ValueError``, as does a binary whose size is no multiple of four."""
    shared = rows.sparkSession.sparkContext.broadcast(vocabulary(ranks_path))
    name, where = fresh(rows, out), rows.columns.index(ids_col)
    schema = T.StructType([*rows.schema.fields, T.StructField(name, T.BinaryType())])

    def run(batches):
        v = shared.value
        entry = np.full(int(v.ranks.max(initial=-1)) + 1, -1, np.int64)
        entry[v.ranks] = np.arange(len(v.ranks))
        for batch in batches:
            texts = []
            for packed in batch.column(where).to_pylist():
                if packed is None:
                    texts.append(None)
                    continue
                ids = np.frombuffer(packed, "<u4").astype(np.int64)
                if len(ids) and (int(ids.max()) >= len(entry) or (entry[ids] < 0).any()):
                    raise ValueError("an id that the vocabulary lacks")
                at = entry[ids]
                texts.append(v.blob[_ranges(v.offsets[at], v.offsets[at + 1] - v.offsets[at])].tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.binary())], schema.names)
    return in_tasks(rows, run, schema, tokenizer=True), name
