"""Word hashing over Arrow string columns.

Tasks receive Arrow batches and hash every word of a block of texts at once: a
cumulative sum of ``table[byte] * R**position`` gives each word's polynomial
hash by one subtraction.  No Python object is made per word, and a block is at
most ``BLOCK_BYTES`` of text (one longer document is its own block), so memory
does not depend on how many rows a batch holds.  Hashes are 64 bits wide.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
BASE = 0x5851F42D4C957F2D          # odd, so it has an inverse modulo 2**64
BASE_INVERSE = pow(BASE, -1, 1 << 64)
STEP = 0x9FB21C651E98DF25          # base of the word-level polynomial
_POWERS: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, b in enumerate((BASE, BASE_INVERSE)):
            p = np.full(n, b, dtype=U64)
            p[0] = 1
            _POWERS[i] = np.multiply.accumulate(p)
    return _POWERS[0], _POWERS[1]


def byte_classes(is_word) -> np.ndarray:
    """256 entries: 0 for separators, else the byte with A-Z lower-cased."""
    t = np.zeros(256, np.uint8)
    for b in range(256):
        low = b + 32 if 65 <= b <= 90 else b
        if is_word(low):
            t[b] = low
    return t


#: words are runs of anything but white space (space, tab, line breaks)
SPACED = byte_classes(lambda b: b != 0 and b != 32 and not 9 <= b <= 13)
SPACED[0] = 65  # NUL is a word byte too; the code of 'A' is free, as A-Z are lower-cased
#: words are runs of digits, letters and non-ASCII characters
ALNUM = byte_classes(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)


def text_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; null is the empty text."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if pa.types.is_null(col.type):
        col = pa.array([""] * len(col))
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64) \
        if len(col) else np.zeros(1, np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return off, body


def blocks(col: pa.Array, max_bytes: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, document offsets in them) for row runs of bounded text."""
    off, body = text_column(col)
    n, lo = len(off) - 1, 0
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + max_bytes, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi, body[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


@dataclass
class Words:
    hashes: np.ndarray   # one per word
    ptr: np.ndarray      # words of document d: ptr[d] to ptr[d + 1]
    starts: np.ndarray   # byte offsets in the block
    ends: np.ndarray
    acc: np.ndarray      # running polynomial sum, for hashes of word prefixes

    def prefix(self, size: int) -> np.ndarray:
        """Hash of each word's first ``size`` bytes (or of the whole shorter word)."""
        stop = np.minimum(self.ends, self.starts + size)
        return mix((self.acc[stop] - self.acc[self.starts]) * _powers(len(self.acc))[1][self.starts] + U64(size))


def words(data: np.ndarray, ptr: np.ndarray, classes: np.ndarray = SPACED) -> Words:
    n = len(data)
    mapped = classes[data]
    inside = mapped > 0
    fresh = np.zeros(n + 1, bool)
    fresh[ptr[:-1]] = True
    edge = fresh[1:n] if n else fresh[:0]
    begin, end = inside.copy(), inside.copy()
    if n:
        begin[1:] &= ~inside[:-1] | edge
        end[:-1] &= ~inside[1:] | edge
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    power, inverse = _powers(n + 1)
    acc = np.zeros(n + 1, U64)
    np.cumsum(BYTE_VALUES[mapped] * power[:n], out=acc[1:])
    hashes = mix((acc[ends] - acc[starts]) * inverse[starts])
    return Words(hashes, np.searchsorted(starts, ptr), starts, ends, acc)


def grams(hashes: np.ndarray, offsets) -> np.ndarray:
    """Hash of the words at ``i + offsets`` for each start i; starts whose window
    leaves its document are the caller's to skip."""
    span = max(offsets) + 1
    m = len(hashes) - span + 1
    if m <= 0:
        return np.zeros(0, U64)
    out, factor = np.zeros(m, U64), 1
    for j in offsets:
        factor = factor * STEP % (1 << 64)
        out += hashes[j:j + m] * U64(factor)
    return mix(out + U64(span))


def spans(ptr: np.ndarray, span: int) -> Iterator[tuple[int, int, int]]:
    """(document, first start, last start + 1) for each document with at least ``span`` words."""
    for d in range(len(ptr) - 1):
        if ptr[d + 1] - ptr[d] >= span:
            yield d, int(ptr[d]), int(ptr[d + 1]) - span + 1


def inside_document(ptr: np.ndarray, span: int, m: int) -> np.ndarray:
    """Which of the m gram starts have their whole window in one document."""
    ok = np.ones(m, bool)
    for p in ptr[1:-1]:
        ok[max(0, p - span + 1):p] = False
    return ok


def shingle_sets(data: np.ndarray, ptr: np.ndarray, size: int = 5) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document.  A document of fewer words
    has its whole word sequence as one shingle; one without words has none."""
    w = words(data, ptr)
    g = grams(w.hashes, range(size))
    out = []
    for d in range(len(ptr) - 1):
        a, b = int(w.ptr[d]), int(w.ptr[d + 1])
        if b - a >= size:
            out.append(np.unique(g[a:b - size + 1]))
        elif b > a:
            out.append(grams(w.hashes[a:b], range(b - a)))
        else:
            out.append(np.zeros(0, U64))
    return out


def set_id(shingles: np.ndarray) -> int:
    """Signed 64-bit id of a shingle set, the same for equal sets."""
    if not len(shingles):
        return 0
    with np.errstate(over="ignore"):
        total = mix(shingles + U64(0x632BE59BD9B4E019)).sum(dtype=U64) + U64(len(shingles)) * U64(BASE)
        return int(mix(np.array([total], U64)).view(np.int64)[0])


def bits_of(hashes: np.ndarray, size_log2: int) -> np.ndarray:
    """Bit positions of hashes in a table of 2**size_log2 bits."""
    return (hashes >> U64(64 - size_log2)).astype(np.int64)


def has_bit(table: np.ndarray, hashes: np.ndarray, size_log2: int) -> np.ndarray:
    """Whether each hash's bit is set; ``table`` is a byte array of 2**size_log2 bits."""
    b = bits_of(hashes, size_log2)
    return (table[b >> 3] >> (b & 7).astype(np.uint8)) & 1 > 0
