"""Token ids and counts with the vocabulary files of public tokenizers.

Both readers cut a text where the library's own pre-tokenizer always cuts, and
keep the ids (or the count) of each distinct piece, so a piece that was seen
before costs one dictionary look-up.  The tables are bounded: when full, further
pieces are encoded but not kept.  Files are read once per Python worker.
"""

from __future__ import annotations

import os
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MAX_KEPT = 600_000


@lru_cache(maxsize=4)
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs one task per core already
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


class _Kept(dict):
    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, piece):
        value = self.make(piece)
        if len(self) < MAX_KEPT:
            self[piece] = value
        return value


class WordIds:
    """Ids of a tokenizer whose pre-tokenizer drops white space.  A text is cut at
    ASCII blanks and line breaks only; the library does all the rest of each piece
    (normalizing, special strings, merges), so ids equal those of the whole text.

    Each distinct piece of a call is looked up once; new pieces go to the library
    many at a time, parted by a character that is one token of its own.
    """

    MARK = "\x01"
    AT_ONCE = 4000

    def __init__(self, path: str, end_id: int):
        self.tokenizer = load(path)
        self.end_id = end_id
        self.size = max(self.tokenizer.get_vocab_size(True), end_id + 1)
        whole, first, second = self._ids(["Ab  Cd\n", "ab", "cd"])
        if whole.tolist() != [*first.tolist(), *second.tolist()]:
            raise ValueError(f"{path} keeps case or white space: its ids cannot be put together from pieces cut at blanks")
        self.kept: dict[str, bytes] = {}
        mark = self._ids([self.MARK])[0]
        self.mark = int(mark[0]) if len(mark) == 1 else None

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, new: list[str]) -> None:
        alone = new if self.mark is None else [p for p in new if self.MARK in p]
        for piece, ids in zip(alone, self._ids(alone)):
            self.kept[piece] = ids.tobytes()
        together = [] if self.mark is None else [p for p in new if self.MARK not in p]
        for i in range(0, len(together), self.AT_ONCE):
            part = together[i:i + self.AT_ONCE]
            (ids,) = self._ids([f" {self.MARK} ".join([*part, ""])])
            cut = np.flatnonzero(ids == self.mark).tolist()
            body, at = ids.tobytes(), 0
            for piece, c in zip(part, cut, strict=True):
                self.kept[piece] = body[4 * at:4 * c]
                at = c + 1

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text of a string column with the end id, as unsigned 32-bit
        integers; null is the empty text."""
        if not len(texts):
            return []
        texts = texts.cast(pa.large_string()).fill_null("")
        # ASCII texts are lower-cased here, as the library would: fewer distinct pieces.
        # Not where a special string could come about.
        plain = pc.and_(pc.string_is_ascii(texts), pc.invert(pc.match_substring(texts, "<|")))
        texts = pc.if_else(plain, pc.utf8_lower(texts), texts)
        for white in "\n\t\r":
            texts = pc.replace_substring(texts, white, " ")
        # a mark alone between a letter or digit and a blank is a pre-token of its own
        texts = pc.replace_substring_regex(texts, "([A-Za-z0-9])([.,]) ", r"\1 \2 ")
        lists = pc.split_pattern(texts, " ")
        pieces = lists.flatten().dictionary_encode()
        distinct = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = list(map(self.kept.get, distinct))
        missing = [i for i, ids in enumerate(parts) if ids is None]
        new = [distinct[i] for i in missing]
        self._add(new)
        for i, piece in zip(missing, new):
            parts[i] = self.kept[piece]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        flat = np.frombuffer(b"".join(parts), "<u4")
        index = pieces.indices.to_numpy()
        length = sizes[index]
        stop = np.cumsum(length)
        first = (np.cumsum(sizes) - sizes)[index] - (stop - length)
        ids = flat[np.arange(stop[-1] if len(stop) else 0) + np.repeat(first, length)]
        at = np.concatenate([[0], stop])[np.asarray(lists.offsets) - lists.offsets[0].as_py()]
        if len(self.kept) > MAX_KEPT:       # full: this call's new pieces are not kept
            for piece in new:
                del self.kept[piece]
        return [np.append(ids[a:b], np.uint32(self.end_id)).astype("<u4", copy=False) for a, b in zip(at, at[1:])]


@lru_cache(maxsize=4)
def word_ids(path: str, end_id: int) -> WordIds:
    return WordIds(path, end_id)


#: fixed value: the pattern that cuts a text before byte-level merges
PRE_TOKEN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: fixed values: ranges in which the pattern's classes here and in the tokenizer's library agree for
#: every character (they know different Unicode versions); a text with any other one is left to the library
SAFE = [(0x0, 0x557), (0x58D, 0x88E), (0x890, 0xC5B), (0xCDD, 0x208E), (0x20A0, 0xA7CD), (0xAB6E, 0xD7FF), (0xE000, 0x107BA), (0x1E700, 0x2B739)]
UNSAFE = re.compile("[^" + "".join(f"{chr(a)}-{chr(b)}" for a, b in SAFE).replace("\x00", "\\x00") + "]")


def whole_tokens(path: str) -> set[str]:
    """Vocabulary strings proven to be one token when they stand alone as a pre-token:
    the pattern keeps them in one piece and the merges rebuild exactly that entry."""
    import regex
    pattern, whole = regex.compile(PRE_TOKEN), set()
    tokenizer = _unsplit(path)
    special = set(tokenizer.get_added_tokens_decoder())
    ids = [i for i in range(tokenizer.get_vocab_size(True)) if i not in special]
    for i, text in zip(ids, tokenizer.decode_batch([[i] for i in ids], skip_special_tokens=False)):
        if text and "�" not in text and pattern.fullmatch(text) and pattern.findall(text) == [text]:
            if tokenizer.encode(text, add_special_tokens=False).ids == [i]:
                whole.add(text)
    return whole


def _unsplit(path: str):
    """The tokenizer without its own cutting: what it is given is one pre-token."""
    from tokenizers import Tokenizer, pre_tokenizers
    t = Tokenizer.from_str(load(path).to_str())
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return t


class ByteCounts:
    """Token counts of a byte-level tokenizer with the whole-token shortcut:
    pre-tokens in ``whole`` count one, only the others are merged."""

    def __init__(self, path: str, whole: frozenset[str]):
        import regex
        self.find = regex.compile(PRE_TOKEN).findall
        tokenizer = _unsplit(path)
        self.specials = [a.content for a in load(path).get_added_tokens_decoder().values()]
        self.kept = _Kept(lambda s: len(tokenizer.encode(s, add_special_tokens=False).ids))
        self.count_all = lambda s: len(load(path).encode(s, add_special_tokens=False).ids)
        self.kept.update(dict.fromkeys(whole, 1))

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        if not text.isascii() and UNSAFE.search(text):
            return self.count_all(text)
        n, parts = 0, [text]
        for s in self.specials:     # a special string inside a text is one token, as is the library's default
            if s in text:
                cut = [p.split(s) for p in parts]
                n += sum(len(c) - 1 for c in cut)
                parts = [p for c in cut for p in c]
        one = self.kept.__getitem__
        for p in parts:
            n += sum(map(one, self.find(p)))
        return n


_COUNTERS: dict[str, ByteCounts] = {}


def byte_counts(path: str, whole) -> ByteCounts:
    """The worker's counter of a vocabulary file; ``whole()`` gives its proven tokens."""
    if path not in _COUNTERS:
        _COUNTERS[path] = ByteCounts(path, whole())
    return _COUNTERS[path]


def forget() -> None:
    """Drop tokenizers and what was kept of their answers."""
    word_ids.cache_clear()
    load.cache_clear()
    _COUNTERS.clear()
    pa.default_memory_pool().release_unused()
