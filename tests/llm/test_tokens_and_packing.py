import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex

from cardlens.llm import balanced, best_fit, packgroup
from cardlens.llm.token_counts import token_counts
from cardlens.llm.tokens import PRE_TOKEN, ByteCounts, WordIds, load, whole_tokens

from .helpers import EDGES, prose, table

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = [" ", "  ", "\n", "\t", "a", "Foo", "it's", "'ll", "!'s", "<|endoftext|>", "<|startoftext|>", "1", "12a", "é", " ́", "中文", "…", "😀",
          "\x1c", "\x85", " ", "　", "ſ", "İ", "ΑΣ", "՘", "ⅷ", "Ⱟ", "\U0003fc3b"]


def random_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice(PIECES) for _ in range(r.randrange(12))) for _ in range(n)]


def test_word_ids_equal_the_library():
    texts = random_texts(5000)
    t, own = load(WORD), WordIds(WORD, 1)
    for a, b in zip(own(pa.array(texts)), t.encode_batch(texts, add_special_tokens=False)):
        assert a.tolist() == b.ids + [1]


def test_byte_counts_equal_the_library():
    texts = random_texts(5000, 2)
    t, own = load(BYTE), ByteCounts(BYTE, frozenset(whole_tokens(BYTE)))
    for x, e in zip(texts, t.encode_batch(texts, add_special_tokens=False)):
        assert own(x) == len(e.ids), x


def test_whole_tokens_are_single():
    whole, t = whole_tokens(BYTE), load(BYTE)
    assert len(whole) > 45000 and " the" in whole and "<|endoftext|>" not in whole
    for e in t.encode_batch(random.Random(3).sample(sorted(whole), 3000), add_special_tokens=False):
        assert len(e.ids) == 1


def test_token_counts_rows(spark):
    df = table(spark, EDGES, clash=["n_tokens", "over_limit"])
    t = load(BYTE)
    want = sorted([(i or -1, len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False).ids)) for i, x in EDGES])
    out = token_counts(df, BYTE, 512).collect()
    assert sorted([(r.doc_id or -1, r.n_bytes, r.n_tokens) for r in out]) == want
    assert all(r.over_limit == (r.n_tokens > 512) for r in out)
    assert token_counts(table(spark, []), BYTE, 512).collect() == []


def test_best_fit_equals_a_search_of_all_bins():
    r = random.Random(3)
    for _ in range(200):
        capacity = r.choice([1, 2, 7, 16, 64, 100])
        lengths = [r.randint(1, capacity) for _ in range(r.randint(0, 80))]
        free = []
        for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
            fits = [f for f in free if f >= lengths[i]]
            if fits:
                free.remove(min(fits))
            free.append((min(fits) if fits else capacity) - lengths[i])
        bins = best_fit.best_fit_decreasing(lengths, capacity)
        assert sorted(capacity - sum(lengths[i] for i in b) for b in bins) == sorted(free)
        assert sorted(i for b in bins for i in b) == list(range(len(lengths)))


def test_cheapest_sequence_with_room():
    r = random.Random(4)
    for _ in range(50):
        capacity, tree, brute = 64, balanced.CheapestTree(64), {}
        for s in range(40):
            brute[s] = (r.randrange(65), round(r.random(), 2))
            tree.put(brute[s][0], brute[s][1], s)
        for _ in range(60):
            need = r.randrange(1, 65)
            want = min(((c, s) for s, (f, c) in brute.items() if f >= need), default=None)
            assert tree.take(need) == want
            if want:
                f = brute.pop(want[1])[0]
                tree.remove(f)


def test_balance_keeps_every_id_without_padding():
    r = random.Random(5)
    for _ in range(100):
        capacity = r.choice([1, 2, 8, 64])
        pieces = [(i, 0, r.randint(1, capacity)) for i in range(r.randint(0, 60))]
        out = balanced.balance(pieces, capacity, 1.0, 0.01)
        assert all(sum(n for *_, n in held) == size for size, _, held in out)
        assert sorted((d, s + k) for *_, held in out for d, s, n in held for k in range(n)) == \
            sorted((d, k) for d, _, n in pieces for k in range(n))


ROWS = EDGES + [(100 + i, prose(i, 30 + 17 * i)) for i in range(60)]


@pytest.mark.parametrize("capacity,group", [(2048, 4_000_000), (64, 5000)])
def test_packed_ids_round_trip(spark, capacity, group):
    df = table(spark, ROWS, clash=["starts", "cost", "sequence_id"]).repartition(3)
    want = sorted((i or -1, x.tobytes()) for (i, t) in ROWS for x in WordIds(WORD, 1)(pa.array([t], pa.string())))
    best = best_fit.pack_best_fit(df, WORD, 1, capacity, group_tokens=group).collect()
    even = balanced.pack_balanced(df, WORD, 1, capacity, group_tokens=group).collect()
    for rows in (best, even):
        assert len({r.sequence_id for r in rows}) == len(rows)
        parts = []
        for r in rows:
            ids = np.frombuffer(r.input_ids, "<u2").astype("<u4")
            assert len(ids) == r.capacity and not ids[r.n_tokens:].any() and r.cu_seqlens[-1] == r.n_tokens
            assert r.position_resets == r.cu_seqlens[:-1]
            p = packgroup.position_ids(r.position_resets, r.n_tokens)
            assert all(p[a] == 0 and p[b - 1] == b - a - 1 for a, b in zip(r.cu_seqlens, r.cu_seqlens[1:]))
            parts += [(d or -1, t, s, ids[a:b]) for d, t, s, a, b in zip(r.doc_ids, r.doc_tokens, r.starts, r.cu_seqlens, r.cu_seqlens[1:])]
        assert sum(len(p[3]) for p in parts) == sum(len(x) // 4 for _, x in want)
        whole = [p for p in parts if len(p[3]) == p[1]]
        cut = {}
        for d, t, s, x in parts:
            if len(x) < t:
                cut.setdefault((d, t), {}).setdefault(s, []).append(x.tobytes())
        joined = [(d, x.tobytes()) for d, _, _, x in whole]
        for (d, t), by in cut.items():      # equal rows have equal pieces, so each start is there as often as the row
            copies = sum(len(v) for v in by.values() if v) and max(len(v) for v in by.values())
            if len({len(v) for v in by.values()}) == 1:
                joined += [(d, b"".join(v[0] for _, v in sorted(by.items())))] * copies
        assert set(joined) <= set(want)
    assert all(r.n_tokens == r.capacity for r in even)
    assert all(r.capacity == capacity or r.capacity & (r.capacity - 1) == 0 for r in even)
    assert len(best) <= sum(len(x) // 4 for _, x in want) / capacity * 1.2 + 3 * 8


def test_pieces(spark):
    rows = [(i, prose(i, 200 * i)) for i in range(8)] + [(50, None), (51, "")]
    out = balanced.pieces(balanced.pack_balanced(table(spark, rows), WORD, 1, 256)).collect()
    ids = {i: WordIds(WORD, 1)(pa.array([t], pa.string()))[0] for i, t in rows}
    for r in out:
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start:r.start + r.length].tobytes())
        assert r.doc_tokens == len(ids[r.doc_id])
    for i, x in ids.items():
        assert sorted(k for r in out if r.doc_id == i for k in range(r.start, r.start + r.length)) == list(range(len(x)))
    for s in {r.sequence_id for r in out}:
        at = 0
        for r in sorted((r for r in out if r.sequence_id == s), key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == 256 or at & (at - 1) == 0


def test_empty_tables(spark):
    assert best_fit.pack_best_fit(table(spark, []), WORD, 1).collect() == []
    assert balanced.pieces(balanced.pack_balanced(table(spark, []), WORD, 1)).collect() == []


def test_pattern_is_the_libraries_on_safe_characters():
    from cardlens.llm.tokens import SAFE
    cut, own = load(BYTE).pre_tokenizer, regex.compile(PRE_TOKEN)
    for a, b in SAFE:
        for c in range(a, b + 1, 1 if b - a < 5000 else 97):
            s = f"a{chr(c)}1{chr(c)}! {chr(c)}{chr(c)}"
            assert [x for _, x in cut.pre_tokenize_str(s)] == [m.span() for m in own.finditer(s)], hex(c)


def test_tokenizers_that_do_not_fit_raise(spark):
    from cardlens.llm.best_fit import pack_best_fit
    docs = table(spark, [(1, "Some text")])
    with pytest.raises(Exception, match="keeps case or white space"):
        pack_best_fit(docs, public_tokenizers.path("byte_bpe_50k.json"), 1, 16).collect()
    with pytest.raises(Exception, match="more than 2 bytes"):
        pack_best_fit(docs, public_tokenizers.path("word_bpe_49k.json"), 70_000, 16).collect()
    assert pack_best_fit(docs, public_tokenizers.path("word_bpe_49k.json"), 70_000, 16, id_bytes=4).count() == 1
