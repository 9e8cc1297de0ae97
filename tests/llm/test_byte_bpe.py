import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from cardlens.llm import byte_bpe as B
from cardlens.llm import queries as Q

from .helpers import EDGES, key, prose, table

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
EXTRA = [(100, "a" * 5000 + " " + "ab" * 2000), (101, "<|endoftext|> x's 'll  \n\n 123 ²³"), (102, "՘ࢎ࢏ aᇞ0 \U00016ff4\U000187f8a \U00011de01"),
         (103, "\x00\x1f\x85  z"), (None, "it's")]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=B.read_ranks(PATH), special_tokens={})


def ids(packed):
    return np.frombuffer(packed, "<u4").tolist()


def test_perfect_hash_is_minimal_and_exact():
    v = B.vocabulary(PATH)
    assert sorted(v.slots.tolist()) == list(range(len(v.ranks)))
    ranks = B.read_ranks(PATH)
    r = random.Random(3)
    strange = [bytes(r.randrange(256) for _ in range(r.randrange(12))) for _ in range(3000)] + [b""]
    asked = list(ranks) + strange
    body, at = np.frombuffer(b"".join(asked), np.uint8), np.cumsum([0, *map(len, asked)])
    assert v.find(body, at).tolist() == [ranks.get(x, -1) for x in asked]


@pytest.mark.parametrize("n", [1, 2, 3, 50, 1000])
def test_perfect_hash_of_any_size(n):
    h = B.K.mix(np.arange(1, n + 1, dtype=np.uint64))
    displacement, slots = B.perfect_hash(h)
    assert sorted(slots.tolist()) == list(range(n))


def test_merge_equals_plain_merging():
    ranks = B.read_ranks(PATH)
    r = random.Random(5)

    def plain(piece):
        parts = [piece[i:i + 1] for i in range(len(piece))]
        while True:
            found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
            if not found:
                return [ranks[p] for p in parts]
            i = min(found)[1]
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
    for _ in range(1500):
        piece = "".join(r.choice(["a", "b", "th", "e", "ing", "é", "\U0001f600", "aa"]) for _ in range(r.randrange(1, 20))).encode()
        assert B.merge(piece, ranks) == plain(piece)


def test_texts_equal_the_library(library):
    encoder = B.Encoder(B.vocabulary(PATH), public_tokenizers.PATTERN)
    r, texts = random.Random(1), [t or "" for _, t in EDGES + EXTRA]
    for _ in range(600):
        pool = r.choice(["abcdefghij '", "abcXYZ 0123 .,\n\t'", "".join(chr(c) for c in [r.randrange(0x110000) for _ in range(30)] if not 0xD800 <= c < 0xE000) + " a1'"])
        texts.append("".join(r.choice(pool) for _ in range(r.randrange(150))))
    assert [ids(x) for x in encoder(texts)] == [library.encode_ordinary(t) for t in texts]


def test_full_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(B, "MAX_KEPT", 3)
    encoder = B.Encoder(B.vocabulary(PATH), public_tokenizers.PATTERN)
    texts = [prose(i, 50) for i in range(5)]
    for _ in range(2):
        assert [ids(x) for x in encoder(texts)] == [library.encode_ordinary(t) for t in texts]
        assert len(encoder.kept) <= 3


def test_round_trip(spark, library):
    rows = EDGES + EXTRA
    encoded = B.encode(table(spark, rows, clash=["ids", "n_tokens"]), PATH, public_tokenizers.PATTERN)
    out, name = B.decode(encoded.withColumn("decoded", F.lit(1)), PATH)
    assert name == "decoded_"
    got = [(r.doc_id, r.n_tokens, ids(r.ids), bytes(r[name])) for r in out.collect()]
    want = [(i, len(x), x, (t or "").encode()) for i, t in rows for x in [library.encode_ordinary(t or "")]]
    assert sorted(got, key=lambda r: (key(r[:2]), r[2])) == sorted(want, key=lambda r: (key(r[:2]), r[2]))


def test_empty_and_wrong_ids(spark):
    assert B.encode(table(spark, []), PATH, public_tokenizers.PATTERN).collect() == []
    rows = spark.createDataFrame([(1, None), (2, bytearray())], "k int, ids binary")
    out, name = B.decode(rows, PATH)
    assert {r.k: r[name] for r in out.collect()} == {1: None, 2: bytearray()}
    with pytest.raises(Exception, match="lacks"):
        B.decode(spark.createDataFrame([(1, bytearray(b"\xff\xff\xff\x00"))], "k int, ids binary"), PATH)[0].collect()


def test_query(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in Q.op12_byte_bpe(spark, sf).collect()}
    want = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        x = library.encode_ordinary(r.text or "")
        want.add((r.doc_id, len(x), hashlib.sha256(np.array(x, "<u4").tobytes()).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert got == want
