import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from cardlens.llm import queries as Q
from cardlens.llm import spelling as S

from .helpers import EDGES, lower, table


def one_apart(a, b):
    """Exactly one inserted, deleted or replaced character."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def words_of(rows, delete_every=None, min_length=6, min_count=5):
    n = Counter()
    for key, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = lower(w)
            h = crc32(f"{'' if key is None else key}:{w}".encode())
            if delete_every and h % delete_every == 0:
                i = h % len(w)
                w = w[:i] + w[i + 1:]
            n[w] += 1
    return {w: c for w, c in n.items() if len(w) >= min_length and c >= min_count}


def brute(n, ratio=5):
    near = {w: [v for v in n if one_apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] is not None else None) for w in n}


def variants(spark, n, **options):
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    got = [tuple(r) for r in S.spelling_variants(df, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


def vocabulary(seed, n, alphabet="abé÷", lengths=(6, 14)):
    r, out = random.Random(seed), {}
    while len(out) < n:
        w = "".join(r.choice(alphabet) for _ in range(r.randint(*lengths)))
        for _ in range(r.randrange(5)):
            out[w] = int(5 * 6 ** r.uniform(0, 5))
            i = r.randrange(max(1, len(w)))
            w = r.choice([w[:i] + w[i + 1:], w[:i] + r.choice(alphabet) + w[i:], w[:i] + r.choice(alphabet) + w[i + 1:]])
    return {w: c for w, c in out.items() if len(w) > 1}


@pytest.mark.parametrize("levels", [1, 2, 3, 5])
def test_equals_all_pairs(spark, levels):
    n = vocabulary(levels, 300)
    assert variants(spark, n, levels=levels) == brute(n)


def test_short_words_and_long_ones(spark):
    n = vocabulary(11, 200, "ab", (2, 6)) | vocabulary(12, 30, "ab", (200, 230))
    assert variants(spark, n) == brute(n)


def test_every_single_edit_is_found(spark):
    base = "abcdefghijk"
    edits = {base[:i] + c + base[i + k:] for i in range(len(base) + 1) for c in ("", "x", "b") for k in (0, 1)} - {base}
    edits = {e for e in edits if one_apart(e, base)}
    n = {base: 1000, **{e: 5 for e in edits}}
    got = variants(spark, n)
    assert got == brute(n)
    assert {w for w, form, *_ in got if form == base} == edits


def test_words_that_share_a_beginning_meet_rarely(spark):
    r = random.Random(2)
    words = {"international" + "".join(r.choice("abcdefghij") for _ in range(9)) for _ in range(400)}
    df = spark.createDataFrame([(w, 5) for w in words], "word string, n long")
    keys = S._keys(df, 0, S.LEVELS).groupBy("key").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    alone = S._keys(df, 0, 1).groupBy("key").count().agg(F.sum(F.col("count") * (F.col("count") - 1) / 2)).first()[0]
    assert alone > 70_000 and keys < alone / 20


def test_roots_follow_long_ways(spark):
    n = {"aaaaaa" + "b" * i: 7 ** (12 - i) for i in range(12)} | {"zzzzzzz": 5}
    got = variants(spark, n)
    assert got == brute(n) and {root for *_, root, a, b, c in [(w, r, x, y, z) for w, f, r, x, y, z in got]} == {"aaaaaa", "zzzzzzz"}


def test_ties(spark):
    n = {"aaaaaaa": 5, "aaaaaaé": 50, "aaaaaab": 50, "aaaaaa": 25, "çaaaaaa": 50}
    assert variants(spark, n) == brute(n)


def test_counts_of_texts(spark):
    r = random.Random(4)
    words = ["Seguro", "maison", "ÉTÉétait", "reliable", "a", "ponder÷×", "colour", "colours"]
    rows = [(r.choice([None, i]), "1".join(r.choice(words) + r.choice(["", "s", " "]) for _ in range(r.randrange(60)))) for i in range(200)] + EDGES
    for every in (None, 3):
        df = S.count_words(table(spark, rows, clash=["word", "n"]), delete_every=every)
        assert {r.word: r.n for r in df.collect()} == words_of(rows, every)


def test_counts_beyond_a_flush(spark, monkeypatch):
    monkeypatch.setattr(S, "FLUSH", 5)
    rows = [(i, " ".join(f"word{chr(97 + j)}" for j in range(20))) for i in range(12)]
    assert {r.word: r.n for r in S.count_words(table(spark, rows).coalesce(1), min_length=5).collect()} == words_of(rows, None, 5)


def test_empty_and_wrong(spark):
    assert S.count_words(table(spark, [])).collect() == []
    assert variants(spark, {"abcdef": 9}) == {("abcdef", None, "abcdef", 9, 0, None)}
    assert S.spelling_variants(S.count_words(table(spark, []))).collect() == []
    with pytest.raises(ValueError):
        S.spelling_variants(S.count_words(table(spark, [])), ratio=1)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in Q.op13_spelling_variants(spark, sf).select("word", "form", "root", "n", "n_near", "form_n").collect()}
    assert got == brute(words_of(rows, 199))
