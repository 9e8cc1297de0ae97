import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardlens.llm import decontaminate as D
from cardlens.llm import licenses as L
from cardlens.llm import textkernel as K
from cardlens.llm import toxicity as T

from .helpers import EDGES, prose, table

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


# ---- decontamination
def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def passage(seed, n):
    r = random.Random(seed)
    return [f"b{r.randrange(5000)}" for _ in range(n)]


def test_overlaps_with_substitutions(spark):
    r = random.Random(1)
    bench = [(i, passage(i, 15 + i)) for i in range(20)]
    docs, expect = [], set()
    for i, (item, w) in enumerate(bench):
        clean = prose(i, 80).split()
        for k, n_sub in enumerate((0, 1, 2)):
            t = list(w)
            for j in r.sample(range(1, len(t) - 1), n_sub):
                t[j] = "other"
            docs.append((10 * i + k, " ".join(clean[:30]) + " " + " ".join(t).upper() + ", " + " ".join(clean[30:])))
            expect.add((10 * i + k, item))
        docs.append((10 * i + 5, " ".join(clean) + " " + " ".join(w[:8])))      # too short an overlap
        docs.append((10 * i + 6, " ".join(clean + random.Random(i).sample(w, len(w)))))   # same words, other order
    out = D.contamination(table(spark, docs), items(spark, [(i, " ".join(w)) for i, w in bench])).collect()
    assert {(x.doc_id, x.item_id) for x in out} == expect
    for x in out:
        if x.doc_id % 10 == 0:
            n = len(dict(bench)[x.item_id])
            assert (x.doc_start, x.doc_end, x.item_start, x.overlap_words, x.matched_words, x.similarity) == (30, 30 + n, 0, n, n, 1.0)


def test_every_pair_of_substitutions_in_fifteen_words():
    masks = [[i for i, c in enumerate(m) if c == "1"] for m in D.MASKS]
    assert all(len(m) == 7 for m in masks)
    for a in range(15):
        for b in range(a):
            assert any(all(i + j not in (a, b) for j in m) for m in masks for i in range(15 - max(m)))


def test_every_allowed_substitution_leaves_a_seed():
    from itertools import combinations
    for n in [*range(5, 23), 25]:
        masks = D.MASKS if n >= D.MIN_WORDS else D.MASKS + D.SHORT_MASKS
        seeds = [sum(1 << i + j for i, c in enumerate(m) if c == "1") for m in masks for j in range(n - len(m) + 1)]
        left = np.array([sum(1 << i for i in c) for c in combinations(range(n), n - -(-4 * n // 5))])
        for s in seeds:
            left = left[left & s != 0]
        assert not len(left), n


def test_short_items_with_one_substitution(spark):
    bench = [(n, passage(n, n)) for n in (5, 6, 7, 8)]
    docs = [(100 * n + i, "a b c " + changed(w, [j != i for j in range(n)]) + " d e f") for n, w in bench for i in range(n)]
    out = D.contamination(table(spark, docs), items(spark, [(n, " ".join(w)) for n, w in bench])).collect()
    assert {(x.doc_id, x.item_id) for x in out} == {(i, i // 100) for i, _ in docs}


def test_contamination_edges(spark):
    short, p = ["s1", "s2", "s3", "s4", "s5", "s6"], passage(99, 20)
    bench = [(1, None), (2, ""), (3, "of the"), (4, " ".join(short)), (7, " ".join(p)), (5, " ".join(p).upper()), (None, " ".join(passage(98, 30)))]
    rows = EDGES + [(50, "x y z " + " ".join(short) + " end"), (51, " ".join(p)), (51, " ".join(p)), (None, "a b " + " ".join(p)),
                    (52, " ".join(passage(98, 30))), (53, "of the"), (54, prose(3, 20000) + " " + " ".join(p) + " " + prose(4, 20000))]
    df = table(spark, rows, clash=["item", "item_id", "words", "hash", "region"])
    out = D.contamination(df, items(spark, bench)).collect()
    assert sorted(((x.doc_id or -1), (x.item_id or -1), x.n_items) for x in out) == \
        [(-1, 5, 2), (50, 4, 1), (51, 5, 2), (52, -1, 1), (54, 5, 2)]
    assert D.contamination(table(spark, []), items(spark, bench)).collect() == []
    assert D.contamination(df, items(spark, [])).collect() == []


def test_two_overlaps_of_one_item_keep_the_longer(spark):
    p = passage(5, 40)
    text = " ".join(p[:15]) + " " + prose(1, 300) + " " + " ".join(p[10:])
    (x,) = D.contamination(table(spark, [(1, text)]), items(spark, [(1, " ".join(p))])).collect()
    assert (x.item_start, x.overlap_words) == (10, 30)


def brute_overlap(same, need):
    """The range of most equal words, then fewest words, then the first, by trying all."""
    ok = [(-sum(same[a:b]), b - a, a) for a in range(len(same)) for b in range(a + need, len(same) + 1)
          if 5 * sum(same[a:b]) >= 4 * (b - a)]
    return (min(ok)[2], min(ok)[2] + min(ok)[1], -min(ok)[0]) if ok else None


def test_overlap_equals_trying_all_ranges():
    r = random.Random(7)
    for k in range(600):
        n = r.randrange(5, 70)
        item, share = np.arange(n), r.choice([0.6, 0.7, 0.77, 0.8, 0.9, 1.0])
        same = [r.random() < share for _ in range(n)]
        before, after = r.randrange(3), r.randrange(3)
        cut = r.randrange(4) if before == 0 else 0                # the text begins within the item
        text = np.array([-1] * before + [i if x else -2 for i, x in enumerate(same)][cut:] + [-1] * after)
        got = D.overlap(text, item, before - cut)
        want = brute_overlap(same[cut:], min(n, D.MIN_WORDS))
        assert got == (want and (want[0] + cut, want[1] + cut, want[2])), (k, same)


def changed(w, same):
    return " ".join(x if s else f"other{i}" for i, (x, s) in enumerate(zip(w, same)))


def test_quotes_in_less_alike_surroundings(spark):
    bench = [(i, passage(50 + i, 59)) for i in range(4)]
    alike = [True] * 13 + ([False, True, True, True, False, True, True] * 7)[:46]         # an exact quote, then 71 % alike
    docs = [(i, "a b c " + changed(w, alike if i % 2 else alike[::-1]) + " d e") for i, w in bench]
    out = D.contamination(table(spark, docs), items(spark, [(i, " ".join(w)) for i, w in bench])).collect()
    assert {(x.doc_id, x.item_id) for x in out} == {(i, i) for i, _ in bench}
    assert all(x.overlap_words >= 13 and x.similarity >= 0.8 for x in out)


def test_an_overlap_between_two_short_ones(spark):
    w = passage(77, 59)
    same = [True] * 8 + [False] * 12 + [True] * 20 + [False] * 11 + [True] * 8
    out = D.contamination(table(spark, [(1, "a b c " + changed(w, same))]), items(spark, [(1, " ".join(w))])).collect()
    assert [(x.item_start, x.overlap_words, x.matched_words, x.doc_start, x.doc_end) for x in out] == [(20, 20, 20, 23, 43)]


# ---- licenses
def test_phrases_equal_a_plain_search(spark):
    r, rows = random.Random(2), []
    parts = [*L.PHRASES, "mit license", "under the", "CC-BY-NC", "Apache License, Version 2.0", "under the mit", "x", "the of", "License version 2"]
    for i in range(150):
        rows.append((i, " ".join(r.choice(parts) for _ in range(r.randrange(12)))))
    rows += EDGES
    out = L.license_scan(table(spark, rows, clash=["label", "row", "labels"])).collect()
    assert len(out) == len(rows)
    want = []
    for i, t in rows:
        w, at, found = words(t), [], set()
        for phrase, label in L.PHRASES.items():
            q = phrase.split()
            for k in range(len(w) - len(q) + 1):
                if w[k:k + len(q)] == q:
                    at.append(k)
                    found.add(label)
        want.append((i or -1, len(w), len(at), min(at, default=-1), max(at, default=-1), ",".join(sorted(found))))
    got = [(x.doc_id or -1, x.n_words, x.n_base, -1 if x.first_word is None else x.first_word,
            -1 if x.last_word is None else x.last_word, x.base_labels) for x in out]
    assert sorted(got) == sorted(want)
    assert all((x.score == 1.0) == (x.n_base > 0) for x in out)


def test_notices_with_words_put_in_and_left_out(spark):
    r, rows = random.Random(3), []
    for k, (label, text) in enumerate(L.NOTICES.items()):
        w = text.split()
        rows.append((k, prose(k, 50) + " " + text + " " + prose(k + 50, 50)))
        for j in sorted(r.sample(range(5, len(w) - 5), max(1, len(w) // 30)), reverse=True):
            w[j:j + 1] = r.choice([[], ["really", w[j]]])
        rows.append((100 + k, " ".join(w)))
        rows.append((200 + k, " ".join(r.sample(w, len(w)))))           # same words, other order
    out = {x.doc_id: x for x in L.license_scan(table(spark, rows)).collect()}
    for k, label in enumerate(L.NOTICES):
        assert label in out[k].labels.split(",") and out[k].score == 1.0 and out[k].base_labels == ""
        assert label in out[100 + k].labels.split(",") and out[100 + k].score >= L.MIN_COVER
        assert out[200 + k].labels == "" and out[200 + k].score == 0.0
        span = [s for s in out[k].spans if s.label == label][0]
        assert (span.first, span.last) == (50, 50 + len(words(L.NOTICES[label])) - 1)
    assert L.license_scan(table(spark, [])).collect() == []


# ---- toxicity
BAD = ["vileness", "grumbler", "sleazes"]


def labelled(n, seed=1):
    r, rows, labels = random.Random(seed), [], []
    for i in range(n):
        s = [prose(1000 * i + k, 12) for k in range(r.randrange(2, 8))]
        toxic = i % 6 == 0
        at = None
        if toxic:
            at = r.randrange(len(s))
            w = s[at].split()
            w.insert(4, r.choice(BAD) + r.choice(["", "s", "ed"]))
            s[at] = " ".join(w)
        rows.append((i, ". ".join(s), at))
        labels.append((i, 1, int(toxic)))
    return rows, labels


@pytest.fixture(scope="module")
def learned(spark):
    rows, labels = labelled(1500)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return rows, labels, T.train(table(spark, [r[:2] for r in rows]), lab)


def test_learns_labels_and_finds_sentences(spark, learned):
    rows, labels, weights = learned
    df, names = T.score(table(spark, [r[:2] for r in rows]), weights)
    out = {r.doc_id: r for r in df.withColumn("held", T.held_out(df["doc_id"])).collect()}
    import zlib
    assert all(out[i].held == (zlib.crc32(str(i).encode()) % 5 == 0) for i in out)
    held = [i for i in out if out[i].held]
    right = sum((out[i].toxic_score >= 0.5) == bool(labels[i][2]) for i in held)
    assert right / len(held) > 0.97
    for i, text, at in rows:
        if at is not None and out[i].toxic_score >= 0.5:
            sentence = text.encode()[out[i].worst_start:out[i].worst_end].decode()
            assert any(b in sentence for b in BAD)
            assert out[i].n_offending >= 0 and 0 <= out[i].worst_score <= out[i].toxic_score + 1e-9


def test_score_is_the_noisy_or_of_sentences(learned):
    weights = learned[2]
    for t in ["Vileness here. Nothing there! grumblers, grumbler\nend", "one", "", "...", "été là? ÇA va"]:
        data = np.frombuffer(t.encode(), np.uint8)
        feats, sentence, doc, start, end = T.bags(data, np.array([0, len(data)]))
        parts = [x for x in re.split(r"[.!?\n]", t) if words(x)]
        assert len(doc) == len(parts)
        miss = 1.0
        for k, part in enumerate(parts):
            f = set()
            for w in words(part):
                for x in (w.encode(), *(w.encode()[:p] for p in T.PREFIX_BYTES)):
                    pass
            f = set(feats[sentence == k].tolist())
            miss *= 1 - 1 / (1 + np.exp(-(sum(weights[j] for j in f) + weights[-1])))
            assert words(t.encode()[start[k]:end[k]].decode()) == words(part)
        assert miss <= 1


def test_score_equals_a_plain_noisy_or(spark, learned):
    """Document score, offending sentences and worst sentence, sentence by sentence: 1 - (1 - leak) * product(1 - p), where a sentence whose
    weights add up to no more than the floor has p = 0."""
    weights = learned[2]
    rows = learned[0][:150]
    texts = [t for _, t, *_ in rows] + ["Vileness here. Nothing there! grumblers, grumbler\nend", "one", "", "...", "vileness. vileness", None]
    out = T.score(table(spark, list(enumerate(texts))), weights)[0].collect()
    assert len(out) == len(texts)
    for r in out:
        data = (r.text or "").encode()
        block = np.frombuffer(data, np.uint8)
        feats, sentence, doc, start, end = T.bags(block, np.array([0, len(data)]))
        clear, chances = np.exp(-weights[-2]), []
        for k in range(len(doc)):
            s = sum(weights[j] for j in set(feats[sentence == k].tolist()))
            miss = (1 + np.exp(weights[-1])) / (1 + np.exp(s + weights[-1])) if s > T.FLOOR else 1.0
            chances.append(1 - miss)
            clear *= miss
        assert r.toxic_score == pytest.approx(1 - clear if len(doc) else 0.0, abs=1e-9)
        assert r.n_offending == sum(p >= 0.5 for p in chances)
        assert r.worst_score is None if not len(doc) else r.worst_score == pytest.approx(max(chances), abs=1e-9)


def test_rare_features_stay_with_the_tasks(spark):
    """The fit on bags without features of too few documents equals that on whole bags."""
    rows, labels = labelled(600, seed=9)
    docs, marks = table(spark, [r[:2] for r in rows]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    w = T.train(docs, marks)
    ids = [r.doc_id for r in docs.where(~T.held_out(F.col("doc_id"))).select("doc_id").collect()]
    text, mark = {r[0]: r[1] for r in rows}, {i: t for i, _, t in labels}
    found = {i: [] for i in ids}
    for i in ids:
        data = np.frombuffer(text[i].encode(), np.uint8)
        feats, sentence, doc, _, _ = T.bags(data, np.array([0, len(data)]))
        found[i] = [np.unique(feats[sentence == k]) for k in range(len(doc))]
    ids = sorted(ids, key=lambda i: i)
    whole = T.fit_noisy_or(np.array([mark[i] for i in ids], np.int32), np.concatenate([f for i in ids for f in found[i]]).astype(np.uint32),
                           np.array([len(f) for i in ids for f in found[i]], np.uint32), np.array([len(found[i]) for i in ids]))
    assert np.flatnonzero(w).tolist() == np.flatnonzero(whole).tolist() and np.allclose(w, whole, atol=1e-6)


def test_length_alone_is_not_toxic(spark):
    rows, labels = labelled(1500, seed=4)
    labels = [(i, q, int(t or i % 25 == 1)) for i, q, t in labels]            # marked texts without a bad word
    w = T.train(table(spark, [r[:2] for r in rows]), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    clean = {n: ". ".join(prose(k, 12) for k in range(n)) for n in (1, 1000, 20000)}
    out, _ = T.score(table(spark, [*clean.items(), (5, clean[1000] + ". " + "what a vileness of prose")]), w)
    got = {r.doc_id: r for r in out.collect()}
    assert all(got[n].toxic_score < 0.5 and got[n].n_offending == 0 for n in clean), [got[n].toxic_score for n in clean]
    assert got[5].toxic_score >= 0.5 and got[5].n_offending == 1


def test_long_texts_are_learned_from(spark):
    rows = [(i, ". ".join(prose(1000 * i + k, 12) for k in range(1 + 500 * (i % 2)))) for i in range(200)]
    rows = [(i, t + ". so vileness it is" if i % 4 == 1 else t) for i, t in rows]         # only among the long ones
    assert min(len(t) for i, t in rows if i % 2) > 20_000
    w = T.train(table(spark, rows), spark.createDataFrame([(i, 1, int(i % 4 == 1)) for i, _ in rows], "doc_id long, quality int, toxic int"))
    out = T.score(table(spark, rows), w)[0].collect()
    assert all((r.toxic_score >= 0.5) == (r.doc_id % 4 == 1) for r in out)


def test_toxicity_edges(spark, learned):
    df = table(spark, EDGES, clash=["toxic_score", "worst_start", "TOXIC_SCORE2"])
    out, names = T.score(df, learned[2])
    assert names["toxic_score"] != "toxic_score" and out.columns[:len(df.columns)] == df.columns
    rows = out.collect()
    assert len(rows) == len(EDGES)
    for r in rows:
        s = r[names["toxic_score"]]
        assert 0 <= s <= 1 and (words(r.text) or s == 0) and (r[names["worst_score"]] is None) == (not words(r.text))
    none = spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    flat, names = T.toxicity(table(spark, EDGES), none)
    assert all(r.toxic_score < 1e-6 for r in flat.collect())
    assert T.toxicity(table(spark, []), none)[0].collect() == []


def test_prefix_hashes_are_those_of_short_words():
    data = np.frombuffer(b"grumblers grum grumbl", np.uint8)
    w = K.words(data, np.array([0, len(data)]), K.ALNUM)
    p4, p6 = w.prefix(4), w.prefix(6)
    assert p4[0] == p4[1] == p4[2] and p6[0] == p6[2] != p6[1]
