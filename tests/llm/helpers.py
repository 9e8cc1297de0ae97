"""Small tables and brute-force versions for the tests of the llm operators."""

import random
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def table(spark, rows, clash=()):
    """documents with the given (doc_id, text) rows, and further columns of clashing names."""
    df = spark.createDataFrame([(i, t, None, "src0", None) for i, t in rows], DOCS)
    for name in clash:
        from pyspark.sql import functions as F
        df = df.withColumn(name, F.lit("x"))
    return df


def prose(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" + ("." if r.random() < 0.1 else "") for _ in range(n))


def lower(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def jaccard_classes(rows):
    """[(doc_id, n_shingles, component_id)] by comparing all pairs."""
    s = [shingles(t) for _, t in rows]
    up = list(range(len(s)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    for a in range(len(s)):
        for b in range(a):
            n = len(s[a] & s[b])
            if n and 100 * n >= 80 * (len(s[a]) + len(s[b]) - n):
                up[top(a)] = top(b)
    ids = {}
    for x, (i, _) in enumerate(rows):
        ids.setdefault(top(x), []).append(i)
    least = {k: min((i for i in v if i is not None), default=None) for k, v in ids.items()}
    return [(i, len(s[x]), least[top(x)] if s[x] else i) for x, (i, _) in enumerate(rows)]


def key(row):
    return tuple((x is None, x if x is not None else 0) for x in row)


def near_copies(seed, n_base=12, copies=6, words=60):
    """Rows with exact copies, near copies on both sides of the threshold, and chains."""
    r, rows = random.Random(seed), []
    for b in range(n_base):
        base = [f"w{r.randrange(3000)}" for _ in range(words + r.randrange(20))]
        for _ in range(copies):
            t = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                t[r.randrange(len(t))] = f"v{r.randrange(3000)}"
            if r.random() < 0.3:
                t = t[:len(t) - r.randrange(12)]
            rows.append(" ".join(t))
    r.shuffle(rows)
    return [(i * 3, t) for i, t in enumerate(rows)]


EDGES = [(None, None), (None, ""), (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (4, "one"), (5, "one two three four"),
         (6, "One TWO three  four"), (7, "a b c d e"), (8, prose(1, 30000)), (8, prose(1, 30000)), (None, prose(2, 40)), (9, prose(2, 40)),
         (10, "été là ÇA va bien oui non"), (11, "été là ÇA va bien oui non"), (12, "\x00 \x01 x\x85y z")]
