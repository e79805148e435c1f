"""Small tables with awkward rows, and plain versions of the operators."""

import collections
import hashlib
import re

SF = "/root/testdata/sf0.001"


def sha(x):
    return hashlib.sha256(x.encode() if isinstance(x, str) else x).hexdigest()


WORDS = "the of and a quick brown fox jumps over lazy dogs while seven wizards boil magic potions in tall iron pots".split()


def prose(n, start=0, step=7):
    return " ".join(WORDS[(start + i * step + i * i % 5) % len(WORDS)] for i in range(n))


AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \t\n\x0b\x0c\r "),
    (4, "one"),
    (5, prose(60)),
    (6, prose(60)),  # the same text again
    (7, prose(60) + " more"),
    (8, prose(3000, 3)),
    (9, "x" * 20_000),
    (10, "é" * 300 + " ß😀 中文 " * 40),
    (11, "1 " * 400 + "." * 100),
    (12, prose(40, 5) + "\n" + prose(40, 5) + "\n\n" + prose(40, 5)),
    (None, prose(60)),
    (13, prose(80, 2)),
    (13, prose(80, 2)),  # a repeated row
    (14, "a b c d"),
    (15, "A B c D"),
]


def table(spark, rows=None, extra=True):
    """(doc_id, text) with columns whose names clash with those the operators make."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(AWKWARD if rows is None else rows, "doc_id long, text string")
    if extra:
        for c in ("n_tokens", "ids", "base", "added", "quality", "broken", "lang_pred", "score", "hits", "items", "key", "row", "keys", "component", "decoded"):
            df = df.withColumn(c, F.lit("clash"))
    return df


def documents(spark, most=None):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    return [tuple(r) for r in (df if most is None else df.orderBy("doc_id").limit(most)).collect()]


def counted(rows):
    return collections.Counter(tuple(r) for r in rows)


def words(t):
    return re.findall(r"[^\x20\x09-\x0d]+", t or "")


def near_groups(rows, n=4, percent=80):
    """doc_id -> (set size, least id of its group); the all-pairs definition."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        s = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
        sets[i] = s
    top = {i: i for i in sets}

    def find(x):
        while top[x] != x:
            x = top[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                top[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}
