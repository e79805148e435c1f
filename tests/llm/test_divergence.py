"""Source divergence audit against a plain version with Python integers."""

import collections
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from omphalos.llm import divergence as D

from .helpers import counted, prose

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def plain(rows, least=D.LEAST_DOCS, most=D.LISTED):
    count, docs, sources = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(set)
    for lang, source, text in ((x or "" for x in r) for r in rows):
        terms = TERM.findall(text.translate(LOWER))
        count[lang, source].update(terms)
        docs[lang].update(set(terms))
        sources[lang].add(source)
    out = []
    for lang, own in sources.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= least)
        whole = sum((count[lang, s] for s in own), collections.Counter())

        def shares(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        q, p = shares(whole), {s: shares(count[lang, s]) for s in own}
        for s in own:
            far = sorted(((sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in own if o != s), key=lambda x: (-x[0], x[1].encode()))
            over = sorted(((p[s][t] - q[t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]), key=lambda x: (-x[0], x[1].encode()))[:most]
            for part, found in (("pair", far), ("term", over)):
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found, 1)]
    return out


def corpus():
    rows = [("en", f"s{k % 7}", prose(30 + k % 50, k)) for k in range(300)]
    rows += [("en", "s1", None), ("en", "quiet", "1 2 3"), ("en", "quiet2", ""), ("en", None, "THE quick"), (None, "a", "only here"), (None, None, None), ("one", "alone", "x" * 30_000)]
    rows += [("é", s, f"Élan été {'ÇA' * k} naïve-mot ß😀中 \x00[\\]`{{|}}~\x7f K") for k in range(40) for s in ("x", "￿", "\U0001f600")]
    rows += [("few", s, "rare words here") for s in "abc"] + [("en", "s2", prose(40, 1))] * 40
    return rows


@pytest.fixture(scope="module")
def rows():
    return corpus()


def frame(spark, rows):
    df = spark.createDataFrame(rows, "lang string, source string, text string").repartition(5)
    for c in ("term", "n", "docs", "shard", "side", "kept", "weight", "p", "q", "rank"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_audit(spark, rows):
    got = D.op11_source_divergence(frame(spark, rows)).collect()
    assert counted(got) == counted(plain(rows))


def test_blocks_of_sources_and_shards_change_nothing(spark, rows, monkeypatch):
    monkeypatch.setattr(D, "SOURCES", 3)
    monkeypatch.setattr(D, "SHARD_ROWS", 7)
    got = D.op11_source_divergence(frame(spark, rows)).collect()
    assert counted(got) == counted(plain(rows))


def test_partial_counts_are_merged(rows, monkeypatch):
    monkeypatch.setattr(D, "BITE", 50)
    monkeypatch.setattr(D, "HELD", 40)
    cut = [tuple(x or "" for x in r) for r in rows]
    batch = pa.RecordBatch.from_pylist([dict(zip(("lang", "source", "text"), r)) for r in cut])
    total, docs = collections.Counter(), collections.Counter()
    for b in D._count([batch.slice(0, 100), batch.slice(100, 0), batch.slice(100)]):
        for r in b.to_pylist():
            total[r["lang"], r["source"], r["term"]] += r["n"]
            docs[r["lang"], r["source"], r["term"]] += r["docs"]
    want, in_docs = collections.Counter(), collections.Counter()
    for lang, source, text in cut:
        terms = TERM.findall(text.translate(LOWER))
        want.update((lang, source, t) for t in terms)
        in_docs.update({(lang, source, t) for t in terms})
        want[lang, source, ""] += 0
    assert {k for k in total} == {k for k in want}
    assert +total == +want and +docs == +in_docs


def test_shares_are_exact_beyond_64_bits(spark):
    n = 9 * 10**18
    got = spark.range(1).select(D.share(F.lit(n), F.lit(n + 1), F.lit(3)), D.share(F.lit(0), F.lit(0), F.lit(0))).first()
    assert got[0] == 1 + 10**9 * (n + 5) // (n + 1 + 15) and got[1] is None


def test_an_empty_table(spark):
    assert D.op11_source_divergence(spark.createDataFrame([], "lang string, source string, text string")).collect() == []
