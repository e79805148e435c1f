"""Operators that look at all documents together, against plain versions."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from omphalos.llm import components, language, near_dup, suffix_dedup, suffix_sort, url_filter
from omphalos.llm.common import Scratch, hot_lookup

from .helpers import AWKWARD, SF, counted, documents, near_groups, prose, sha, table


# ------------------------------------------------------------------ components
def test_components(spark):
    random.seed(4)
    links = [(random.randrange(200), random.randrange(200)) for _ in range(130)] + [(300 + i, 301 + i) for i in range(40)] + [(5, 5), (None, 3)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            x, y = find(a), find(b)
            top[max(x, y)] = min(x, y)
    df = spark.createDataFrame(links, "a long, b long")
    got = components.connected_components(Scratch(spark, "t"), df).collect()
    assert {r.node: r.component for r in got} == {n: find(n) for n in list(top)}
    assert components.connected_components(Scratch(spark, "t"), df.limit(0)).collect() == []


def test_hot_lookup(spark):
    big = spark.range(30_000).select(F.when(F.col("id") < 20_000, 7).otherwise(F.col("id")).alias("k"), "id")
    small = big.groupBy("k").agg(F.min("id").alias("least"), F.count("*").alias("n"))
    got = hot_lookup(big, small, "k", "n")
    assert got.count() == 30_000
    assert got.where("k = 7 AND least = 0").count() == 20_000
    assert got.where("k <> 7 AND least <> id").count() == 0


# ---------------------------------------------------------------- language (4)
def test_gradients_are_right():
    net = language.ByteGru.new(["a", "b", "c"])
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    codes = np.random.default_rng(0).integers(97, 105, (6, 5)).astype(np.uint8)
    mask, label = np.ones((6, 5)), np.array([0, 1, 2, 1, 0])
    mask[4:, 2] = 0
    _, grads = net.gradients(codes, mask, label)
    for k, g in grads.items():
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, losses = net.w[k][at], []
        for step in (1e-4, -1e-4):
            net.w[k][at] = old + step
            losses.append(net.gradients(codes, mask, label)[0])
        net.w[k][at] = old
        assert abs((losses[0] - losses[1]) / 2e-4 - g[at]) < 1e-4


@pytest.fixture(scope="module")
def predicted(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    return docs, language.op4_language_id(docs).collect()


def test_held_out_accuracy(predicted):
    docs, got = predicted
    lang = {r.doc_id: r.lang for r in docs.collect()}
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert len(held) > 20 and sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_of_awkward_rows(spark):
    rows = AWKWARD + [(100, "123 !? 456")]
    df = table(spark, rows).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb"))
    got = language.op4_language_id(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id in (1, 2, 3, 11, 100):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            assert r.lang_pred in ("aa", "bb")
    unlabelled = language.op4_language_id(df.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {r.lang_pred for r in unlabelled} == {"und"}
    assert language.op4_language_id(df.limit(0)).collect() == []


# ---------------------------------------------------------- near-duplicates (7)
def _near_rows():
    """Copies, chains of near copies, and members that only their neighbours join."""
    random.seed(9)
    base = [f"w{random.randrange(400)}" for _ in range(300)]
    rows = [(40 + i, prose(90, i)) for i in range(0, 12)]
    now = list(base)
    for k in range(40):  # each is near the one before, the ends are far apart
        for _ in range(2):
            now[random.randrange(300)] = f"n{k}-{random.randrange(99)}"
        rows.append((100 + (k * 17) % 40, " ".join(now)))
    for k in range(25):  # some above and some below the threshold
        near = list(base)
        for _ in range(k):
            near[random.randrange(300)] = f"x{k}"
        rows.append((200 + k, " ".join(near)))
    return rows + [(i, t) for i, t in AWKWARD if i is not None and i != 13]


def test_near_duplicates(spark):
    rows = [(i + 1000 if i < 100 else i, t) for i, t in _near_rows()] + [(i + 5000, t) for i, t in documents(spark, 120)]
    want = near_groups(rows)
    got = near_dup.op7_minhash_near_dedup(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_open_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK", 40)  # every open bucket in many blocks
    rows = [r for r in _near_rows() if r[0] >= 100]
    got = near_dup.op7_minhash_near_dedup(table(spark, rows)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == near_groups(rows)


@pytest.mark.parametrize("outsiders", [1, 150])
def test_blocks_of_an_open_bucket_hold_few_rows(spark, outsiders, monkeypatch):
    """A block holds a chunk of either side, however many members the bucket has."""
    monkeypatch.setattr(near_dup, "BLOCK", 400)  # 20 rows a side
    frame = type(spark.range(0))
    dealt, keep = [], frame.sortWithinPartitions
    monkeypatch.setattr(frame, "sortWithinPartitions", lambda self, *a: dealt.append(self) or keep(self, *a))
    n = 600
    rows = [(i, " ".join(f"w{i - i % 2}x{k}" for k in range(50)) + " end" * (i % 2)) for i in range(n)]  # each odd row is near the one before
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    cards = near_dup.signed(texts, "doc_id", "text", 4)
    component = [i if i < outsiders else 10_000 for i in range(n)]
    member = spark.createDataFrame([(7, i, 47 + i % 2, component[i]) for i in range(n)], "key long, doc_id long, n_shingles long, component long")
    got = near_dup._across(Scratch(spark, "test"), member, cards, texts, 4, 80).collect()
    assert sorted(map(tuple, got)) == [(i, i + 1) for i in range(0, n, 2) if component[i] != component[i + 1]]
    assert dealt[0].groupBy("key", "block").count().agg(F.max("count")).first()[0] <= 100


def test_copies_that_share_a_bucket_give_few_links(spark, monkeypatch):
    """2,000 near copies, each a component of its own: at most one link for each, not a pair for each two."""
    monkeypatch.setattr(near_dup, "BLOCK", 1_000_000)
    n = 2000
    texts = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(60)) + f" x{i}") for i in range(n)], "doc_id long, text string")
    cards = near_dup.signed(texts, "doc_id", "text", 4)
    member = spark.range(n).select(F.lit(1).cast("long").alias("key"), F.col("id").alias("doc_id"), F.lit(58).cast("long").alias("n_shingles"), F.col("id").alias("component"))
    links = near_dup._across(Scratch(spark, "test"), member, cards, texts, 4, 80)
    got = [tuple(r) for r in links.collect()]
    blocks = 2 * 2  # chunks of outsiders times chunks of members
    assert len(got) <= blocks * n
    top = list(range(n))

    def find(x):
        while top[x] != x:
            top[x] = top[top[x]]
            x = top[x]
        return x

    for a, b in got:
        top[find(b)] = find(a)
    assert len({find(x) for x in range(n)}) == 1


def test_near_duplicates_of_awkward_rows(spark):
    got = near_dup.op7_minhash_near_dedup(table(spark)).collect()
    assert len(got) == len(AWKWARD)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        if r.doc_id in (1, 2, 3):
            assert (r.n_shingles, r.component_id, r.kept) == (0, r.doc_id, True)
    assert {r.component_id for r in got if r.doc_id in (5, 6, 7)} == {5}
    assert {r.component_id for r in got if r.doc_id in (14, 15)} == {14}  # A-Z only differ
    assert near_dup.op7_minhash_near_dedup(table(spark, [])).collect() == []


# ------------------------------------------------------------------- URLs (8)
def test_url_rules_and_links(spark):
    canonical, refresh = '<link rel="canonical" href="%s">', '<meta http-equiv="refresh" content="0; url=%s">'
    rows = [
        (1, "http://a.com/de/1", None, "a.com", "/de/1", "com/de/", "block"),
        (2, "http://b.net/x", canonical % "http://a.com/de/1", "b.net", "/x", None, "block"),
        (2, "http://b.net/x", canonical % "http://a.com/de/1", "b.net", "/x", None, "block"),
        (3, "http://c.net/y?q=1#z", refresh % "http://b.net/x", "c.net", "/y", None, "block"),
        (4, "http://d.net/", "", "d.net", "/", None, "allow"),
        (5, "http://e.com/fr/2", refresh % "http://f.com/de/3", "e.com", "/fr/2", "com/fr/", "allow"),
        (6, "http://g.net/", canonical % "http://f.com/de/3", "g.net", "/", None, "allow"),  # an allowed page shares its links
        (7, None, "x", "", "", None, "allow"),
        (8, "nourl", canonical % "http://a.com/de/1", "", "", None, "allow"),
        (9, "HTTP://WWW.Example.ORG/es/1?x", None, "www.example.org", "/es/1", "example.org/es/", "block"),
        (10, "http://example.org", None, "example.org", "", None, "allow"),
        (11, "x://h.net/p", canonical % "/q", "h.net", "/p", None, "block"),
        (12, "http://h.net/q", canonical % "//a.com/de/1", "h.net", "/q", None, "block"),
        (13, "http://example.org/en/12", None, "example.org", "/en/12", "example.org/en/1", "block"),
        (14, "http://notexample.org/en/12", None, "notexample.org", "/en/12", "org/", "allow"),
        (15, "", None, "", "", None, "allow"),
    ]
    df = spark.createDataFrame([r[:3] for r in rows], "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = url_filter.op8_url_filters(df).collect()
    assert counted(got) == counted((r[0], *r[3:]) for r in rows)
    assert url_filter.op8_url_filters(df.limit(0)).collect() == []


@pytest.mark.parametrize(
    "html, there",
    [
        ('<meta content="0; url=http://a.com/de/1" http-equiv="refresh">', "a.com/de/1"),
        ("<META data-x='%s' Content = '5;URL=\"/q?x=1&amp;y=2\"' HTTP-EQUIV=Refresh />" % ("z>" * 300), "b.net/q?x=1&y=2"),
        ("<meta http-equiv=refresh content=3;url=next>", "b.net/dir/next"),
        ('<meta http-equiv="refresh" content="0; ../up/./x/..">', "b.net/up/"),
        ('<link title="%s" rel="canonical" data-y="%s" href="?x=1&amp;y=2#top">' % ("t" * 900, "y" * 900), "b.net/dir/page?x=1&y=2"),
        ('<link href="other/it\'s" hreflang=de rel="alternate canonical">', "b.net/dir/other/it's"),
        ("<link rel=canonical href=//C.net?u=http://d.net/>", "c.net/?u=http://d.net/"),
        ('<link rel="canonical" href="?u=http://d.net/">', "b.net/dir/page?u=http://d.net/"),
        ('<link rel="canonical" href="#here"><link rel="stylesheet" href="/canonical.css">', None),
        ('<meta name="x" content="http-equiv=refresh; url=/q"><link rel=canonical href="mailto:x@y.z">', None),
        ('<meta http-equiv="refresh" content="30">', None),
    ],
)
def test_url_edges_of_any_tag(spark, html, there):
    """Attributes in any order and length, relative targets and written ampersands."""
    df = spark.createDataFrame([("http://b.net/dir/page?a=1", "<p>" + html + "<p>")], "url string, html string")
    assert [tuple(r) for r in url_filter.url_edges(df).collect()] == ([("b.net/dir/page?a=1", there)] if there else [])


def test_url_filters_with_hot_and_null_urls(spark):
    """A url of very many pages, as many null urls, and columns with the names the join uses."""
    link = '<link rel="canonical" href="http://a.de/de/x">'
    rows = [(i, "http://hot.net/p", "", i, "x", "y") for i in range(6000)] + [(i, None, link, i, None, "y") for i in range(6000, 12000)]
    rows += [(12000, "http://hot.net/p", link, 1, "x", "y"), (12001, "http://b.net/q", link, 1, "x", "y"), (12002, "http://c.net/q", "", 1, "x", "y"), (12003, "http://d.com/de/1", link, 1, "x", "y"), (12004, "no address", link, 1, "x", "y")]
    rows += [(12005, "http://a.com/de/x", '<link rel="canonical" href="http://b.net/q">', 1, "x", "y"), (12006, "http://a.com/de/x", '<link rel="canonical" href="http://hot.net/p">', 1, "x", "y")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, `count` int, address string, __address string")
    out = url_filter.filter_urls(df)
    assert out.columns == ["page_id", "url", "html", "count", "address", "__address", "host", "path", "rule", "verdict"]
    got = {r["page_id"]: r for r in out.collect()}
    assert len(got) == len(rows) == out.count()
    assert {got[i]["verdict"] for i in range(6000)} == {"block"} and {got[i]["verdict"] for i in range(6000, 12000)} == {"allow"}
    assert [got[i]["verdict"] for i in range(12000, 12007)] == ["block", "block", "allow", "block", "allow", "block", "block"]
    assert got[5]["address"] == "x" and got[7000]["address"] is None and got[5]["count"] == 5


# ------------------------------------------------------------- suffix dedup (9)
def plain_order(t):
    ends = [i for i, c in enumerate(t) if c == suffix_sort.SEPARATOR]

    def key(i):
        end = next(x for x in ends if x >= i)
        return (*t[i:end], 1000 + end)

    order = sorted(range(len(t)), key=key)
    shared = [0]
    for a, b in zip(order, order[1:], strict=False):
        x, y = key(a), key(b)
        k = 0
        while k < min(len(x), len(y), suffix_sort.CAP) and x[k] == y[k]:
            k += 1
        shared.append(k)
    return order, shared


@pytest.mark.parametrize("memory", [(1 << 24, 1 << 20, 1 << 26), (0, 8, 100)])
def test_suffix_order(memory, monkeypatch):
    """With the usual memory, and with so little that recursion goes deep and queues go to disk."""
    for name, value in zip(("INTERNAL", "HEAP_ITEMS", "QUEUE_BYTES"), memory, strict=True):
        monkeypatch.setattr(suffix_sort, name, value)
    random.seed(1)
    for _ in range(150):
        alphabet = random.choice([b"a", b"ab", b"abc", bytes(range(97, 123)), bytes(range(1, 250))])
        base = bytes(random.choice(alphabet) for _ in range(80))
        parts = []
        for _ in range(random.randint(1, 6)):
            a = random.randint(0, 60)
            parts.append(base[a : a + random.randint(1, 70)] if random.random() < 0.5 else bytes(random.choice(alphabet) for _ in range(random.randint(1, 40))))
        t = np.frombuffer(b"".join(p + bytes([suffix_sort.SEPARATOR]) for p in parts), np.uint8)
        order, shared = suffix_sort.suffix_order(t)
        assert (order.tolist(), shared.tolist()) == plain_order(t.tolist())


def test_hashes_tell_strings_apart():
    """Equal strings have equal hashes wherever they stand, others (nearly always) don't."""
    rng = np.random.default_rng(3)
    raw = rng.integers(97, 100, 50_000).astype(np.uint8)
    raw[40_000:45_000] = raw[100:5_100]
    hashes = suffix_dedup.Hashes(raw)
    own = hashes.all(32)
    assert (own[40_000:44_969] == own[100:5_069]).all()
    assert len(np.unique(own)) == len({raw[i : i + 32].tobytes() for i in range(len(own))})
    assert (hashes.of(np.arange(len(own)), np.arange(len(own)) + 32) == own).all()
    # a piece holds each window once, and its anchors are spread
    first, last, place, key, _ = suffix_dedup.pieces(raw, np.array([30_000, 20, 19_980]), 32)
    assert (last - first + 1).sum() == 30_000 - 49 + 19_980 - 49
    assert ((place >= first) & (place <= first + 18)).all()
    assert len(np.unique(key % np.uint64(48))) == 48 and len(first) < len(raw) / 8


def plain_repeats(rows, span=50):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for k in range(len(b) - span + 1 if i is not None else 0):
            w = b[k : k + span]
            first[w] = min(i, first.get(w, i))
    out = []
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for k in range(len(b) - span + 1 if i is not None else 0):
            if first[b[k : k + span]] < i:
                gone[k : k + span] = b"\1" * span
        runs = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(b), sum(gone), runs, sha(bytes(c for c, g in zip(b, gone, strict=True) if not g))))
    return out


@pytest.mark.parametrize("chunk", [None, 400])
def test_suffix_dedup(spark, chunk, monkeypatch):
    if chunk:
        monkeypatch.setattr(suffix_dedup, "CHUNK", chunk)
    random.seed(5)
    rows = AWKWARD + [(i + 1000, t) for i, t in documents(spark, 40)]
    texts = [t for _, t in rows if t and len(t) > 400]
    for j in range(60):
        t = random.choice(texts)
        k = random.randrange(len(t) - 200)
        rows.append((2000 + j, "é" * random.randrange(9) + t[k : k + random.choice([48, 49, 50, 51, 60, 150])] + "zz" * random.randrange(30)))
    rows += [(3001, "b" + "a" * 499), (3002, "a" * 500), (3003, "ab" * 100), (3004, "ba" * 100), (3005, "y" * 49), (3006, "y" * 49), (3007, texts[0]), (3007, texts[0])]
    got = suffix_dedup.op9_suffix_dedup(table(spark, rows)).collect()
    assert counted(got) == counted(plain_repeats(rows))


@pytest.mark.parametrize("most", [4, 60])
def test_suffix_dedup_splits_a_hot_anchor(spark, most, monkeypatch):
    """A phrase of all documents, other text around most of them: no task sorts more than a few of its surroundings."""
    related = suffix_dedup._related

    def bounded(keys):
        _, sizes = np.unique(keys, return_counts=True)
        assert not len(sizes) or sizes.max() <= most
        return related(keys)

    monkeypatch.setattr(suffix_dedup, "HOT", most, raising=False)
    monkeypatch.setattr(suffix_dedup, "_related", bounded)
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    phrase, rows = "Licensed, with NO warranty, to 2024", []
    heads, tails = [word(40) for _ in range(6)], [word(40) for _ in range(6)]
    for i in range(400):
        a, b = rng.choice([("", ""), (word(60), ""), (word(60), rng.choice(tails)), (rng.choice(heads), word(60)), (rng.choice(heads)[-9:], rng.choice(tails)[:9]), (word(60), word(60)), (word(60), word(60))])
        rows.append((i // 2 * 3 % 397 if i % 50 == 0 else i, word(20) + a + phrase + b + word(20)))
    got = suffix_dedup.op9_suffix_dedup(table(spark, rows).repartition(16)).collect()
    assert counted(got) == counted(plain_repeats(rows))


def test_suffix_dedup_broadcasts_no_table_of_the_datas_size(spark, monkeypatch):
    """What the pieces of hot anchors have in common grows with the input, so it meets their rows without the driver."""
    plans, save = [], suffix_dedup.Scratch.save

    def seen(self, df, name):
        plans.append((name, df._jdf.queryExecution().toString()))
        return save(self, df, name)

    monkeypatch.setattr(suffix_dedup, "HOT", 4)
    monkeypatch.setattr(suffix_dedup.Scratch, "save", seen)
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    tails = [word(40) for _ in range(4)]
    rows = [(i, word(60) + "Licensed, with NO warranty, to 2024" + rng.choice(tails)) for i in range(60)]
    out = suffix_dedup.op9_suffix_dedup(table(spark, rows))
    assert counted(out.collect()) == counted(plain_repeats(rows))
    assert "inner" in [name for name, _ in plans]
    assert not [name for name, plan in [*plans, ("result", out._jdf.queryExecution().toString())] if "Broadcast" in plan]


def test_suffix_dedup_of_an_empty_table(spark):
    assert suffix_dedup.op9_suffix_dedup(table(spark, [])).collect() == []


@pytest.mark.parametrize("texts", [1, 30_000])
def test_training_fetches_few_rows_of_one_id(spark, monkeypatch, texts):
    """30,000 rows of one id, with one text or with as many: a bounded number of pieces comes to the driver."""
    df = spark.range(30_000).select(F.lit(113).alias("doc_id"), F.concat(F.lit("some words "), (F.col("id") % texts).cast("string")).alias("text"), F.lit("en").alias("lang"))
    frame, fetched = type(df), []
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: fetched.append(collect(self)) or fetched[-1])
    pieces = language.training_pieces(df, "doc_id", "text", "lang")
    assert max(map(len, fetched)) <= 1000 and len(pieces) <= language.PER_LANGUAGE
    assert len(pieces) >= (1 if texts > 1 else 0)
