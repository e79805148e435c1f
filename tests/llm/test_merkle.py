"""Merkle manifest: logs in completion order, closed-form places, proofs against a plain tree."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from omphalos.llm import merkle as M

from .helpers import SF, counted, sha


def plain_tree(leaves):
    """All layers of a tree, from the leaves to the root."""
    layers = [list(leaves)]
    while len(layers[-1]) > 1:
        below = layers[-1]
        layers.append([sha("".join(below[i : i + 8])) for i in range(0, len(below), 8)])
    return layers


def plain_path(layers, k):
    out = []
    for layer in layers[:-1]:
        g = k // 8 * 8
        out.append((layer[g:k] + layer[k + 1 : g + 8], k - g))
        k //= 8
    return out


def plain_leaf(row):
    doc_id, text, lang, source, n_chars = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def plain_manifest(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[2]].append(r)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[g] = plain_tree([plain_leaf(r) for r in groups[g]])
    top = plain_tree([trees[g][-1][0] for g in names])
    out = []
    for at, g in enumerate(names):
        for k, r in enumerate(groups[g]):
            path = plain_path(trees[g], k) + plain_path(top, at)
            leaf = plain_leaf(r)
            node = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                node = plain_leaf((r[0], r[1].translate({i: i + 32 for i in range(65, 91)}), *r[2:]))
            for sib, slot in path:
                node = sha("".join(sib[:slot] + [node] + sib[slot:]))
            root = top[-1][0]
            out.append((r[0], leaf, trees[g][-1][0], root, sha("".join(x for s, _ in path for x in s)), node, node == root))
    return out


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 64, 65, 71, 72, 73, 511, 513, 600, 4096])
def test_places_in_the_log(n):
    leaves = [sha(str(k)) for k in range(n)]
    levels = M.levels_above(n, 4)
    log = M.build_log(leaves, levels)
    layers = plain_tree(leaves)
    assert len(layers) == levels + 1 and len(log) == sum(map(len, layers))
    assert sorted(M.place(h, j, n) for h, layer in enumerate(layers) for j in range(len(layer))) == list(range(len(log)))
    assert all(log[M.place(h, j, n)] == node for h, layer in enumerate(layers) for j, node in enumerate(layer))


def rows_of(spark, n=None):
    df = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    return [tuple(r) for r in df.collect()]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
AWKWARD = [
    (None, "no id", "en", "s", 5), (1, None, None, None, None), (2, "", "", "", 0), (3, "É A b", "é", "s", 5), (4, "X" * 200_000, "zz", "s", 200_000),
    (5, "Twin", "en", "s", 4), (5, "Twin", "en", "s", 4), (5, "Other", "en", "s", 5), (-9, "A", "en", None, -1), (7, "lone", "\x00", "s", 4), (8, "a:b-", "\U0001f600", "s", 4), (9, "b", "￿", "s", 4),
]


@pytest.mark.parametrize("height", [M.HEIGHT, 1])
def test_manifest(spark, height):
    rows = rows_of(spark) + AWKWARD
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for c in ("rank", "total", "proof", "tree", "node"):
        df = df.withColumn(c, F.lit("clash"))
    want = plain_manifest(rows)
    assert counted(M.op13_merkle_manifest(df, height).collect()) == counted(want)
    assert {r[-1] for r in want} == {True, False}


def test_log_of_a_tree(spark):
    n = 9000
    df = spark.range(n).select(F.lit("=x").alias("tree"), "id", F.sha2(F.col("id").cast("string"), 256).alias("node"))
    made = M.build_manifest(df, ["id"])
    layers = plain_tree([sha(str(k)) for k in range(n)])
    want = {M.place(h, j, n): (h, node) for h, layer in enumerate(layers) for j, node in enumerate(layer)}
    got = {r.position: (r.height, r.node) for r in made.log.collect()}
    assert got == want and made.root == layers[-1][0]
    assert sorted(got) == list(range(len(got)))
    r = made.proofs.where("id = 8191").first()
    assert [(s.siblings, s.slot) for s in r.proof] == plain_path(layers, 8191)


def test_one_row_and_no_rows(spark):
    assert M.op13_merkle_manifest(spark.createDataFrame([], SCHEMA)).collect() == []
    got = [tuple(r) for r in M.op13_merkle_manifest(spark.createDataFrame([AWKWARD[3]], SCHEMA)).collect()]
    assert got == plain_manifest([AWKWARD[3]])
    assert got[0][1] == got[0][2] == got[0][3] and got[0][4] == hashlib.sha256(b"").hexdigest()


def test_a_hot_id_is_spread(spark):
    rows = [(1, "same", "en", "s", 4)] * 5000 + [(k, f"Text {k}", "en", "s", 4) for k in range(2, 2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert counted(M.op13_merkle_manifest(df).collect()) == counted(plain_manifest(rows))


def test_names_that_clash_are_refused(spark):
    with pytest.raises(ValueError):
        M.build_manifest(spark.createDataFrame([("=a", "x", 1)], "tree string, node string, rank long"), ["node"])
