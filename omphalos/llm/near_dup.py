"""MinHash near-duplicate detection: bands, signature check, exact check, components.

Documents with equal shingle sets form classes, and one of each class goes on.
Members of a band bucket are compared with the bucket's least member (a star,
never all pairs); the links found join them into components. Only buckets that
still hold several components are looked at again: their members outside the
largest component are compared inside the tasks with the members of other
components, first by signature and then exactly, until a link joins the two.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omphalos.llm.bpe import takes
from omphalos.llm.common import Scratch, hot_lookup
from omphalos.llm.components import connected_components

#: Bands of ROWS minima each. A link of similarity 0.8 misses every band with
#: probability (1 - 0.8**6)**64 = 4e-9.
BANDS, ROWS = 64, 6
#: Minima of a sketch: those of the bands and more. In a pair of similarity 0.8
#: a fifth of its bytes differ, with a deviation of 1.4 % of all; five deviations
#: are allowed, so a link fails the sketch with probability 3e-7.
SKETCH, SLACK = 768, 5.0
#: Comparisons of signatures that one block of an open bucket holds (each of its two sides holds about the square
#: root), and bytes of shingle sets of a side, about.
BLOCK, SIDE_BYTES = 20_000_000, 16 << 20

_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SEEDS = np.random.default_rng(20240607)
_A = (_SEEDS.integers(0, 1 << 31, SKETCH, np.uint32) * np.uint32(2) + np.uint32(1))[:, None]
_B = _SEEDS.integers(0, 1 << 32, SKETCH, np.uint32)[:, None]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _P1
    return x ^ (x >> np.uint64(29))


class Shingler:
    """Sets of 64-bit shingle hashes of whole texts, with a bounded memory of word hashes."""

    def __init__(self, words: int):
        self.words, self.known = words, {}

    def shingles(self, text: str | None) -> np.ndarray:
        """Sorted different hashes; a text of fewer words is one shingle, one without words has none."""
        found = text.encode().lower().split() if text else []  # bytes.split() knows the six blanks, bytes.lower() A-Z
        if not found:
            return np.empty(0, np.uint64)
        known = self.known
        if len(known) > 500_000:
            known.clear()
        try:
            ids = list(map(known.__getitem__, found))
        except KeyError:
            from xxhash import xxh3_64_intdigest

            for w in found:
                if w not in known:
                    known[w] = xxh3_64_intdigest(w)
            ids = list(map(known.__getitem__, found))
        h = np.array(ids, np.uint64)
        n = min(self.words, len(h))
        out = np.zeros(len(h) - n + 1, np.uint64)
        for i in range(n):
            out = _mix(out + h[i : len(h) - n + 1 + i] * _P2 + np.uint64(i + 1))
        return np.unique(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """SKETCH minima under universal hashes a*x + b of the shingles, as 32-bit numbers."""
    x = (shingles >> np.uint64(32)).astype(np.uint32) ^ shingles.astype(np.uint32)
    out = np.full(SKETCH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):  # keeps the table of a long text small
        part = x[None, at : at + 2048] * _A
        part += _B
        np.minimum(out, part.min(axis=1), out=out)
    return out


def signed(docs: DataFrame, doc_id: str, text: str, words: int) -> DataFrame:
    """``doc_id, n_shingles, print (16 bytes of the set), keys (a long for each band), sketch (a byte for each minimum)``."""
    schema = docs.select(F.col(doc_id).cast("long").alias("doc_id")).selectExpr(
        "doc_id", "0L AS n_shingles", "CAST(NULL AS BINARY) AS print", "CAST(NULL AS ARRAY<BIGINT>) AS keys", "CAST(NULL AS BINARY) AS sketch"
    ).schema

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        make = Shingler(words)
        for whole in batches:
            column = whole.column(1)
            for a, b in takes(pc.utf8_length(column).to_pylist()):
                rows = []
                for t in column.slice(a, b - a).to_pylist():
                    s = make.shingles(t)
                    if not len(s):
                        rows.append((0, None, None, None))
                        continue
                    minima = signature(s)
                    keys = _mix(np.arange(1, BANDS + 1).astype(np.uint64))
                    for row in minima[: BANDS * ROWS].reshape(BANDS, ROWS).T:
                        keys = _mix(keys + row.astype(np.uint64) * _P2)
                    rows.append((len(s), hashlib.blake2b(s.tobytes(), digest_size=16).digest(), keys.astype(np.int64), ((minima * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).tobytes()))
                n, marks, keys, sketches = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [whole.column(0).slice(a, b - a), pa.array(n, pa.int64()), pa.array(marks, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], names=schema.names
                )

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(sign, schema)


def _slack(percent: int) -> int:
    """Sketch bytes that may differ in a pair of the similarity."""
    total, p = SKETCH, percent / 100
    return int(total * (1 - p) + SLACK * (total * p * (1 - p)) ** 0.5)


def _alike(pairs: DataFrame, cards: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes allow the similarity and whose sketches agree enough (with SLACK)."""
    total, most = SKETCH, _slack(percent)
    a, b = (cards.select(F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("sketch").alias(f"s{x}")) for x in "ab")
    # a head of very many pairs makes a skewed partition, which adaptive execution splits in these joins
    sized = pairs.join(b.hint("merge"), "b").join(a.hint("merge"), "a").where((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, total) for c in ("sa", "sb"))
                near = pa.array((x != y).sum(axis=1) <= most)
                yield batch.select(["a", "b"]).filter(near)

    return sized.select("a", "b", "sa", "sb").mapInArrow(compare, "a long, b long")


def _sets(texts: DataFrame, words: int) -> DataFrame:
    """``doc_id, shingles``: the sorted hashes as bytes."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = Shingler(words)
        for whole in batches:
            column = whole.column(1)
            for a, b in takes(pc.utf8_length(column).to_pylist()):
                found = [make.shingles(t).tobytes() for t in column.slice(a, b - a).to_pylist()]
                yield pa.RecordBatch.from_arrays([whole.column(0).slice(a, b - a), pa.array(found, pa.binary())], names=["doc_id", "shingles"])

    return texts.select("doc_id", "text").mapInArrow(cut, "doc_id long, shingles binary")


def _joining(doc, part, size, sketch, sets, mine, other, percent: int, most: int) -> list[tuple[int, int]]:
    """Links of a block that join two components: at most one fewer than it has components."""
    root, out = part.copy(), []
    words = [np.frombuffer(x, np.uint64) for x in sets]
    for i in np.flatnonzero(mine):
        can = np.flatnonzero(other & (root != root[i]) & (100 * np.minimum(size, size[i]) >= percent * np.maximum(size, size[i])))
        for j in can[(sketch[can] != sketch[i]).sum(axis=1) <= most].tolist():
            if root[j] != root[i]:
                both = len(np.intersect1d(words[i], words[j], assume_unique=True))
                if 100 * both >= percent * (len(words[i]) + len(words[j]) - both):
                    root[root == root[j]] = root[i]
                    out.append((int(min(doc[i], doc[j])), int(max(doc[i], doc[j]))))
    return out


def _across(scratch: Scratch, member: DataFrame, cards: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between different components that share a bucket, enough of them to join what any link joins.

    ``member`` is ``key, doc_id, n_shingles, component``. A bucket of n members with
    o of them outside its largest component takes up to o * n comparisons. Both sides
    are cut into chunks of bounded rows and bytes, and each chunk of the o meets each
    chunk of the n in a block of its own, so a task holds two chunks at a time. A pair
    whose components earlier links of the block have joined needs no comparison, so
    what leaves a block is at most one link for each component in it.
    """
    total, most, side = SKETCH, _slack(percent), BLOCK**0.5
    by_part = member.groupBy("key", "component").agg(F.count("*").alias("c"), F.sum("n_shingles").alias("s"))
    largest = by_part.groupBy("key").agg(F.max(F.struct("c", "s", "component")).alias("top"), F.sum("c").alias("n"), F.sum("s").alias("s")).where("n > top.c")
    chunks = lambda n, s: F.ceil(F.greatest(n / side, 8 * s / SIDE_BYTES)).cast("long")
    open_ = largest.select(
        "key", F.col("top.component").alias("main"), "n", chunks(F.col("n") - F.col("top.c"), F.col("s") - F.col("top.s")).alias("outer"), chunks(F.col("n"), F.col("s")).alias("inner")
    )
    dealt = scratch.save(hot_lookup(member, scratch.save(open_, "open"), "key", "n"), "dealt")
    ids = dealt.select("doc_id").distinct()
    sets = scratch.save(_sets(texts.join(ids.hint("merge"), "doc_id", "left_semi"), words), "sets")
    wide = dealt.join(cards.select("doc_id", "sketch").hint("merge"), "doc_id").join(sets.hint("merge"), "doc_id")
    mark, inner, outer, block = F.xxhash64("doc_id"), F.col("inner"), F.col("outer"), F.col("block")
    wide = wide.withColumns({"outside": F.col("component") != F.col("main"), "i": F.pmod(mark, outer), "j": F.pmod(mark, inner)})
    # block i * inner + j is where chunk i of the outsiders meets chunk j of all members
    as_member = F.transform(F.sequence(F.lit(0).cast("long"), outer - 1), lambda i: i * inner + F.col("j"))
    as_outsider = F.transform(F.sequence(F.lit(0).cast("long"), inner - 1), lambda j: F.col("i") * inner + j)
    wide = wide.withColumn("block", F.explode(F.when(F.col("outside"), F.array_union(as_member, as_outsider)).otherwise(as_member)))
    mine, other = F.col("outside") & (F.floor(block / inner) == F.col("i")), block % inner == F.col("j")
    wide = wide.select("key", "block", "doc_id", "component", "n_shingles", "sketch", "shingles", mine.alias("mine"), other.alias("other"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] | None = None  # rows of a block that goes on in the next batch
        found: set[tuple[int, int]] = set()

        def ended(columns: list[np.ndarray], last: bool) -> list[np.ndarray]:
            edge = np.flatnonzero((np.diff(columns[0]) != 0) | (np.diff(columns[1]) != 0)) + 1
            edges = [0, *edge.tolist(), *([len(columns[0])] if last else [])]
            for x, y in zip(edges, edges[1:], strict=False):
                found.update(_joining(*(c[x:y] for c in columns[2:]), percent, most))
            return [c[edges[-1] :] for c in columns]

        def pairs() -> pa.RecordBatch:
            a, b = zip(*sorted(found), strict=True) if found else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        for batch in batches:
            columns = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("key", "block", "doc_id", "component", "n_shingles")]
            columns.append(np.frombuffer(b"".join(batch.column("sketch").to_pylist()), np.uint8).reshape(-1, total))
            columns += [batch.column(c).to_numpy(zero_copy_only=False) for c in ("shingles", "mine", "other")]
            held = ended(columns if held is None else [np.concatenate(x) for x in zip(held, columns, strict=True)], False)
            if len(found) > 100_000:
                yield pairs()
                found.clear()
        if held is not None:
            ended(held, True)
        yield pairs()

    blocks = wide.repartition("key", "block").sortWithinPartitions("key", "block")
    return blocks.mapInArrow(compare, "a long, b long").distinct()


def _confirmed(scratch: Scratch, pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs whose full shingle sets have the similarity: 100 * both >= percent * either."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    # a merge join at every size: the ids grow with the documents
    texts = scratch.save(texts.join(ids.hint("merge"), "doc_id", "left_semi"), "texts")
    a, b = (texts.select(F.col("doc_id").alias(x), F.col("text").alias(f"t{x}")) for x in "ab")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make, last = Shingler(words), (None, None)
        for batch in batches:
            good = []
            for i, x, y in zip(batch.column("a").to_pylist(), batch.column("ta"), batch.column("tb"), strict=True):
                if last[0] != i:  # the last join sorts by a, so the pairs of a star follow each other
                    last = (i, make.shingles(x.as_py()))
                other = make.shingles(y.as_py())
                both = len(np.intersect1d(last[1], other, assume_unique=True))
                good.append(100 * both >= percent * (len(last[1]) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(b.hint("merge"), "b").join(a.hint("merge"), "a").select("a", "b", "ta", "tb").mapInArrow(confirm, "a long, b long")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents are linked when 100 * intersection >= percent * union of their
    sets of ``words``-word shingles; a component is what links reach, named by
    its least id, which is the one kept. Null, empty and blank texts have no
    shingles and stay alone; a row without an id has no component and is kept;
    rows that share an id are one document to the links. Only the id and text
    columns are read, so other columns can't clash.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "near-dup")
    cards = scratch.save(signed(docs, doc_id, text, words), "cards")
    usable = cards.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    classes = scratch.save(usable.groupBy("print").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "classes")
    several = classes.where("n > 1")
    same = scratch.save(hot_lookup(usable.select("print", "doc_id"), several, "print", "n").where("doc_id <> rep").select("doc_id", "rep"), "same")
    reps = usable.join(classes.select("print", F.col("rep").alias("doc_id")), ["print", "doc_id"], "left_semi").dropDuplicates(["print", "doc_id"])
    reps = scratch.save(reps.select("doc_id", "n_shingles", "keys", "sketch"), "reps")
    sizes = scratch.save(cards.select("doc_id", "n_shingles"), "sizes")
    scratch.drop(cards)
    buckets = reps.select(F.explode("keys").alias("key"), "doc_id", "n_shingles")
    heads = scratch.save(buckets.groupBy("key").agg(F.min("doc_id").alias("head"), F.count("*").alias("n")).where("n > 1"), "heads")
    shared = scratch.save(hot_lookup(buckets, heads, "key", "n"), "shared")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    stars = shared.where("doc_id <> head").select(F.col("head").alias("a"), F.col("doc_id").alias("b")).distinct()
    near = scratch.save(_alike(stars, reps, percent), "near")
    found = scratch.save(_confirmed(scratch, near, texts, words, percent), "found")
    parts = connected_components(scratch, found).withColumnsRenamed({"node": "doc_id"})
    member = shared.select("key", "doc_id", "n_shingles").join(parts, "doc_id", "left").withColumn("component", F.coalesce("component", "doc_id"))
    member = scratch.save(member, "member")
    scratch.drop(shared, heads)
    more = scratch.save(_across(scratch, member, reps, texts, words, percent), "more")
    scratch.drop(member)
    parts = connected_components(scratch, found.unionByName(more)).withColumnsRenamed({"node": "doc_id", "component": "component_id"})
    # a class has the component of the document that stands for it
    named = several.selectExpr("rep", "n").join(parts.withColumnRenamed("doc_id", "rep"), "rep", "left").select("rep", F.coalesce("component_id", "rep").alias("component_id"), "n")
    copies = hot_lookup(same, scratch.save(named, "named"), "rep", "n").select("doc_id", "component_id")
    # rows that share an id can be of several classes; the least component is theirs
    parts = parts.unionByName(copies).groupBy("doc_id").agg(F.min("component_id").alias("component_id"))
    out = sizes.join(parts, "doc_id", "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def op7_minhash_near_dedup(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` on four-word shingles and a similarity of 0.8."""
    return near_duplicates(docs, words=4, percent=80)
