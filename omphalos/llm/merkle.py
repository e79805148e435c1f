"""Merkle manifest of a table: a tree of digests for each group of rows and one over the groups, with proofs.

Rows are ranked within their group, and each run of ``FAN ** height`` consecutive
leaves goes to one aligned builder, which appends nodes to its log in the order in
which they are complete (postorder). The roots of the builders are the leaves of the
next level's builders until one node is left, so no task holds more than one block.

Where a node stands in a log follows from the sizes of the subtrees before it
(``place``), so that proofs address the siblings of a path without a search.
Digests are lower-case hex sha256.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from omphalos.llm.common import Scratch

#: Children of a node; levels that one builder makes, unless told otherwise.
FAN, HEIGHT = 8, 4
#: A table of ranges with at most so many rows is broadcast.
SMALL = 100_000


def node_hash(parts) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def levels_above(total: int, height: int) -> int:
    """Levels that a builder makes in a tree with ``total`` nodes on its level: ``height`` where one block isn't the whole tree."""
    h = 0
    while h < height and FAN**h < total:
        h += 1
    return h


def place(height: int, index: int, leaves: int) -> int:
    """Position in a log in completion order of the ``index``-th node of ``height`` over ``leaves`` leaves.

    The node is complete right after its last leaf and the lower nodes that end
    there; before that leaf come all leaves of less rank and every full subtree of them.
    """
    last = min((index + 1) * FAN**height, leaves) - 1
    at, full = last + height, last // FAN
    while full:
        at += full
        full //= FAN
    return at


def build_log(leaves: list[str], levels: int) -> list[str]:
    """All nodes of an aligned block in completion order; the last one is its root."""
    log: list[str] = []
    open_runs: list[list[str]] = [[] for _ in range(levels + 1)]

    def complete(node: str, height: int) -> None:
        while True:
            log.append(node)
            run = open_runs[height]
            run.append(node)
            if height == levels or len(run) < FAN:
                return
            node, height = node_hash(run), height + 1
            run.clear()

    for leaf in leaves:
        complete(leaf, 0)
    for height in range(levels):
        run = open_runs[height]
        if run:
            parent = node_hash(run)
            run.clear()
            complete(parent, height + 1)
    return log


def _layers(log: list[str], leaves: int, levels: int) -> list[list[str]]:
    """The nodes of each height, fetched from the log by their positions."""
    return [[log[place(h, j, leaves)] for j in range(-(-leaves // FAN**h))] for h in range(levels)]


def _path(layers: list[list[str]], rank: int) -> list[dict]:
    steps = []
    for layer in layers:
        slot = rank % FAN
        run = layer[rank - slot : rank - slot + FAN]
        steps.append({"siblings": run[:slot] + run[slot + 1 :], "slot": slot})
        rank //= FAN
    return steps


PROOF = "array<struct<siblings:array<string>,slot:int>>"
_PROOF = pa.list_(pa.struct([("siblings", pa.list_(pa.string())), ("slot", pa.int32())]))
_SEGMENT = "tree string, block long, total long, n int, leaves long, log array<string>, node string"


def _build(height: int):
    kinds = {"tree": pa.string(), "block": pa.int64(), "total": pa.int64(), "n": pa.int32(), "leaves": pa.int64(), "log": pa.list_(pa.string()), "node": pa.string()}

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("rank")
        first = {c: rows.column(c)[0].as_py() for c in ("tree", "block", "total", "leaves")}
        log = build_log(rows.column("node").to_pylist(), levels_above(first["total"], height))
        made = {**first, "n": rows.num_rows, "log": log, "node": log[-1]}
        return pa.table({c: pa.array([made[c]], t) for c, t in kinds.items()})

    return run


def rank_in_groups(scratch: Scratch, rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``rank`` (from 0) and ``total`` within ``group``, by ``order``, null first.

    Rows are dealt by ranges of (group, order) and sorted inside the partitions;
    a row's rank is its place there plus the counts of the ranges before. ``order``
    must tell all rows apart, so that no range grows with a repeated key; ``group`` has no nulls.
    """
    placed = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    placed = scratch.save(placed.select("*", F.spark_partition_id().alias("range"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row")), "placed")
    runs = scratch.save(placed.groupBy("range", group).agg(F.count("*").alias("n"), F.min("row").alias("first")), "runs")
    before = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select("range", group, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy(group)).alias("total"))
    starts = F.broadcast(starts) if runs.count() <= SMALL else starts.hint("merge")
    return placed.join(starts, ["range", group]).withColumn("rank", F.col("row") + F.col("shift")).drop("range", "row", "shift")


def _blocks(ranked: DataFrame, height: int) -> DataFrame:
    return ranked.withColumns({"block": (F.col("rank") / FAN**height).cast("long"), "leaves": F.col("total")})


def _grow(scratch: Scratch, entries: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """Log segments level by level, and ``(tree, node)`` with the root of each tree."""
    block, levels, roots = FAN**height, [], None
    while True:
        seg = scratch.save(entries.select("tree", "block", "rank", "total", "leaves", "node").groupBy("tree", "block").applyInArrow(_build(height), _SEGMENT), f"log{len(levels)}")
        levels.append(seg)
        done = seg.where(F.col("total") <= block).select("tree", "node")
        roots = done if roots is None else roots.unionByName(done)
        live = seg.where(F.col("total") > block)
        if live.isEmpty():
            return levels, roots
        entries = live.select("tree", (F.col("block") / block).cast("long").alias("block"), F.col("block").alias("rank"), F.ceil(F.col("total") / block).alias("total"), "leaves", "node")


def _expand(height: int):
    """The path of each leaf of a segment, with what leads on from its root."""

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                layers = _layers(r["log"], r["n"], levels_above(r["total"], height))
                first = r["block"] * FAN**height
                at = list(range(first, first + r["n"]))
                paths = [_path(layers, k) + r["proof"] for k in range(r["n"])]
                yield pa.record_batch([pa.array([r["tree"]] * r["n"], pa.string()), pa.array(at, pa.int64()), pa.array(paths, _PROOF)], ["tree", "block", "proof"])

    return run


def _open(ends: DataFrame, height: int) -> DataFrame:
    return ends.select("tree", "block", "total", "n", "log", "proof").mapInArrow(_expand(height), f"tree string, block long, proof {PROOF}")


def _above(levels: list[DataFrame], roots: DataFrame, height: int) -> DataFrame:
    """The lowest segments with ``proof``, the path from their root on; ``roots(tree, proof)`` says how trees go on."""
    below = None
    for seg in reversed(levels):
        whole = F.col("total") <= FAN**height
        ends = seg.where(whole).join(roots, "tree")
        if below is not None:
            ends = ends.unionByName(seg.where(~whole).join(below.hint("merge"), ["tree", "block"]).select(*ends.columns))
        below = _open(ends, height)
    return ends


def _prove(keys: list[str], height: int):
    def run(rows: pa.Table, above: pa.Table) -> pa.Table:
        r = above.to_pylist()[0]
        layers = _layers(r["log"], r["n"], levels_above(r["total"], height))
        rows = rows.sort_by("rank")
        paths = [_path(layers, k) + r["proof"] for k in range(rows.num_rows)]
        return rows.select(keys).append_column("proof", pa.array(paths, _PROOF))

    return run


class Manifest:
    """The trees of a table.

    ``proofs`` holds one row for each row of the table: its columns, ``tree``,
    ``subroot`` and ``proof``, a list of (siblings from left to right, own place
    among them) from the leaf to ``root``. ``log`` holds all nodes of the trees of
    the groups: ``(tree, position, height, node)``. ``root`` is null for no rows.
    """

    def __init__(self, proofs: DataFrame, levels: list[DataFrame], subroots: DataFrame, root: str | None, height: int):
        self.proofs, self.subroots, self.root = proofs, subroots, root
        self._levels, self._height = levels, height

    @property
    def log(self) -> DataFrame:
        parts = [seg.select("tree", "block", "total", "n", "leaves", "log").mapInArrow(_numbered(k, self._height), "tree string, position long, height int, node string") for k, seg in enumerate(self._levels)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def _numbered(level: int, block_height: int):
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                up = levels_above(r["total"], block_height)
                spots, heights, nodes = [], [], []
                for h in range(1 if level else 0, up + 1):
                    for j in range(-(-r["n"] // FAN**h)):
                        height = level * block_height + h
                        index = r["block"] * FAN**block_height // FAN**h + j
                        spots.append(place(height, index, r["leaves"]))
                        heights.append(height)
                        nodes.append(r["log"][place(h, j, r["n"])])
                yield pa.record_batch([pa.array([r["tree"]] * len(nodes), pa.string()), pa.array(spots, pa.int64()), pa.array(heights, pa.int32()), pa.array(nodes, pa.string())], ["tree", "position", "height", "node"])

    return run


def tree_name(group: Column) -> Column:
    """A group's name in the order of groups: null first, then by UTF-8 bytes."""
    return F.when(group.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), group.cast("string")))


def build_manifest(leaves: DataFrame, order: list[str], height: int = HEIGHT) -> Manifest:
    """Trees over ``leaves(tree, node, ...)``, each by ``order`` and then by the leaf; ``tree`` names the group (``tree_name``).

    Equal rows are interchangeable. The columns ``rank``, ``total``, ``block``,
    ``leaves``, ``range``, ``row``, ``salt``, ``subroot`` and ``proof`` are refused.
    """
    own = {"rank", "total", "block", "leaves", "range", "row", "salt", "subroot", "proof"} & set(leaves.columns)
    if own:
        raise ValueError(f"columns {sorted(own)} have names that the manifest uses")
    spark = leaves.sparkSession
    scratch = Scratch(spark, "merkle")
    rows = scratch.save(leaves.withColumn("salt", F.monotonically_increasing_id()), "leaves")
    entries = _blocks(rank_in_groups(scratch, rows, "tree", [*order, "node", "salt"]), height)
    levels, subroots = _grow(scratch, entries, height)

    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("node"))
    tops = scratch.save(_blocks(rank_in_groups(scratch, scratch.save(tops, "subroots"), "tree", ["name"]), height), "tops")
    top_levels, top_root = _grow(scratch, tops, height)
    root = top_root.first()
    start = spark.createDataFrame([("", [])], f"tree string, proof {PROOF}")
    steps = _open(_above(top_levels, start, height), height).select(F.col("block").alias("rank"), "proof")
    ends = scratch.save(tops.join(steps, "rank").select(F.col("name").alias("tree"), F.col("node").alias("subroot"), "proof"), "ends")

    above = _above(levels, ends.select("tree", "proof"), height).select("tree", "block", "total", "n", "log", "proof")
    out = entries.select(*leaves.columns, "block", "rank")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in leaves.schema.fields)
    proved = out.groupBy("tree", "block").cogroup(above.groupBy("tree", "block"))
    proofs = proved.applyInArrow(_prove(leaves.columns, height), f"{fields}, proof {PROOF}")
    named = ends.drop("proof")
    return Manifest(proofs.join(F.broadcast(named) if ends.count() <= SMALL else named, "tree"), levels, named, root and root["node"], height)


def proof_digest(proof: Column) -> Column:
    """Hash of all siblings from the leaf to the root, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda s: s.siblings)), ""), 256)


def fold_proof(node: Column, proof: Column) -> Column:
    """The root that ``node`` leads to with the siblings of ``proof``."""

    def up(at: Column, s: Column) -> Column:
        left = F.array_join(F.slice(s.siblings, F.lit(1), s.slot), "")
        right = F.array_join(F.slice(s.siblings, s.slot + 1, F.greatest(F.size(s.siblings), F.lit(1))), "")
        return F.sha2(F.concat(left, at, right), 256)

    return F.aggregate(proof, node, up)


def row_hash(*values: Column) -> Column:
    """Hash of a row's values, each ``-`` if null, else its UTF-8 byte count, ``:`` and the value."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]), 256)


def op13_merkle_manifest(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Leaf, subroot, root and proof of every row of ``docs`` by ``lang`` and ``doc_id``, checked after tampering with a third of them.

    Where 3 divides the crc32 of the id, the checked row has its text's A-Z
    lower-cased; rows without an id aren't tampered with. Null ids come first,
    rows that share an id go by their leaf, repeated rows each have their leaf,
    an empty table gives no rows, and other columns are left out.
    """
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    kinds = (("doc_id", "long"), ("source", "string"), ("lang", "string"), ("n_chars", "long"), ("text", "string"))
    doc_id, source, lang, n_chars, text = (F.col(c).cast(t) for c, t in kinds)
    changed = F.crc32(doc_id.cast("string")) % 3 == 0
    twin = F.when(changed, row_hash(doc_id, source, lang, n_chars, F.translate(text, upper, upper.lower())))
    leaves = docs.select(doc_id.alias("doc_id"), tree_name(lang).alias("tree"), row_hash(doc_id, source, lang, n_chars, text).alias("node"), twin.alias("twin"))
    made = build_manifest(leaves, ["doc_id"], height)
    root = F.lit(made.root).cast("string")
    out = made.proofs.select("doc_id", F.col("node").alias("leaf"), "subroot", root.alias("root"), proof_digest(F.col("proof")).alias("proof_sha256"), fold_proof(F.coalesce("twin", "node"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
