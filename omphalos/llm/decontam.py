"""Benchmark decontamination: Wu-Manber search for windows of benchmark words.

The alphabet of the search is words: a block is two neighbouring words, and a
block that no window has lets the search jump by almost a whole window.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omphalos.llm.bpe import takes

#: Words of a window; item text (bytes) of one search block.
WINDOW, BLOCK_BYTES = 10, 32_000_000
#: Slots of the block shift table and of the prefix check (powers of two).
SLOTS = 1 << 20

_WORD = re.compile(rb"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    return _WORD.findall(text.encode().lower()) if text else []  # bytes.lower() changes A-Z only


def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    mixed = (a.astype(np.uint64) * np.uint64(0x100000001B3) + b.astype(np.uint64) + np.uint64(1)) * _MIX
    return (mixed >> np.uint64(44)).astype(np.int64)  # 20 bits


class WuManber:
    """All occurrences of word patterns of one length in sequences of word ids (0: in no pattern).

    ``shift`` holds, for the block of two words that ends a search window, how
    far the window may jump; where it is 0, ``buckets`` lists the patterns that
    end in such a block, and those are compared word by word.
    """

    def __init__(self, patterns: np.ndarray):
        self.patterns = patterns
        n, m = patterns.shape
        self.m, self.b = m, min(2, m)
        self.shift = np.full(SLOTS, m - self.b + 1, np.int64)
        for j in range(self.b - 1, m):  # blocks nearer to the end have the smaller shifts, so they come last
            self.shift[self._block(patterns[:, j - 1] if self.b == 2 else None, patterns[:, j])] = m - 1 - j
        last = self._block(patterns[:, m - 2] if self.b == 2 else None, patterns[:, m - 1])
        order = np.argsort(last, kind="stable")
        self.order, ends = order, last[order]
        self.first = np.searchsorted(ends, np.arange(SLOTS + 1)).astype(np.int64)

    def _block(self, a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
        return _slot(np.zeros_like(b) if a is None else a, b)

    def search(self, ids: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places (index of the first word) and patterns found in ``ids[start:end]`` of every text.

        Each text is a lane; lanes move by their own shifts in step. Long texts
        are cut into overlapping pieces first, so that lanes are alike.
        """
        piece = 4096
        count = np.maximum(0, -(-(ends - starts - self.m + 1) // piece))
        lane = np.repeat(np.arange(len(starts)), count)
        nth = np.arange(len(lane)) - np.repeat(np.cumsum(count) - count, count)
        at = starts[lane] + nth * piece + self.m - 1  # index of the last word of the search window
        stop = np.minimum(ends[lane], starts[lane] + (nth + 1) * piece + self.m - 1)
        places, found = [], []
        while at.size:
            block = self._block(ids[at - 1] if self.b == 2 else None, ids[at])
            jump = self.shift[block]
            hit = np.flatnonzero(jump == 0)
            if hit.size:
                slot, begin = block[hit], at[hit] - self.m + 1
                size = self.first[slot + 1] - self.first[slot]
                which = np.repeat(np.arange(hit.size), size)
                offset = np.arange(which.size) - np.repeat(np.cumsum(size) - size, size)
                pattern = self.order[self.first[slot][which] + offset]
                begin = begin[which]
                for j in range(self.m):  # the first words tell most apart
                    same = ids[begin + j] == self.patterns[pattern, j]
                    begin, pattern = begin[same], pattern[same]
                    if not begin.size:
                        break
                places.append(begin)
                found.append(pattern)
            at = at + np.maximum(jump, 1)
            go = at < stop
            at, stop = at[go], stop[go]
        none = np.empty(0, np.int64)
        return np.concatenate([none, *places]), np.concatenate([none, *found])


class Benchmark:
    """Windows of one block of benchmark items, ready to be searched for."""

    def __init__(self, items: list[tuple[str, str | None]], window: int):
        self.vocab: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple, set]] = {}
        for item, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab) + 1) for w in words_of(text)]
            m = min(window, len(ids))
            for i in range(len(ids) - m + 1 if m else 0):
                by_length.setdefault(m, {}).setdefault(tuple(ids[i : i + m]), set()).add(item)
        self.parts = [(WuManber(np.array(list(w), np.int64)), list(w.values())) for _, w in sorted(by_length.items())]

    def search(self, texts: list[list[bytes]]) -> tuple[list[np.ndarray], list[set]]:
        """For each text: a mask of the words inside an occurrence, and the items that occur."""
        sizes = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(sizes)
        starts = ends - sizes
        get = self.vocab.get
        ids = np.fromiter((get(w, 0) for t in texts for w in t), np.int64, int(sizes.sum()))
        depth = np.zeros(len(ids) + 1, np.int64)
        items: list[set] = [set() for _ in texts]
        for search, owners in self.parts:
            places, found = search.search(ids, starts, ends)
            np.add.at(depth, places, 1)
            np.add.at(depth, places + search.m, -1)
            text = np.searchsorted(ends, places, side="right")
            for t, p in {*zip(text.tolist(), found.tolist(), strict=True)}:
                items[t] |= owners[p]
        mask = np.cumsum(depth)[:-1] > 0
        return [mask[a:b] for a, b in zip(starts, ends, strict=True)], items


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[str, str | None]]]:
    """Items in blocks of at most BLOCK_BYTES of text (one longer item is a block), fetched one at a time."""
    block, size = [], 0
    for r in benchmark.where(F.col(item).isNotNull()).select(F.col(item).cast("string"), text).toLocalIterator():
        n = len((r[1] or "").encode())
        if block and size + n > BLOCK_BYTES:
            yield block
            block, size = [], 0
        block.append((r[0], r[1]))
        size += n
    if block:
        yield block


def find_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (array of hit word runs ``start, end``) and ``items`` (sorted array<string>).

    A benchmark of up to BLOCK_BYTES is searched in one pass; a larger one in
    blocks of that size, one pass after another over the rows, which carry what
    the blocks before have found. Nothing is shuffled. Items without a word or
    an id match nothing; null texts have no words; columns named ``n_words``,
    ``hits`` or ``items`` are replaced.
    """
    spark = docs.sparkSession
    out = docs.drop("n_words", "hits", "items").select(
        "*", F.lit(0).cast("long").alias("n_words"), F.array().cast("array<array<int>>").alias("hits"), F.array().cast("array<string>").alias("items")
    )
    schema, at = out.schema, out.columns.index(text)

    def searched(block):
        def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bench = Benchmark(block.value, window)
            for whole in batches:
                for a, b in takes(pc.utf8_length(whole.column(at)).to_pylist()):
                    batch = whole.slice(a, b - a)
                    texts = [words_of(t) for t in batch.column(at).to_pylist()]
                    masks, items = bench.search(texts)
                    hits, before = [], batch.column(len(schema) - 2).to_pylist()
                    for mask, old in zip(masks, before, strict=True):
                        for x, y in old:
                            mask[x:y] = True
                        edge = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
                        hits.append(edge.reshape(-1, 2).tolist())
                    named = [sorted({*old, *new}) for old, new in zip(batch.column(len(schema) - 1).to_pylist(), items, strict=True)]
                    counts = pa.array([len(t) for t in texts], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [*batch.columns[: len(schema) - 3], counts, pa.array(hits, pa.list_(pa.list_(pa.int32()))), pa.array(named, pa.list_(pa.string()))], names=schema.names
                    )

        return search

    some = False
    for block in _blocks(benchmark, item, item_text):
        some = True
        out = out.mapInArrow(searched(spark.sparkContext.broadcast(block)), schema)
    return out if some else out.mapInArrow(searched(spark.sparkContext.broadcast([])), schema)


def op5_benchmark_decontamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document: its words, those that are hit, and a digest of the items found."""
    out = find_benchmark(docs.select("doc_id", "text"), benchmark)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, h: n + F.get(h, F.lit(1)) - F.get(h, F.lit(0)))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )
