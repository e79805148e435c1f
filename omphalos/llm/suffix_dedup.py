"""Removal of passages that other documents have too, by external induced suffix sorting.

Every SPAN-byte window belongs to its anchor, the (leftmost) string of some
bytes in it with the least hash, so equal windows have equal anchors. Windows in
a row with equal anchors make one piece of text. Pieces whose anchor two rows
have go to the shard of its hash, so equal windows meet; each shard sorts the
suffixes of the different pieces by external induction (``suffix_sort``), whose
common-prefix values give the groups of equal windows. What a task already
knows to be repeated, it reports itself, so a passage of a third of all
documents reaches its shard once for each task and not once for each document.
An anchor with HOT different pieces or more (a common phrase, with other text
around it in each document) isn't sorted in one shard: its pieces are texts of
the same steps with longer anchors. The longest are whole windows, so pieces of
one are equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omphalos.llm.bpe import takes
from omphalos.llm.common import Scratch, hot_lookup, union_all
from omphalos.llm.suffix_sort import CAP, SEPARATOR, suffix_order

SPAN = CAP
#: Bytes of anchors; each next size splits the pieces of the hot ones of the size before.
SIZES = (32, 44, SPAN)
#: Anchors that a task looks at together, bytes of text for each task that compares anchors, bytes of pieces for
#: each task that sorts them (about 100 bytes of memory each), shards of a task, and bytes that are hashed together.
CHUNK, TEXT_BYTES, SORT_BYTES, FINE, BLOCK = 1_500_000, 12_000_000, 2_500_000, 4, 1 << 18
#: Windows of a piece at most (a byte of a cut holds them).
WINDOWS = 200
#: Different pieces from which on an anchor is hot, and bytes of text for each more of them (so hot anchors are few).
HOT, HOT_SHARE = 10_000, 10_000_000

_BASES = 0x100000001B3, 0x9E3779B97F4A7C15
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


class Hashes:
    """64-bit hashes of any strings of one block of bytes, from sums of its bytes times powers of a base."""

    def __init__(self, raw: np.ndarray, base: int = _BASES[0]):
        n = len(raw) + 1
        if base not in _powers or len(_powers[base][0]) < n:
            inverse = pow(base, -1, 1 << 64)
            _powers[base] = tuple(np.append(np.uint64(1), np.cumprod(np.full(n, x, np.uint64))) for x in (base, inverse))
        up, self.down = _powers[base]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[: n - 1], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hashes of the strings from ``a`` up to ``b``."""
        return _mixed((self.sums[b] - self.sums[a]) * self.down[a])

    def all(self, size: int) -> np.ndarray:
        """Hashes of all strings of ``size`` bytes."""
        n = max(0, len(self.sums) - size)
        return _mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def _over(values: np.ndarray, width: int) -> np.ndarray:
    """Minima over every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values, size = np.minimum(values[:-size], values[size:]), 2 * size
    return np.minimum(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def _ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The numbers from each start on, ``counts`` of them each, one after another."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


_KEY = np.uint64(0xFFFFFFFFFFFF)  # 48 bits: a chance meeting only costs a closer look
_LOW = np.uint64(0xFFFFFFFF)


def pieces(raw: np.ndarray, sizes: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """``(first, last, place, key, mark)`` of the pieces of the strings of ``sizes`` bytes that follow each other in ``raw``.

    A piece is the windows from ``first`` to ``last``, at most WINDOWS, whose anchors
    are equal to the one at ``place``, that of the first; ``key`` is the anchor's hash,
    ``mark`` one of the piece. So text of a short period makes few pieces.
    """
    counts = np.maximum(sizes - SPAN + 1, 0)
    window = _ranges(np.cumsum(sizes) - sizes, counts)
    if not len(window):
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint32)
    hashes = Hashes(raw)
    own = hashes.all(size)
    least = _over((own & ~_LOW) | np.arange(len(own), dtype=np.uint64), SPAN - size + 1)
    place = (least[window] & _LOW).astype(np.int64)
    at = np.flatnonzero(np.append(True, (own[place[1:]] != own[place[:-1]]) | (window[1:] != window[:-1] + 1)))
    length = np.diff(np.append(at, len(window)))
    parts = -(-length // WINDOWS)
    at = np.repeat(at, parts) + _ranges(np.zeros(len(at), np.int64), parts) * WINDOWS
    first, last, place = window[at], window[np.append(at[1:], len(window)) - 1], place[at]
    return first, last, place, own[place] & _KEY, (hashes.of(first, last + SPAN) >> np.uint64(33)).astype(np.uint32)


def _buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(bytes, offsets)`` of an array of strings."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8), offsets


def _binary(raw: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The strings of ``sizes`` bytes that follow each other in ``raw``."""
    offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))])


def _union(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Unions of overlapping or touching runs of the same row."""
    if not len(row):
        return row, start, end
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order].astype(np.int64), end[order].astype(np.int64)
    rank = np.cumsum(np.append(0, row[1:] != row[:-1])) << 32
    reach = np.maximum.accumulate(end + rank)
    at = np.flatnonzero(np.append(True, (start + rank)[1:] > reach[:-1]))
    return row[at], start[at], (reach - rank)[np.append(at[1:], len(row)) - 1]


def _first_of(*keys: np.ndarray) -> np.ndarray:
    """Where sorted keys change, the first place included."""
    change = np.zeros(max(0, len(keys[0]) - 1), bool)
    for k in keys:
        change |= k[1:] != k[:-1]
    return np.flatnonzero(np.append(True, change)) if len(keys[0]) else np.empty(0, np.int64)


def _pack(shard: int, kind: int, **columns: np.ndarray) -> dict:
    return {"shard": shard, "kind": kind} | {k: v.tobytes() for k, v in columns.items()}


_ASK = "shard int, kind int, key binary, mark binary, proven binary, row binary, first binary, reach binary"
_FOUND = "row long, cut long, hot long"
_SEEN = "shard int, kind int, key binary, doc binary, row binary, first binary, size binary, body binary"
_RUNS = "row long, start int, end int, doc long, body binary"


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int32() if x.split()[1] == "int" else pa.binary() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], k) for n, k in zip(names, kinds, strict=True)], names=names)


def _parts(batches: Iterator[pa.RecordBatch]) -> tuple[dict[str, list[bytes]], ...]:
    """Blobs by column of the rows of kind 0, of kind 1 and of kind 2."""
    found: tuple[dict, ...] = ({}, {}, {})
    for batch in batches:
        kind = batch.column("kind").to_pylist()
        for name in batch.schema.names[2:]:
            for k, v in zip(kind, batch.column(name).to_pylist(), strict=True):
                if v is not None:
                    found[k].setdefault(name, []).append(v)
    return found


def _join(blobs: list[bytes] | None, kind) -> np.ndarray:
    return np.frombuffer(b"".join(blobs or ()), kind)


def _by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each different key with its places."""
    order = np.argsort(keys, kind="stable")
    cuts = _first_of(keys[order])
    for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True):
        yield int(keys[order[a]]), order[a:b]


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, ...]]:
    """Columns of rows of about four million bytes together; the column ``text`` comes last, as bytes."""
    for batch in batches:
        for a, b in takes(pc.binary_length(batch.column(batch.num_columns - 1)).to_pylist()):
            *rest, text = (c.slice(a, b - a) for c in batch.columns)
            yield *(c.to_pylist() for c in rest), [t.encode() if isinstance(t, str) else t for t in text.to_pylist()]


def _strings(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(text, start, size)`` of strings that hold each window of the texts once, about BLOCK bytes at a time."""
    size = np.diff(offsets)
    n = np.maximum(1, -(-(size - SPAN + 1) // BLOCK))  # long texts are cut, with SPAN - 1 bytes in common
    text = np.repeat(np.arange(len(size)), n)
    start = (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * BLOCK
    size = np.minimum(size[text] - start, BLOCK + SPAN - 1)
    group = np.cumsum(size) // BLOCK
    for i in np.split(np.arange(len(text)), _first_of(group)[1:]) if len(text) else ():
        yield text[i], start[i], size[i]


def _shared_anchors(texts: DataFrame, size: int, shards: int, limit: int) -> DataFrame:
    """``(row, cut)`` of the pieces whose anchor of ``size`` bytes two rows or more have; ``texts`` is ``row, text``.

    A cut is the piece's first window, its anchor's place from there and the
    number of its other windows. Rows with ``hot`` instead name the anchors of
    more than ``limit`` different pieces.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0

        def flush() -> pa.RecordBatch:
            key, mark, row, first, reach = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((row, mark, key))
            key, mark, row, first, reach = key[order], mark[order], row[order], first[order], reach[order]
            at = _first_of(key)
            group = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(key))))
            proven = (np.minimum.reduceat(row, at) != np.maximum.reduceat(row, at))[group]
            asked = ~proven
            asked[_first_of(key, mark)] = True  # of a proven anchor each different piece tells the other tasks once
            out = []
            shard = (key % np.uint64(FINE * shards)).astype(np.int64)
            for s, i in _by(np.where(asked, shard, -1)):
                if s >= 0:
                    out.append(_pack(s, 0, key=key[i], mark=mark[i], proven=proven[i], row=row[i], first=first[i], reach=reach[i]))
                else:  # known to be shared already
                    out += [_pack(n, 1, row=row[j], first=first[j], reach=reach[j]) for n, j in enumerate(np.array_split(i, min(shards, 64)))]
            return _batch(out, _ASK)

        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False)
            data, offsets = _buffer(batch.column(1))
            for text, start, sizes in _strings(data, offsets):
                begin = offsets[text] + start
                a, b, place, key, mark = pieces(data[_ranges(begin, sizes)], sizes, size)
                bounds = np.cumsum(sizes)
                own = np.searchsorted(bounds, a, side="right")
                shift = (start - (bounds - sizes))[own]
                held.append((key, mark, rows[text[own]], (a + shift).astype(np.int32), ((place - a) << 8 | (b - a)).astype(np.uint16)))
                count += len(key)
                if count > CHUNK:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, known, _ = _parts(batches)
        key, mark, proven, row, first, reach = (_join(asked.get(c), k) for c, k in zip(("key", "mark", "proven", "row", "first", "reach"), (np.uint64, np.uint32, bool, np.int64, np.int32, np.uint16), strict=True))
        cut = lambda a, r: a.astype(np.int64) << 16 | r
        good, hot = np.empty(0, np.int64), np.empty(0, np.int64)
        if len(key):
            order = np.lexsort((mark, key))
            at = _first_of(key[order])
            row_of, different = row[order], np.zeros(len(key), np.int64)
            different[_first_of(key[order], mark[order])] = 1
            shared = (np.minimum.reduceat(row_of, at) != np.maximum.reduceat(row_of, at)) | np.logical_or.reduceat(proven[order], at)
            good = order[np.repeat(shared, np.diff(np.append(at, len(key))))]
            hot = key[order][at[shared & (np.add.reduceat(different, at) > limit)]].astype(np.int64)
        rows = np.concatenate([row[good], _join(known.get("row"), np.int64)])
        cuts = np.concatenate([cut(first[good], reach[good]), cut(_join(known.get("first"), np.int32), _join(known.get("reach"), np.uint16))])
        for i in range(0, len(rows), 100_000):
            part = rows[i : i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(cuts[i : i + 100_000]), pa.nulls(len(part), pa.int64())], names=["row", "cut", "hot"])
        if len(hot) and size < SPAN:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(hot), pa.int64()), pa.nulls(len(hot), pa.int64()), pa.array(hot)], names=["row", "cut", "hot"])

    return texts.mapInArrow(ask, _ASK).repartition(shards, "shard").mapInArrow(answer, _FOUND)


def repeated_windows(bodies: pa.Array, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(body, start, end)`` of the runs of bytes of different ``bodies`` inside a SPAN-byte string of another with a smaller document."""
    none = np.empty(0, np.int64)
    if len(bodies) < 2:
        return none, none, none
    data, offsets = _buffer(bodies)
    sizes = np.diff(offsets)
    starts = np.cumsum(sizes + 1) - sizes - 1
    joined = np.full(int(sizes.sum()) + len(sizes), SEPARATOR, np.uint8)
    joined[_ranges(starts, sizes)] = data[offsets[0] : offsets[-1]]
    places, shared = suffix_order(joined)
    owner = np.searchsorted(starts, places, side="right") - 1
    whole = np.flatnonzero(places - starts[owner] <= sizes[owner] - SPAN)  # suffixes that hold a window
    if not len(whole):
        return none, none, none
    near = np.minimum.reduceat(shared[: whole[-1] + 1], np.append(0, whole[:-1] + 1))
    first = np.flatnonzero(np.append(True, near[1:] < SPAN))
    group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(whole))))
    owner, places = owner[whole], places[whole]
    hit = np.flatnonzero(docs[owner] > np.minimum.reduceat(docs[owner], first)[group])
    start = places[hit] - starts[owner[hit]]
    return _union(owner[hit], start, start + SPAN)


def _related(keys: np.ndarray) -> np.ndarray:
    """Which of the different bodies, with anchors ``keys``, have an anchor that another has too; only these may share a window."""
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return counts[which] > 1


def _different(bodies: pa.Array, doc: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """``(which, bodies, least)``: the different bodies, which of them each is, and the least document of each."""
    coded = bodies.dictionary_encode()
    which = coded.indices.to_numpy(zero_copy_only=False)
    least = np.full(len(coded.dictionary), np.iinfo(np.int64).max)
    np.minimum.at(least, which, doc)
    return which, coded.dictionary, least


def _sorted_runs(key: np.ndarray, doc: np.ndarray, row: np.ndarray, first: np.ndarray, bodies: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, start, end)`` of what the pieces have from a smaller document."""
    which, bodies, least = _different(bodies, doc)
    keys = np.empty(len(bodies), key.dtype)
    keys[which] = key
    asked = np.flatnonzero(_related(keys))
    body, start, end = repeated_windows(bodies.take(pa.array(asked)), least[asked])
    body = asked[body]
    size = pc.binary_length(bodies).to_numpy(zero_copy_only=False)
    later = doc > least[which]
    own = np.flatnonzero(~later)  # these have the runs of their body
    begin, until = np.searchsorted(body, which[own]), np.searchsorted(body, which[own], side="right")
    run, of = _ranges(begin, until - begin), np.repeat(own, until - begin)
    whole = np.flatnonzero(later)
    return (
        np.concatenate([row[whole], row[of]]),
        np.concatenate([first[whole], first[of] + start[run]]),
        np.concatenate([first[whole] + size[which[whole]], first[of] + end[run]]),
    )


def _repeated(around: DataFrame, size: int, shards: int, hot: np.ndarray) -> DataFrame:
    """``(row, start, end)`` of repeated bytes; ``around`` is ``row, doc_id, cuts, text`` with the pieces of shared anchors.

    Pieces of the anchors in ``hot`` (sorted) aren't looked at: they are rows with a ``doc`` and a ``body``.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        count = 0

        def flush() -> pa.RecordBatch:
            key, doc, row, first, sizes, raw = (np.concatenate(x) for x in zip(*held, strict=True))
            bodies = _binary(raw, sizes)
            which, _, least = _different(bodies, doc)
            later = doc > least[which]
            out = []
            known = _union(row[later], first[later], first[later] + sizes[later])
            for n, i in enumerate(np.array_split(np.arange(len(known[0])), -(-len(known[0]) // 20_000))) if len(known[0]) else ():
                out.append(_pack(n % shards, 1, row=known[0][i], first=known[1][i].astype(np.int32), size=known[2][i].astype(np.int32)))
            apart = np.isin(key.astype(np.int64), hot)
            shard = (key % np.uint64(FINE * shards)).astype(np.int64)
            i = np.flatnonzero(apart & ~later)  # evenly to all shards, in small blobs
            shard[i] = -2 - (int(key[0]) + np.arange(len(i)) // 500) % shards
            shard[later] = -1
            starts = np.cumsum(sizes) - sizes
            for s, i in _by(shard):
                if s != -1:
                    part = {"key": key[i], "doc": doc[i], "row": row[i], "first": first[i], "size": sizes[i].astype(np.int32), "body": raw[_ranges(starts[i], sizes[i])]}
                    out.append(_pack(s if s >= 0 else -2 - s, 0 if s >= 0 else 2, **part))
            return _batch(out, _SEEN)

        for batch in batches:
            rows, docs = (batch.column(c).to_numpy(zero_copy_only=False) for c in (0, 1))
            data, offsets = _buffer(batch.column(3))
            cuts = batch.column(2)
            text = np.repeat(np.arange(len(rows)), pc.list_value_length(cuts).to_numpy(zero_copy_only=False))
            cuts = cuts.flatten().to_numpy(zero_copy_only=False)
            for at in range(0, len(cuts), 20_000):
                cut, own = cuts[at : at + 20_000], text[at : at + 20_000]
                first = cut >> 16
                sizes = (cut & 0xFF) + SPAN
                raw = data[_ranges(offsets[own] + first, sizes)]
                place = np.cumsum(sizes) - sizes + (cut >> 8 & 0xFF)
                held.append((Hashes(raw).of(place, place + size) & _KEY, docs[own], rows[own], first.astype(np.int32), sizes, raw))
                count += len(cut)
                if count > CHUNK // 4:
                    yield flush()
                    held, count = [], 0
        if held:
            yield flush()

    def entries(blobs: dict[str, list[bytes]]) -> tuple:
        key, doc, row, first, sizes, raw = (_join(blobs.get(c), k) for c, k in zip(("key", "doc", "row", "first", "size", "body"), (np.uint64, np.int64, np.int64, np.int32, np.int32, np.uint8), strict=True))
        return key, doc, row, first, _binary(raw, sizes)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, known, apart = _parts(batches)
        names = [x.split()[0] for x in _RUNS.split(", ")]
        kinds = (np.int64, np.int32, np.int32)
        told = [_join(known.get(c), k) for c, k in zip(("row", "first", "size"), kinds, strict=True)]
        runs = _union(*(np.concatenate(x) for x in zip(_sorted_runs(*entries(asked)), told, strict=True)))
        for at in range(0, len(runs[0]), 50_000):
            own = [pa.array(x[at : at + 50_000].astype(k)) for x, k in zip(runs, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*own, pa.nulls(len(own[0]), pa.int64()), pa.nulls(len(own[0]), pa.binary())], names=names)
        _, doc, row, first, bodies = entries(apart)
        for at in range(0, len(doc), 50_000):
            own = slice(at, at + 50_000)
            yield pa.RecordBatch.from_arrays([*map(pa.array, (row[own], first[own], first[own], doc[own])), bodies[own].cast(pa.binary())], names=names)

    return around.mapInArrow(send, _SEEN).repartition(shards, "shard").mapInArrow(sort, _RUNS)


def _runs(scratch: Scratch, texts: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """``(row, start, end)`` of repeated bytes of ``row, doc_id, text``, a saved table; with anchors of ``sizes`` bytes, in turn where hot."""
    total = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    limit = max(HOT, total // HOT_SHARE)
    found = scratch.save(_shared_anchors(texts.select("row", "text"), sizes[0], max(12, -(-total // TEXT_BYTES)), limit), "anchors")
    size = found.agg(F.sum(F.col("cut").bitwiseAND(0xFF) + SPAN)).first()[0] or 0
    hot = np.sort(found.where("hot IS NOT NULL").select("hot").toArrow().column(0).to_numpy())
    cuts = found.where("row IS NOT NULL").groupBy("row").agg(F.collect_list("cut").alias("cuts"))
    around = texts.join(cuts.hint("shuffle_hash"), "row").select("row", "doc_id", "cuts", "text")
    seen = scratch.save(_repeated(around, sizes[0], max(12, -(-size // SORT_BYTES)), hot), "runs")
    scratch.drop(found)
    runs = seen.where("body IS NULL").select("row", "start", "end")
    if not len(hot):
        return runs
    inner = seen.where("body IS NOT NULL").select(F.monotonically_increasing_id().alias("piece"), "row", "start", "doc", "body")
    inner = scratch.save(inner, "pieces")
    deeper = _runs(scratch, inner.select(F.col("piece").alias("row"), F.col("doc").alias("doc_id"), F.col("body").alias("text")), sizes[1:])
    found = deeper.select(F.col("row").alias("piece"), F.col("start").alias("a"), F.col("end").alias("b"))
    # both sides grow with the data and compress well, so by the files' sizes either would be taken for one to broadcast
    found = found.join(inner.select("piece", "row", "start").hint("merge"), "piece")
    return union_all([runs, scratch.save(found.select("row", (F.col("start") + F.col("a")).alias("start"), (F.col("start") + F.col("b")).alias("end")), "inner")])


def _cut(texts: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` of ``doc_id, runs, text``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, runs, raw in _texts(batches):
            spans, kept = [], []
            for own, t in zip(runs, raw, strict=True):
                own = np.array([(x["start"], x["end"]) for x in own or ()], np.int64).reshape(-1, 2)
                union = list(zip(*(x.tolist() for x in _union(np.zeros(len(own), np.int64), own[:, 0], own[:, 1])[1:]), strict=True))
                spans.append([{"start": a, "end": b} for a, b in union])
                edges = [0, *(x for ab in union for x in ab), len(t)]
                kept.append(b"".join(t[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(docs, pa.int64()), pa.array([len(t) for t in raw], pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return texts.mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, spans, kept`` for every row: the UTF-8 text without the bytes that a document of smaller id has too.

    A byte goes if a string of SPAN bytes that covers it also starts in a
    document with a smaller id; ``spans`` are the maximal runs that go. Null and
    empty texts are empty; rows without an id lose nothing and take nothing from
    others; rows that share an id take nothing from each other. Only the id
    and text columns are read.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix-dedup", tidy=True)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    long_enough = F.col("doc_id").isNotNull() & (n_bytes >= SPAN)
    marked = rows.where(long_enough).select("doc_id", F.md5("text").alias("mark"), n_bytes.alias("n_bytes"), "text")
    # documents with the same text as a smaller one go whole
    marks = scratch.save(marked.drop("text"), "marks")
    classes = scratch.save(marks.groupBy("mark").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")).where("n > 1"), "classes")
    copies = scratch.save(hot_lookup(marks, classes, "mark", "n").where("doc_id > rep").select("doc_id", "mark", "n_bytes"), "copies")
    scratch.drop(marks, classes)
    rest = marked.drop("n_bytes").join(copies.select("doc_id", "mark").distinct().hint("merge"), ["doc_id", "mark"], "left_anti")
    texts = scratch.save(rest.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text"), "texts")
    by_row = _runs(scratch, texts, SIZES).groupBy("row").agg(F.collect_list(F.struct("start", "end")).alias("runs"))
    cut = _cut(texts.join(by_row.hint("shuffle_hash"), "row", "left").select("doc_id", "runs", "text"))
    whole = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    gone = copies.select("doc_id", "n_bytes", whole.alias("spans"), F.lit(b"").alias("kept"))
    short = rows.where(~long_enough).select("doc_id", n_bytes.alias("n_bytes"), none.alias("spans"), F.col("text").cast("binary").alias("kept"))
    return cut.unionByName(gone).unionByName(short)


def op9_suffix_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and the digest of what stays, for every document."""
    out = remove_repeats(docs)
    lengths: Column = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", lengths.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
