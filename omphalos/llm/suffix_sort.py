"""External suffix sorting by recursive induction, with common-prefix values.

The input is a set of byte strings that each end in a separator. Separators
differ from each other (by place) and are greater than all bytes, so a suffix
is compared within its string only. Suffixes of left-most type are named by
their substrings, sorted by recursion on the names, and all others are induced
through monotone priority queues: queues of one bucket for each byte on the
first level, heaps deeper down. Queues beyond their memory go to disk.
"""

from __future__ import annotations

import heapq
import tempfile
from collections.abc import Iterator

import numpy as np

SEPARATOR, AFTER = 0xFE, b"\xff"  # neither is ever a byte of UTF-8
#: Common prefixes are counted up to this length.
CAP = 50
#: Bytes of queues that stay in memory, items of a heap that do, and items of an array that does.
QUEUE_BYTES, HEAP_ITEMS, ARRAY_ITEMS = 64 << 20, 1 << 20, 1 << 26
#: Names (of all suffixes together) up to which a level of the recursion is sorted in memory.
INTERNAL = 16 << 20


def scratch_array(n: int, dtype) -> np.ndarray:
    """An array in memory, or in an unlinked local file where it is large."""
    if n <= ARRAY_ITEMS:
        return np.empty(n, dtype)
    return np.memmap(tempfile.TemporaryFile(), dtype, "w+", shape=(n,))


class BucketQueue:
    """A monotone priority queue of ``(position, common prefix)`` pairs: first in, first out within each byte.

    Blocks wait in memory up to ``QUEUE_BYTES``; then they go to one file for
    each byte, in front of what comes later.
    """

    def __init__(self):
        self.blocks: list[list[np.ndarray]] = [[] for _ in range(256)]
        self.files: list = [None] * 256
        self.held = 0

    def push(self, byte: int, places: np.ndarray, prefixes: np.ndarray) -> None:
        self.blocks[byte].append(np.stack([places, prefixes]))
        self.held += 16 * len(places)
        if self.held > QUEUE_BYTES:
            for b, blocks in enumerate(self.blocks):
                if blocks:
                    self.files[b] = self.files[b] or tempfile.TemporaryFile()
                    for x in blocks:
                        np.save(self.files[b], x)
                    blocks.clear()
            self.held = 0

    def take(self, byte: int) -> tuple[np.ndarray, np.ndarray] | None:
        """The next places of a bucket (a block of its file, or all that are in memory), or None."""
        if self.files[byte]:
            file = self.files[byte]
            end = file.tell()
            read, self.files[byte] = self._blocks(file, end), None
            self.blocks[byte] = _Chain(read, self.blocks[byte])
        if not self.blocks[byte]:
            return None
        if isinstance(self.blocks[byte], list):  # all that is in memory
            block = np.concatenate(self.blocks[byte], axis=1)
            self.blocks[byte] = []
            self.held -= 8 * block.size
        else:
            block = self.blocks[byte].pop(0)
        return block[0], block[1]

    @staticmethod
    def _blocks(file, end: int) -> Iterator[np.ndarray]:
        file.seek(0)
        while file.tell() < end:
            yield np.load(file)
        file.close()


class _Chain:
    """Blocks of a file and those after them, as a list that reads ahead by one block only."""

    def __init__(self, read: Iterator[np.ndarray], rest: list):
        self.read, self.rest, self.next = read, rest, next(read, None)

    def __bool__(self) -> bool:
        return self.next is not None or bool(self.rest)

    def append(self, block: np.ndarray) -> None:
        self.rest.append(block)

    def clear(self) -> None:  # blocks behind a file that is being read stay in memory
        pass

    def __iter__(self):
        return iter(())

    def pop(self, _: int) -> np.ndarray:
        if self.next is None:
            return self.rest.pop(0)
        block, self.next = self.next, next(self.read, None)
        return block


class SpillHeap:
    """A priority queue of integers; what exceeds HEAP_ITEMS waits in sorted runs on disk."""

    def __init__(self):
        self.heap: list[int] = []
        self.heads: list[tuple[int, int]] = []
        self.runs: list[Iterator[int]] = []

    def push(self, item: int) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > HEAP_ITEMS:
            self.heap.sort()
            file = tempfile.TemporaryFile()
            for at in range(HEAP_ITEMS // 2, len(self.heap), 4096):
                np.save(file, np.array([(x >> 64, x & 0xFFFFFFFFFFFFFFFF) for x in self.heap[at : at + 4096]], np.uint64))
            del self.heap[HEAP_ITEMS // 2 :]
            run = self._read(file, file.tell())
            self.runs.append(run)
            heapq.heappush(self.heads, (next(run), len(self.runs) - 1))

    @staticmethod
    def _read(file, end: int) -> Iterator[int]:
        file.seek(0)
        while file.tell() < end:
            for high, low in np.load(file).tolist():
                yield high << 64 | low

    def __bool__(self) -> bool:
        return bool(self.heap) or bool(self.heads)

    def top(self) -> int:
        return min(self.heap[0], self.heads[0][0]) if self.heap and self.heads else self.heap[0] if self.heap else self.heads[0][0]

    def pop(self) -> int:
        if not self.heads or self.heap and self.heap[0] < self.heads[0][0]:
            return heapq.heappop(self.heap)
        item, run = self.heads[0]
        following = next(self.runs[run], None)
        heapq.heappop(self.heads) if following is None else heapq.heapreplace(self.heads, (following, run))
        return item


_LOW = (1 << 40) - 1


def sort_names(names: list[int], ends: set[int]) -> list[int]:
    """Places of ``names`` in the order of the suffixes that start there.

    Names in ``ends`` occur once and end every comparison; the last name is one.
    """
    n = len(names)
    if len(set(names)) == n:
        return sorted(range(n), key=names.__getitem__)
    stop, at = [0] * n, n - 1  # of each place the end that its suffix is compared up to
    for i in range(n - 1, -1, -1):
        if names[i] in ends:
            at = i
        stop[i] = at + 1
    if sum(stop) - n * (n - 1) // 2 <= INTERNAL:  # what fits in memory is sorted there
        raw = np.array(names, ">u4").tobytes()
        return sorted(range(n), key=lambda i: raw[4 * i : 4 * stop[i]])
    # types: a place is small if its suffix is less than the next one's
    small = bytearray(n)
    for i in range(n - 2, -1, -1):
        small[i] = names[i] < names[i + 1] or (names[i] == names[i + 1] and small[i + 1])
    left = [i for i in range(1, n) if small[i] and not small[i - 1]]
    if left:
        keys = []
        for a, b in zip(left, [*left[1:], n - 1], strict=True):
            # one that is the beginning of another is the greater: at its end the other goes on to something less
            keys.append((*names[a : b + 1], 1 << 62) if stop[a] > b + 1 else tuple(names[a : stop[a]]))
        order = {k: i for i, k in enumerate(sorted(set(keys)))}
        reduced = [order[k] for k in keys]
        over = {x for x, k in zip(reduced, keys, strict=True) if k[-1] in ends}
        left = [left[i] for i in sort_names(reduced, over)]
    # induction of the large ones, from the least on; ends sort by name alone and need no suffix behind them
    heap, large, seq = SpillHeap(), [], 0
    for i in range(n):
        if not small[i] and (names[i] in ends or i == n - 1):
            heap.push(names[i] << 80 | i)
    at = 0
    while heap or at < len(left):
        # in a bucket the large ones come before the small ones
        if at >= len(left) or (heap and heap.top() >> 80 <= names[left[at]]):
            i = heap.pop() & _LOW
            large.append(i)
        else:
            i = left[at]
            at += 1
        if i and not small[i - 1] and names[i - 1] not in ends:
            seq += 1
            heap.push(names[i - 1] << 80 | seq << 40 | i - 1)
    # induction of the small ones, from the greatest on; keys are turned round
    most = max(names)
    heap, out, seq, at = SpillHeap(), [], 0, len(large) - 1
    for i in range(n):
        if small[i] and names[i] in ends:
            heap.push(most - names[i] << 80 | i)
    while heap or at >= 0:
        if at < 0 or (heap and most - (heap.top() >> 80) >= names[large[at]]):
            i = heap.pop() & _LOW
        else:
            i = large[at]
            at -= 1
        out.append(i)
        if i and small[i - 1] and names[i - 1] not in ends:
            seq += 1
            heap.push(most - names[i - 1] << 80 | seq << 40 | i - 1)
    return out[::-1]


def _types(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is less than the next; False for the last."""
    change = np.flatnonzero(t[:-1] != t[1:])
    rises = t[change] < t[change + 1]
    out = np.zeros(len(t), bool)
    out[: change[-1] + 1] = np.repeat(rises, np.diff(change, prepend=-1))
    return out


def common_prefixes(t: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths up to CAP of the common prefixes of the suffixes at ``a`` and ``b``; a separator equals none but itself."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    n = len(t)
    for k in range(CAP):
        x, y = a[live] + k, b[live] + k
        ok = (x < n) & (y < n)
        cx = t[np.minimum(x, n - 1)]
        ok &= (cx == t[np.minimum(y, n - 1)]) & (cx != SEPARATOR)
        live = live[ok]
        if not len(live):
            break
        out[live] = k + 1
    return out


def _sorted_left(t: np.ndarray, small: np.ndarray) -> np.ndarray:
    """Places of the left-most small suffixes (small ones behind a large one) in suffix order."""
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(left) < 2:
        return left
    raw = t.tobytes()
    stops = np.flatnonzero(t == SEPARATOR)
    stop = stops[np.searchsorted(stops, left)]
    following = np.append(left[1:], len(t) - 1)
    keys = [raw[a : b + 1] + AFTER if b < s else (raw[a : s + 1], s) for a, b, s in zip(left.tolist(), following.tolist(), stop.tolist(), strict=True)]
    order = {k: i for i, k in enumerate(sorted(set(keys), key=lambda k: k if isinstance(k, tuple) else (k, 0)))}
    names = [order[k] for k in keys]
    ends = {i for k, i in order.items() if isinstance(k, tuple)}
    return left[np.array(sort_names(names, ends), np.int64)]


class _Induction:
    """One sweep over the buckets that appends the neighbours ``place - 1`` of what it takes out.

    ``lowest[c]`` is the least common prefix met since bucket ``c`` last got a
    place; one more than that is the common prefix of its next place.
    """

    def __init__(self, t: np.ndarray, wanted: np.ndarray):
        self.t, self.wanted, self.queue = t, wanted, BucketQueue()
        self.lowest = np.zeros(256, np.int64)
        self.filled = np.zeros(256, bool)

    def feed(self, places: np.ndarray, prefixes: np.ndarray) -> None:
        """Take out ``places`` in order; ``prefixes[i]`` is what place i shares with the one taken out before."""
        before = places - 1
        go = np.flatnonzero(self.wanted[before] & (places > 0))
        byte = self.t[before[go]]
        order = np.argsort(byte, kind="stable")
        table = [prefixes]  # of minima over 1, 2, 4, ... values
        while 2 << (len(table) - 1) <= len(prefixes):
            half = 1 << (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))

        def least(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            """Minima over [a, b] of ``prefixes``."""
            level = np.frexp(b - a + 1)[1] - 1
            out = np.empty(len(a), np.int64)
            for k in np.unique(level):
                on = level == k
                out[on] = np.minimum(table[k][a[on]], table[k][b[on] - (1 << int(k)) + 1])
            return out

        at = go[order]
        cuts = np.flatnonzero(np.diff(byte[order], prepend=-1)) if len(at) else np.empty(0, np.int64)
        shared = np.empty(len(at), np.int64)
        if len(at) > 1:
            shared[1:] = least(np.minimum(at[:-1] + 1, at[1:]), at[1:])
        if len(cuts):
            first = byte[order][cuts]
            shared[cuts] = np.where(self.filled[first], np.minimum(self.lowest[first], least(np.zeros(len(cuts), np.int64), at[cuts])), -1)
        shared = np.minimum(shared + 1, CAP)
        self.lowest = np.minimum(self.lowest, int(prefixes.min()))
        for k, cut in enumerate(cuts):
            end = cuts[k + 1] if k + 1 < len(cuts) else len(at)
            c, last = int(byte[order][cut]), at[end - 1]
            self.queue.push(c, before[at[cut:end]], shared[cut:end])
            self.filled[c] = True
            self.lowest[c] = int(prefixes[last + 1 :].min()) if last + 1 < len(prefixes) else CAP


def suffix_order(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(places, prefixes)``: all suffixes in order and what each shares (up to CAP) with the one before.

    ``t`` is uint8, of non-empty strings that each end in SEPARATOR.
    """
    n = len(t)
    small = _types(t)
    stops = np.flatnonzero(t == SEPARATOR)
    left = _sorted_left(t, small)
    left_shared = common_prefixes(t, left, np.roll(left, 1)) if len(left) else left
    starts = np.searchsorted(t[left], np.arange(257))
    # large suffixes, from the least bucket on; separators are large and ordered by place
    wanted = ~small
    wanted[stops] = False
    sweep = _Induction(t, wanted)
    large: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(256)]
    for c in range(256):
        last = None
        while (block := sweep.queue.take(c)) is not None:
            places, shared = block
            large[c].append(block)
            sweep.feed(places, shared if last is not None else np.concatenate([[0], shared[1:]]))
            last = places[-1]
        a, b = starts[c], starts[c + 1]
        if a < b:
            shared = left_shared[a:b].copy()
            shared[0] = 0 if last is None else common_prefixes(t, np.array([last]), left[a : a + 1])[0]
            sweep.feed(left[a:b], shared)
    large[SEPARATOR] = [(stops, np.zeros(len(stops), np.int64))]
    # small suffixes, from the greatest bucket on, each bucket from its end
    sweep = _Induction(t, small)
    places, shared, at = scratch_array(n, np.int64), scratch_array(n, np.uint8), n
    for c in range(255, -1, -1):
        last, carried = None, 0
        while (block := sweep.queue.take(c)) is not None:
            p, s = block
            first = 0 if last is None else int(s[0])
            sweep.feed(p, np.concatenate([[first], s[1:]]))
            # what a place shares with the one taken out before it is what that one shares with its left neighbour
            at -= len(p)
            places[at : at + len(p)] = p[::-1]
            if last is not None:
                shared[at + len(p)] = first
            shared[at + 1 : at + len(p)] = s[:0:-1]
            last = p[-1]
        for k in range(len(large[c]) - 1, -1, -1):
            p, s = large[c][k]
            down = np.concatenate([[0], s[:0:-1]])  # between neighbours within the block, going down
            if last is not None:
                down[0] = common_prefixes(t, p[-1:], np.array([last]))[0] if k == len(large[c]) - 1 else carried
            sweep.feed(p[::-1], down)
            at -= len(p)
            places[at : at + len(p)] = p
            if last is not None:
                shared[at + len(p)] = down[0]
            shared[at + 1 : at + len(p)] = s[1:]
            last, carried = p[0], int(s[0])
        if last is not None:
            shared[at] = 0
    return places[at:], shared[at:]
