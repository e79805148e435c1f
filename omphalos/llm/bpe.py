"""Byte-pair encoding by a segment tree over the ranks of adjacent pairs.

The leaves of a pre-token's tree hold rank and place of each adjacent pair of
symbols, the root their minimum: the leftmost merge of lowest rank. A merge
changes three leaves, each followed up to the root, until no pair is mergeable.
Many short pre-tokens are worked on in step, one lane of numpy arrays each;
long ones get a tree of their own.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NONE = np.int64(1) << 62
#: Pre-tokens of more symbols than this get a tree of their own.
LANE = 128
#: Pre-tokens that a worker remembers, and code points that it takes at once.
CACHE, TAKE = 300_000, 4_000_000
#: Bytes, about, of the pre-tokens that an encoding worker remembers, and code points that it takes at once.
CACHE_BYTES, ENCODED = 160 << 20, 4_000_000

_SIMPLE = [chr(c) for c in range(0x300) if c != 0x130]
_OTHER = re.compile("[^\x00-įı-˿]")
_SPACE = "\t\n\v\f\r \x85\xa0"


def _class(kind: str) -> str:
    return "".join(sorted({re.escape(x) for c in _SIMPLE for x in c.lower() if unicodedata.category(x)[0] == kind}))


#: The tokenizer's split of lower-case text, for texts of code points below U+0300.
#: Letters and digits stand before contractions here, as no text can start both.
_PIECES = re.compile(f"[{_class('L')}]+|[{_class('N')}]|'(?:[stmd]|re|ve|ll)|[^{re.escape(_SPACE)}{_class('L')}{_class('N')}]+")


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    rest = iter(range(256, 512))
    return [chr(b) if b in set(plain) else chr(next(rest)) for b in range(256)]


class Bpe:
    """Encoder of a byte-level BPE file with word ends, from the text of its JSON."""

    def __init__(self, spec: str):
        told = json.loads(spec)
        model = told["model"]
        self.spec, self.end = spec, model.get("end_of_word_suffix") or ""
        vocab = model["vocab"]
        self.special = {t["content"]: t["id"] for t in told["added_tokens"]}
        self.tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + self.end] for s in symbols], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.size = max(vocab.values()) + 1
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        # of a pair that is listed twice, the later rank counts, as in the library's table
        self.rank_of = dict(zip(keys.tolist(), range(len(pairs)), strict=True))
        self.keys = np.array(sorted(self.rank_of), np.int64)
        self.ranks = np.array([self.rank_of[k] for k in self.keys.tolist()], np.int64)
        self.made = made
        self.split_special = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.back = {s: b for b, s in enumerate(symbols)}
        self._library = None

    # ------------------------------------------------------------ pre-tokens
    def pieces(self, text: str) -> list[str]:
        """Pre-tokens of a text, normalised; special strings come as themselves (no pre-token has letters and signs)."""
        if self.split_special and self.split_special.search(text):
            out, at = [], 0
            for m in self.split_special.finditer(text):
                out += self._plain(text[at : m.start()])
                out.append(m[0])
                at = m.end()
            return out + self._plain(text[at:])
        return self._plain(text)

    def _plain(self, text: str) -> list[str]:
        if not _OTHER.search(text):
            return _PIECES.findall(text.lower())
        if self._library is None:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.spec)
        norm = self._library.normalizer.normalize_str(text)
        back = self.back
        return [bytes(back[c] for c in p).decode() for p, _ in self._library.pre_tokenizer.pre_tokenize_str(norm)]

    # ---------------------------------------------------------------- merges
    def _pair(self, a: np.ndarray, b: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Leaf values: rank and place, or NONE where the pair isn't mergeable."""
        key = a * self.size + b
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, (self.ranks[i] << 32) | at, NONE)

    def _lanes(self, words: list[bytes], width: int) -> list[list[int]]:
        """Ids of words of 2 to width + 1 bytes; width is a power of two."""
        m = len(words)
        lengths = np.fromiter(map(len, words), np.int64, m)
        flat = np.frombuffer(b"".join(w.ljust(width + 1, b"\0") for w in words), np.uint8).reshape(m, width + 1)
        place = np.arange(width + 1)
        sym = self.inner[flat]
        rows = np.arange(m)
        sym[rows, lengths - 1] = self.last[flat[rows, lengths - 1]]
        sym[place >= lengths[:, None]] = -1
        following = np.where(place + 1 < lengths[:, None], place + 1, -1)
        before = np.broadcast_to(place - 1, sym.shape).copy()
        tree = np.full((m, 2 * width), NONE, np.int64)
        live = sym[:, 1:] >= 0
        tree[:, width:] = np.where(live, self._pair(sym[:, :-1], sym[:, 1:], place[:-1]), NONE)
        for k in range(width - 1, 0, -1):
            np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1], out=tree[:, k])
        while (rows := rows[tree[rows, 1] < NONE]).size:
            top = tree[rows, 1]
            i = top & 0xFFFFFFFF
            j = following[rows, i]
            k = following[rows, j]
            p = before[rows, i]
            sym[rows, i] = self.made[top >> 32]
            sym[rows, j] = -1
            following[rows, i] = k
            has = k >= 0
            before[rows[has], k[has]] = i[has]
            tree[rows, np.minimum(width + j, 2 * width - 1)] = NONE  # j < width unless it is the last symbol, whose leaf is NONE anyway
            tree[rows, width + i] = np.where(has, self._pair(sym[rows, i], sym[rows, np.maximum(k, 0)], i), NONE)
            had = p >= 0
            tree[rows[had], width + p[had]] = self._pair(sym[rows[had], p[had]], sym[rows[had], i[had]], p[had])
            for leaf in (np.minimum(j, width - 1), i, np.maximum(p, 0)):
                node = (width + leaf) >> 1
                while node[0]:
                    tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
                    node = node >> 1
        return [s[s >= 0].tolist() for s in sym]

    def _alone(self, word: bytes) -> list[int]:
        """Ids of one long word: the same tree in plain lists."""
        n = len(word)
        sym = [*self.inner[list(word[:-1])].tolist(), int(self.last[word[-1]])]
        width = 1 << max(1, (n - 2).bit_length())
        none, size, rank_of, made = int(NONE), self.size, self.rank_of, self.made
        leaf = lambda a, b: none if (r := rank_of.get(sym[a] * size + sym[b])) is None else r << 32 | a
        tree = [none] * (2 * width)
        tree[width : width + n - 1] = [leaf(a, a + 1) for a in range(n - 1)]
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        following, before = [*range(1, n), -1], list(range(-1, n - 1))

        def put(at: int, value: int) -> None:
            at += width
            tree[at] = value
            while at > 1:
                at >>= 1
                low = min(tree[2 * at], tree[2 * at + 1])
                if tree[at] == low:
                    return
                tree[at] = low

        while (top := tree[1]) < none:
            i = top & 0xFFFFFFFF
            j = following[i]
            k = following[j]
            sym[i], sym[j], following[i] = int(made[top >> 32]), -1, k
            if j < n - 1:
                put(j, none)
            if k >= 0:
                before[k] = i
                put(i, leaf(i, k))
            else:
                put(i, none)
            if (p := before[i]) >= 0:
                put(p, leaf(p, i))
        return [s for s in sym if s >= 0]

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, list[int]]:
        """Ids of each different pre-token."""
        out, by_width = {}, {}
        for piece in set(pieces):
            word = piece.encode()
            if piece in self.special:
                out[piece] = [self.special[piece]]
            elif len(word) == 1:
                out[piece] = [int(self.last[word[0]])]
            elif len(word) > LANE + 1:
                out[piece] = self._alone(word)
            else:
                by_width.setdefault(max(2, 1 << (len(word) - 2).bit_length()), []).append((piece, word))
        for width, group in by_width.items():
            step = max(256, 1_000_000 // width)
            for at in range(0, len(group), step):
                part = group[at : at + step]
                out.update(zip((p for p, _ in part), self._lanes([w for _, w in part], width), strict=True))
        return out

    def decode(self, ids: Iterable[int]) -> str:
        """Tokens joined by a space: the file names no decoder, and special tokens are not skipped."""
        return " ".join(self.tokens[i] for i in ids)


_MADE: dict[int, Bpe] = {}


def bpe_of(spec: str) -> Bpe:
    """The encoder of a spec, made once in each worker."""
    key = hash(spec)
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = Bpe(spec)
    return _MADE[key]


def read_spec(path: str) -> str:
    """Text of the tokenizer file (of fixed size), which goes to the workers as a broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def takes(lengths: Iterable[int | None], most: int = TAKE) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive rows that have about ``most`` characters together."""
    start, total, at = 0, 0, -1
    for at, n in enumerate(lengths):
        total += n or 0
        if total >= most:
            yield start, at + 1
            start, total = at + 1, 0
    if at + 1 > start:
        yield start, at + 1


#: What ``bpe_encode`` can add, by its type.
OUTPUTS = {"ids": "array<int>", "decoded": "string", "decoded_sha256": "string"}


def bpe_encode(docs: DataFrame, tokenizer_path: str, text: str = "text", want: tuple[str, ...] = ("ids", "decoded"), keep_text: bool = True,
               cache_bytes: int = CACHE_BYTES, take: int = ENCODED) -> DataFrame:
    """``docs`` with those of OUTPUTS that are in ``want``: ids and decoded form of the whole text, or its digest.

    Null and empty texts have no ids and decode to the empty string. No shuffle:
    each Arrow batch is encoded where it is read. What is added replaces columns of
    those names. Without ``keep_text`` the text stays in the worker. A worker remembers
    about ``cache_bytes`` of pre-tokens and takes about ``take`` code points at once;
    both change memory and speed only.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_path))
    plain = docs.drop(*want)
    kept = [c for c in plain.columns if keep_text or c != text]
    schema = plain.select(*kept, *[F.lit(None).cast(OUTPUTS[w]).alias(w) for w in want]).schema
    at, stay = plain.columns.index(text), [plain.columns.index(c) for c in kept]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(spec.value)
        known: dict[str, tuple[list[int], str]] = {}
        held = 0
        ints = list(range(max(bpe.tokens) + 1))

        def decoded(pieces: list[str]) -> str:
            return " ".join([known[p][1] for p in pieces])

        for whole in batches:
            column = whole.column(at)
            for a, b in takes(pa.compute.utf8_length(column).to_pylist(), take):
                split = [bpe.pieces(t) if t else [] for t in column.slice(a, b - a).to_pylist()]
                if held > cache_bytes:
                    known.clear()
                    held = 0
                fresh = set(chain.from_iterable(split)).difference(known)
                for piece, ids in bpe.encode_pieces(fresh).items():
                    known[piece] = ([ints[i] for i in ids], bpe.decode(ids))
                    held += 300 + 2 * len(piece) + 8 * len(ids) + len(known[piece][1])
                made = []
                for w in want:
                    if w == "ids":
                        ids = [np.fromiter(chain.from_iterable([known[p][0] for p in ps]), np.int32) for ps in split]
                        ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                        made.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32))))
                    elif w == "decoded":
                        made.append(pa.array([decoded(ps) for ps in split], pa.string()))
                    else:
                        made.append(pa.array([sha256(decoded(ps).encode()).hexdigest() for ps in split], pa.string()))
                rest = whole.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*[rest.column(i) for i in stay], *made], names=schema.names)

    return plain.mapInArrow(encode, schema)


def op10_bpe_encode(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``doc_id``, ``n_tokens`` and digests of the ids and of the decoded text of every document."""
    out = bpe_encode(docs.select("doc_id", "text"), tokenizer_path, want=("ids", "decoded_sha256"), keep_text=False)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        "decoded_sha256",
    )
