"""Secret scans: sliding-window entropy over candidate strings, beside fixed patterns."""

from __future__ import annotations

import re
from collections.abc import Iterator
from math import log2
from typing import NamedTuple

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omphalos.llm.bpe import takes

#: The fixed patterns; letters of ``assign`` in either (ASCII) case.
ASSIGN = re.compile(r"(?ai)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX_RUN = re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}")
KINDS = ("assign", "access", "hex", "entropy")

#: Candidate strings of the entropy scan.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")


class CharClass(NamedTuple):
    """A window of ``width`` characters, all in ``chars``, is random from ``bits`` of entropy on."""

    name: str
    chars: frozenset
    width: int
    bits: float


#: From the narrowest class to the widest; a candidate is scanned as the first that holds all of it.
CLASSES = (
    CharClass("hex", frozenset("0123456789abcdefABCDEF"), 20, 3.0),
    CharClass("lower", frozenset("abcdefghijklmnopqrstuvwxyz"), 24, 4.15),
    CharClass("upper", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), 24, 4.15),
    CharClass("base64", frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"), 20, 3.9),
)

#: What looks like a word or a name: letters in one case or capitalised, fewer than any window holds, and humps of three or more.
#: A part fits in one way only, so a candidate of many parts is decided in one pass.
_WORD = r"(?:[A-Z]?[a-z]{1,18}(?:[A-Z][a-z]{2,13})*|[A-Z]{1,19})"

#: Strings (either case) that are known not to be secrets: whole candidates, or what lies between marks.
ALLOWED = (
    rf"(?-i:{_WORD}(?:[-_/=]{_WORD})*)",  # words joined by signs
    r"[0-9]+",  # plain numbers
    r"[-_=+/]+",  # rules of signs
    r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}",  # identifiers of records
)
#: Words (either case) that mark made-up values: no window that meets one is counted.
MARKS = r"example|sample|dummy|placeholder|xxxx"


def entropy_runs(s: str, width: int, bits: float) -> list[tuple[int, int]]:
    """Maximal unions of the ``width``-windows of ``s`` whose Shannon entropy is ``bits`` or more.

    The window slides by one character; the sum of n*log2(n) over its counts is
    changed by the one that leaves and the one that enters.
    """
    if len(s) < width:
        return []
    weight = [0.0, *(n * log2(n) for n in range(1, width + 1))]
    counts: dict[str, int] = {}
    total = 0.0
    for c in s[:width]:
        n = counts.get(c, 0)
        total += weight[n + 1] - weight[n]
        counts[c] = n + 1
    most = width * (log2(width) - bits) + 1e-9  # entropy >= bits, in terms of the sum
    runs: list[tuple[int, int]] = []
    for at in range(len(s) - width + 1):
        if at:
            old, new = s[at - 1], s[at + width - 1]
            if old != new:
                n = counts[old]
                total += weight[n - 1] - weight[n]
                counts[old] = n - 1
                n = counts.get(new, 0)
                total += weight[n + 1] - weight[n]
                counts[new] = n + 1
        if total <= most:
            if runs and at <= runs[-1][1]:
                runs[-1] = (runs[-1][0], at + width)
            else:
                runs.append((at, at + width))
    return runs


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Fixed-pattern spans in code points: leftmost and non-overlapping by kind, failing matches dropped."""
    low = text.lower()
    out = []
    if any(word in low for word in ("passw", "secret", "token", "api")):  # a quick look before the pattern
        out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return out + [("hex", m.start(), m.end()) for m in HEX_RUN.finditer(text)]


def _between(pattern: re.Pattern | None, s: str) -> Iterator[tuple[int, str]]:
    """What lies before, between and after the matches, with its place."""
    at = 0
    for m in pattern.finditer(s) if pattern else ():
        yield at, s[at : m.start()]
        at = m.end()
    yield at, s[at:]


def entropy_spans(text: str, classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED, marks: str = MARKS) -> list[tuple[str, int, int]]:
    """Spans that the entropy scan adds; allow-listed candidates give none, nor do windows that meet a mark."""
    allow = re.compile("|".join(f"(?:{a})" for a in allowed), re.I) if allowed else None
    mark = re.compile(marks, re.I) if marks else None
    out = []
    for m in CANDIDATE.finditer(text):
        for at, s in _between(mark, m[0]):
            if not s or allow and allow.fullmatch(s):
                continue
            chars = set(s)
            kind = next((c for c in classes if c.chars >= chars), None)
            if kind:
                out += [("entropy", m.start() + at + a, m.start() + at + b) for a, b in entropy_runs(s, kind.width, kind.bits)]
    return out


def written(spans: list[tuple[str, int, int]]) -> str:
    """``kind:start:end`` by start, then kind as listed, comma-joined."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def secret_spans(docs: DataFrame, text: str = "text", classes: tuple[CharClass, ...] = CLASSES, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """``docs`` with ``base`` and ``added``: spans as ``kind:start:end`` strings of the whole text.

    Offsets are code points, the end exclusive. Null and empty texts have no
    spans. Row by row in the task that reads it; columns of those names are replaced.
    """
    plain = docs.drop("base", "added")
    schema = plain.select("*", F.lit("").alias("base"), F.lit("").alias("added")).schema
    at = plain.columns.index(text)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            column = whole.column(at)
            for a, b in takes(pc.utf8_length(column).to_pylist()):
                texts = column.slice(a, b - a).to_pylist()
                base = pa.array([written(base_spans(t)) if t else "" for t in texts], pa.string())
                added = pa.array([written(entropy_spans(t, classes, allowed)) if t else "" for t in texts], pa.string())
                yield pa.RecordBatch.from_arrays([*whole.slice(a, b - a).columns, base, added], names=schema.names)

    return plain.mapInArrow(scan, schema)


def op3_secret_scans(docs: DataFrame) -> DataFrame:
    """Counts of the base spans, their digest and all spans, for every document."""
    found = secret_spans(docs.select("doc_id", "text"))
    each = F.filter(F.split(F.concat_ws(",", "base", "added"), ","), lambda s: s != "")
    order = F.create_map(*[F.lit(x) for k, n in zip(KINDS, range(len(KINDS)), strict=True) for x in (k, n)])
    part = lambda s, i: F.get(F.split(s, ":"), F.lit(i))
    keyed = F.transform(each, lambda s: F.struct(part(s, 1).cast("int").alias("a"), F.element_at(order, part(s, 0)).alias("k"), s.alias("s")))
    spans = F.array_join(F.transform(F.sort_array(keyed), lambda x: x["s"]), ",")
    counts = [F.regexp_count("base", F.lit(k + ":")).cast("long").alias(f"n_{k}") for k in KINDS[:3]]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), spans.alias("spans"))
