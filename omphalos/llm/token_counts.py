"""Token counts: a broadcast table of frequent pre-token lengths, worker caches for the rest."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from omphalos.llm.bpe import CACHE, bpe_of, read_spec, takes

#: Rows of the broadcast table, bytes of its longest key, and rows of one task's summary.
TABLE, KEY_BYTES, SUMMARY = 16_384, 48, 1_024


def _summaries(texts: DataFrame, spec) -> DataFrame:
    """``(piece, n)``: at most SUMMARY heaviest pre-tokens of each task, by a Misra-Gries count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, seen = bpe_of(spec.value), Counter()
        for whole in batches:
            column = whole.column(0)
            for a, b in takes(pc.utf8_length(column).to_pylist()):
                for t in column.slice(a, b - a).to_pylist():
                    if t:
                        seen.update(bpe.pieces(t))
                if len(seen) > 64 * SUMMARY:  # the counts of those that go are taken from those that stay
                    cut = seen.most_common(16 * SUMMARY + 1)[-1][1]
                    seen = Counter({p: n - cut for p, n in seen.items() if n > cut})
        top = [(p, n) for p, n in seen.most_common(SUMMARY) if len(p.encode()) <= KEY_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n"])

    return texts.mapInArrow(count, "piece string, n long")


def frequent_lengths(docs: DataFrame, tokenizer_path: str, text: str = "text", rows: int = TABLE) -> bytes:
    """The ``rows`` most frequent pre-tokens of all documents with their token counts, packed.

    Texts are summarised where they are read; what is shuffled are the tasks'
    bounded summaries, never the pre-tokens. The result holds one line
    ``pre-token NUL count`` each: at most ``rows * (KEY_BYTES + 8)`` bytes.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))
    heavy = _summaries(docs.select(text), spec).groupBy("piece").agg(F.sum("n").alias("n"))
    top = [r.piece for r in heavy.orderBy(F.desc("n"), "piece").limit(rows).collect()]
    ids = bpe_of(spec.value).encode_pieces(top)
    return "\n".join(f"{p}\0{len(ids[p])}" for p in top).encode()


def count_tokens(docs: DataFrame, tokenizer_path: str, text: str = "text", table: bytes | None = None) -> DataFrame:
    """``docs`` with ``n_tokens`` (long), the tokens of each whole text.

    Null and empty texts count 0. ``table`` is what ``frequent_lengths`` gives;
    it is made from ``docs`` where it isn't given, and decides speed only. A
    column named ``n_tokens`` is replaced.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer_path))
    lengths = spark.sparkContext.broadcast(frequent_lengths(docs, tokenizer_path, text) if table is None else table)
    plain = docs.drop("n_tokens")
    schema = plain.select("*", F.lit(0).cast("long").alias("n_tokens")).schema
    at = plain.columns.index(text)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(spec.value)
        frequent = {p: int(n) for p, n in (x.split("\0") for x in lengths.value.decode().split("\n") if x)}
        known = dict(frequent)
        for whole in batches:
            column = whole.column(at)
            for a, b in takes(pc.utf8_length(column).to_pylist()):
                split = [bpe.pieces(t) if t else [] for t in column.slice(a, b - a).to_pylist()]
                if len(known) > CACHE:
                    known = dict(frequent)
                misses = set(chain.from_iterable(split)).difference(known)
                known.update((p, len(ids)) for p, ids in bpe.encode_pieces(misses).items())
                n = pa.array([sum(map(known.__getitem__, ps)) for ps in split], pa.int64())
                yield pa.RecordBatch.from_arrays([*whole.slice(a, b - a).columns, n], names=schema.names)

    return plain.mapInArrow(count, schema)


def op2_token_counts(docs: DataFrame, tokenizer_path: str, most: int = 2048) -> DataFrame:
    """``doc_id``, ``n_bytes`` (UTF-8), ``n_tokens`` and ``over_limit`` of every document; null is empty."""
    out = count_tokens(docs.select("doc_id", "text"), tokenizer_path)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes")
    return out.select("doc_id", n_bytes, "n_tokens", (F.col("n_tokens") > most).alias("over_limit"))
