"""Source divergence audit: how the term use of the sources of a language differs.

Documents are counted with Arrow compute functions inside ``mapInArrow``: A-Z
lower-cased, split at what can't be in a term, dictionary-encoded and grouped by
hash, so a task hands on partial counts. Merged counts are dealt into columnar
shards by term; each shard adds up the differences of its terms for pairs of
blocks of sources, and the sums of the shards are the divergences.

All arithmetic is exact: shares are whole billionths, counts beyond 64 bits
go through decimals.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from omphalos.llm.common import Scratch, hot_lookup

#: What separates terms (RE2): ASCII other than letters.
BREAK = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
#: Documents of a language that a kept term is in, at least; the count added to each; the unit of shares; listed terms of a group.
LEAST_DOCS, PRIOR, UNIT, LISTED = 30, 5, 1_000_000_000, 50
#: Bytes of text counted at once, distinct (group, term) rows a task holds, terms of a dense piece.
BITE, HELD, PIECE = 4 << 20, 200_000, 1024
#: Sources of a block and rows of a shard, about.
SOURCES, SHARD_ROWS = 256, 100_000

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


def term_lists(text: pa.Array) -> pa.ListArray:
    """The terms of each text, and empty strings where a text starts or ends with a break."""
    own = pa.concat_arrays([text.slice(0, 0), text]) if text.offset else text  # a slice's lower case keeps no offset
    return pc.split_pattern_regex(pc.ascii_lower(own), BREAK)


def _merged(parts: list[pa.Table]) -> pa.Table:
    if not parts:
        return _COUNTS.empty_table()
    made = pa.concat_tables(parts).group_by(["lang", "source", "term"], use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return pa.table([made.column(c) for c in ("lang", "source", "term", "n_sum", "docs_sum")], schema=_COUNTS)


def count_terms(lang: pa.Array, source: pa.Array, text: pa.Array) -> pa.Table:
    """``(lang, source, term, n, docs)`` of some documents; the empty term stands for the group itself."""
    lists = term_lists(text)
    row, term = pc.list_parent_indices(lists), pc.list_flatten(lists)
    filled = pc.greater(pc.binary_length(term), 0)
    row, term = row.filter(filled), term.filter(filled).dictionary_encode()
    own = pa.table({"lang": lang, "source": source}).group_by(["lang", "source"], use_threads=False).aggregate([])
    own = own.append_column("group", pa.array(np.arange(own.num_rows), pa.int64()))
    code = {(a, b): g for a, b, g in zip(own["lang"].to_pylist(), own["source"].to_pylist(), own["group"].to_pylist())}
    of_row = np.array([code[k] for k in zip(lang.to_pylist(), source.to_pylist())], dtype=np.int64)
    once = pa.table({"row": row, "term": term.indices}).group_by(["row", "term"], use_threads=False).aggregate([([], "count_all")])
    in_group = pa.array(of_row[once["row"].to_numpy()] if once.num_rows else np.zeros(0, np.int64))
    whole = pa.table({"group": in_group, "term": once["term"], "n": once["count_all"]}).group_by(["group", "term"], use_threads=False).aggregate([("n", "sum"), ("n", "count")])
    g = whole["group"].combine_chunks()
    words = term.dictionary.take(whole["term"].combine_chunks()).cast(pa.string())
    lang_of, source_of = own["lang"].combine_chunks(), own["source"].combine_chunks()
    zero = pa.array(np.zeros(own.num_rows, np.int64))
    found = pa.table([lang_of.take(g), source_of.take(g), words, whole["n_sum"], whole["n_count"]], schema=_COUNTS)
    return pa.concat_tables([found, pa.table([lang_of, source_of, pa.array([""] * own.num_rows, pa.string()), zero, zero], schema=_COUNTS)])


def _count(batches):
    held: list[pa.Table] = []
    for batch in batches:
        lang, source, text = (batch.column(c).fill_null("") for c in ("lang", "source", "text"))
        ends = np.cumsum(pc.binary_length(text).to_numpy(zero_copy_only=False), dtype=np.int64)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + BITE, "right")))
            held.append(count_terms(*(x.slice(start, stop - start) for x in (lang, source, text))))
            start = stop
            if sum(t.num_rows for t in held) > HELD:
                held = [_merged(held)]
                if held[0].num_rows > HELD // 2:
                    yield from held.pop().to_batches(max_chunksize=10_000)
    yield from _merged(held).to_batches(max_chunksize=10_000)


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + PRIOR) / (total + PRIOR * terms)), exact for any 64-bit counts; null without terms."""
    wide = "decimal(38,0)"
    above = F.lit(UNIT).cast("decimal(10,0)") * (n.cast("decimal(19,0)") + PRIOR)
    below = total.cast("decimal(19,0)") + terms.cast("decimal(19,0)") * PRIOR
    return F.call_function("div", above.cast(wide), F.nullif(below.cast(wide), F.lit(0).cast(wide))) + F.lit(1).cast("long")


def _differences(rows: pa.Table) -> pa.Table:
    """The summed differences of a source of block a and one of block b, both ways, over the terms of a shard.

    Added up are abs(p - q) less abs(base of p - base of q), so that a term that
    neither has needs no row; the first shard adds the latter for all kept terms.
    """
    lang, shard, a, b = (rows[c][0].as_py() for c in ("lang", "shard", "a", "b"))
    is_head = pc.is_null(rows["term"])
    heads, cells = rows.filter(is_head), rows.filter(pc.invert(is_head))
    names, side = heads["source"].to_pylist(), heads["side"].to_numpy()
    base, kept = heads["base"].to_numpy(), heads["kept"][0].as_py()
    words = cells["term"].combine_chunks().dictionary_encode()
    by_term = np.argsort(words.indices.to_numpy(), kind="stable")
    term, p = words.indices.to_numpy()[by_term], cells["p"].to_numpy()[by_term]
    at = {s: k for k, s in enumerate(names)}
    who = np.array([at[s] for s in cells["source"].to_pylist()], dtype=np.int64)[by_term]
    left, right = np.flatnonzero(side == a), np.flatnonzero(side == b)
    apart = np.abs(base[left][:, None] - base[right][None, :])
    total = apart * (kept if shard == 0 else 0)
    for low in range(0, len(words.dictionary), PIECE):
        width = min(PIECE, len(words.dictionary) - low)
        i, j = np.searchsorted(term, [low, low + width])
        dense = np.repeat(base[:, None], width, axis=1)
        dense[who[i:j], term[i:j] - low] = p[i:j]
        other = dense[right]
        for k, s in enumerate(left):
            total[k] += np.abs(other - dense[s]).sum(axis=1) - width * apart[k]
    source, item, value = [], [], []
    for k, s in enumerate(left):
        for m, t in enumerate(right):
            if s != t:
                source.append(names[s])
                item.append(names[t])
                value.append(int(total[k, m]))
    if a != b:
        source, item, value = source + item, item + source, value * 2
    return pa.table({"lang": pa.array([lang] * len(value), pa.string()), "source": pa.array(source, pa.string()), "item": pa.array(item, pa.string()), "value": pa.array(value, pa.int64())})


class Audit:
    """Term statistics of a corpus ``docs(lang, source, text)``; a null counts as empty, a repeated row as another document.

    ``groups`` holds (lang, source, total, own, ...) with the count and the number of a
    group's kept terms and those of its language; ``shares`` holds (lang, source, term,
    p, q, ...) for the kept terms that a group has. A term is kept in a language that
    has it in ``least_docs`` documents.
    """

    def __init__(self, docs: DataFrame, least_docs: int = LEAST_DOCS):
        scratch = Scratch(docs.sparkSession, "divergence")
        rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
        parts = rows.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
        merged = scratch.save(parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
        word = Window.partitionBy("lang", "term")
        known = merged.where("term <> ''").withColumns({"in_docs": F.sum("docs").over(word), "n_lang": F.sum("n").over(word), "nth": F.row_number().over(word.orderBy("source"))})
        terms = scratch.save(known.where(F.col("in_docs") >= least_docs).drop("docs", "in_docs"), "terms")
        own = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count("*").alias("own"), F.sum((F.col("nth") == 1).cast("long")).alias("new"))
        groups = merged.where("term = ''").select("lang", "source").join(own.hint("merge"), ["lang", "source"], "left").na.fill(0, ["total", "own", "new"])
        groups = scratch.save(groups, "groups")
        langs = groups.groupBy("lang").agg(F.sum("total").alias("lang_total"), F.sum("new").alias("kept"), F.sum("own").alias("lang_rows"), F.count("*").alias("sources"))
        langs = scratch.save(langs.withColumn("weight", F.col("sources")), "langs")
        self.groups = scratch.save(hot_lookup(groups.drop("new"), langs, "lang", "weight"), "sized")
        shares = hot_lookup(terms.drop("nth"), self.groups.withColumn("weight", F.col("own")), ["lang", "source"], "weight")
        shares = shares.withColumns({"p": share(F.col("n"), F.col("total"), F.col("kept")), "q": share(F.col("n_lang"), F.col("lang_total"), F.col("kept"))})
        self.shares = scratch.save(shares.select("lang", "source", "term", "p", "q", "lang_rows", "sources"), "shares")

    def distinctive(self, most: int = LISTED) -> DataFrame:
        """``(lang, source, item, value, rank)``: the ``most`` terms that a group uses most beyond its language."""
        over = self.shares.where("p > q").select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        first = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
        return over.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= most)

    def between(self) -> DataFrame:
        """``(lang, source, item, value, rank)``: how far a group is from each other source of its language, over all kept terms."""
        blocks = F.ceil(F.col("sources") / SOURCES)
        shards = F.ceil((F.col("lang_rows") + 1) / (blocks * SHARD_ROWS))
        own = F.pmod(F.xxhash64("source"), blocks).cast("int")
        pairs = F.transform(F.sequence(F.lit(0), blocks.cast("int") - 1), lambda k: F.struct(F.least(k, F.col("side")).alias("a"), F.greatest(k, F.col("side")).alias("b")))

        def dealt(df: DataFrame) -> DataFrame:
            return df.withColumn("side", own).withColumn("pair", F.explode(pairs)).select("*", "pair.a", "pair.b")

        none = F.lit(None)
        cells = dealt(self.shares).withColumn("shard", F.pmod(F.xxhash64(F.lit(1), "term"), shards).cast("long"))
        cells = cells.select("lang", "shard", "a", "b", "source", "term", "p", "side", none.cast("long").alias("base"), none.cast("long").alias("kept"))
        heads = dealt(self.groups).withColumns({"shard": F.explode(F.sequence(F.lit(0).cast("long"), shards - 1)), "base": F.coalesce(share(F.lit(0).cast("long"), F.col("total"), F.col("kept")), F.lit(0).cast("long"))})
        heads = heads.select("lang", "shard", "a", "b", "source", none.cast("string").alias("term"), none.cast("long").alias("p"), "side", "base", "kept")
        parts = cells.unionByName(heads).groupBy("lang", "shard", "a", "b").applyInArrow(_differences, "lang string, source string, item string, value long")
        sums = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        return sums.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")))


def op11_source_divergence(docs: DataFrame) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of ``documents``: divergences between sources, and the terms of each group.

    Null texts, languages and sources are empty ones, repeated rows are documents
    of their own, a language without kept terms has differences of 0, one with a
    single source none, an empty table gives no rows, and other columns are left out.
    """
    audit = Audit(docs)
    parts = [audit.between().withColumn("part", F.lit("pair")), audit.distinctive().withColumn("part", F.lit("term"))]
    return parts[0].unionByName(parts[1]).select("lang", "source", "part", "item", "value", "rank")
