"""Quality rules: a threshold table compiled into one projection, SQL functions only."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omphalos.llm.common import BLANK, let

#: Words of a repeated window.
WINDOW = 5
SYMBOLS = "#*$%&|<>"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the and of to in a is that for it was on are as with this from by at or "
    "der die das und in den von zu mit ist nicht ein eine auf für als sich des "
    "le la les de des et un une en que qui dans est pour pas sur au par "
    "el los las del y que una por con para se no su es"
)


class Rule(NamedTuple):
    """``feature`` must lie in [low, high] once the text has ``from_words`` words."""

    name: str
    feature: str
    low: float
    high: float
    from_words: int


#: The production table; a caller may pass another of the same form.
RULES = (
    Rule("word_length", "mean_word_length", 2.0, 14.0, 10),
    Rule("symbols", "symbol_ratio", 0.0, 0.1, 10),
    Rule("repeated_lines", "dup_line_ratio", 0.0, 0.5, 10),
    Rule("stop_words", "stop_word_ratio", 0.02, 1.0, 100),
)


def _repeat_words(words: Column) -> Column:
    """Number of words inside WINDOW-word windows that the text has at least twice.

    Window hashes that are all different prove that nothing repeats. Else the
    windows are sorted by hash, those equal to a neighbour (compared word by
    word) are repeats, and the union of their word positions is counted.
    """
    window = lambda i: F.slice(words, i + 1, WINDOW)

    def exact(hashes: Column) -> Column:
        def covered(s: Column) -> Column:
            def same(x: Column, y: Column) -> Column:
                return F.coalesce((x["h"] == y["h"]) & (window(x["i"]) == window(y["i"])), F.lit(False))

            twice = F.filter(s, lambda x, k: same(F.get(s, k + 1), x) | same(F.get(s, k - 1), x))
            places = F.sort_array(F.transform(twice, lambda x: x["i"]))
            start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("n"))
            step = lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(F.lit(WINDOW), p - acc["last"])).alias("n"))
            return F.aggregate(places, start, step, lambda acc: acc["n"])

        keyed = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return let(F.sort_array(keyed), covered)

    def judged(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(exact(hashes))

    starts = F.sequence(F.lit(0), F.size(words) - WINDOW)
    found = let(F.transform(starts, lambda i: F.xxhash64(window(i))), judged)
    return F.when(F.size(words) < WINDOW, F.lit(0).cast("long")).otherwise(found)


def quality_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """The columns of ``docs`` and ``quality``, a struct of counts and ratios of the whole text.

    Null and empty texts have no words, and every count and ratio is 0. Ratios
    are over words or over lines that have a word.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    first = docs.select(
        *[docs[c] for c in docs.columns],
        F.struct(
            F.array_remove(F.split(body, BLANK), "").alias("words"),
            F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"),
            F.length(F.regexp_replace(body, f"[^{SYMBOLS}]+", "")).cast("long").alias("n_symbols"),
        ).alias("__q"),
    )
    stop = sorted(set(STOP_WORDS.split()))

    def counts(q: Column) -> Column:
        words, lines = q["words"], q["lines"]
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            q["n_symbols"].alias("n_symbols"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            let(words, _repeat_words).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(stop))).cast("long").alias("n_stop_words"),
        )

    second = first.select(*[first[c] for c in docs.columns], let(F.col("__q"), counts).alias("quality"))
    q = F.col("quality")
    ratio = lambda n, d: F.coalesce(q[n] / F.nullif(q[d], F.lit(0).cast("long")), F.lit(0.0))
    return second.withColumn(
        "quality",
        q.withField("mean_word_length", ratio("word_chars", "n_words"))
        .withField("symbol_ratio", ratio("n_symbols", "n_words"))
        .withField("dup_line_ratio", ratio("n_dup_lines", "n_lines"))
        .withField("stop_word_ratio", ratio("n_stop_words", "n_words")),
    )


def quality_verdict(rules: tuple[Rule, ...] = RULES, quality: str = "quality") -> Column:
    """Array of the names of the rules that the text breaks, in the table's order."""
    q = F.col(quality)
    broken = [F.when((q["n_words"] >= r.from_words) & ~q[r.feature].between(r.low, r.high), F.lit(r.name)) for r in rules]
    return F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")


def quality_filter(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with ``quality`` (counts and ratios) and ``broken`` (names of broken rules).

    A column of ``docs`` named ``quality`` or ``broken`` gives way to the new one.
    """
    plain = docs.drop("quality", "broken")
    return quality_features(plain, text).withColumn("broken", quality_verdict(rules))


def op1_quality_rules(docs: DataFrame) -> DataFrame:
    """One row for each document: the base counts, ``base_failed``, ``kept`` and ``broken``.

    Null or empty text: all counts 0, base_failed true, kept false.
    """
    q = F.col("quality")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    out = quality_filter(docs.select("doc_id", "text")).select("doc_id", *[q[n].alias(n) for n in names], "broken")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return out.withColumn("base_failed", failed).select(
        "doc_id", *names, "base_failed", (~F.col("base_failed") & (F.size("broken") == 0)).alias("kept"), F.array_join("broken", ",").alias("broken")
    )
