"""A corpus pipeline over ``documents``: language, near-duplicates, benchmark leaks, personal data, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the one
before kept. All but the last return the columns of ``docs``. A stage handles
nulls in any column, empty texts, repeated rows and an empty table; what
becomes of them is said at each.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from omphalos.llm import bpe, decontam, language, near_dup, pii
from omphalos.llm.common import Scratch, table

#: A document stays where its language has at least this pooled probability.
LANGUAGE_SCORE = 0.5
#: Shingle words and similarity (percent) of near-duplicates.
SHINGLE, SIMILAR = 5, 80
#: Bytes of pre-tokens that an encoding worker remembers here, where it shares the executor with what the
#: stages before have left in memory, and code points that it takes at once.
ENCODER_BYTES, ENCODER_TAKE = 24 << 20, 1_000_000
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: The sequence cannot be said in SQL (trained models, a tokenizer); tests hold it against a plain version.
ORACLE_SQL = None


def _aside(docs: DataFrame, *made: str) -> dict[str, str]:
    """Free names for the columns of ``docs`` that a stage's own would replace."""
    names = {}
    for c in made:
        names[c] = f"__{c}"
        while names[c] in docs.columns:
            names[c] = f"_{names[c]}"
    return names


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null, empty or without letters, or below LANGUAGE_SCORE.

    Where no document is labelled there is nothing to learn from, and all with
    letters stay.
    """
    train = docs.where(~language.held_out("doc_id"))
    net = language.train(language.training_pieces(train, "doc_id", "text", "lang"))
    if net is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    verdict = language.language_verdict(docs, net)
    return docs.where((verdict["lang_pred"] != language.UNKNOWN) & (verdict["score"] >= LANGUAGE_SCORE))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of least id of each group of near-duplicates, once.

    Texts without words are no one's duplicate, and rows without an id all
    stay; of rows that share an id the one of least text (then by the other columns) stays.
    """
    judged = near_dup.near_duplicates(docs, words=SHINGLE, percent=SIMILAR)
    named = Scratch(spark, "pipeline").save(judged.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("kept").alias("kept"), F.count("*").alias("n")), "kept")
    stay = named.where("kept")
    again = stay.where("n > 1").select("doc_id")
    once = docs.join(stay.where("n = 1").select("doc_id"), "doc_id", "left_semi")
    least = F.min(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")]))
    rest = docs.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(least.alias("least")).select("doc_id", "least.*").select(*docs.columns)
    return once.unionByName(rest).unionByName(docs.where("doc_id IS NULL")).select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of benchmark words; null and empty texts stay."""
    names = _aside(docs, "n_words", "hits", "items")
    found = decontam.find_benchmark(docs.withColumnsRenamed(names), table(spark, sf_dir, "benchmark"))
    kept = found.where(F.size("hits") == 0).drop(*names)
    return kept.withColumnsRenamed({v: k for k, v in names.items()}).select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Redacts personal data in every text and renews ``n_chars``; null and empty texts stay as they are."""
    names = _aside(docs, "base", "added")
    found = pii.find_pii(docs.withColumnsRenamed(names), pii.train_model(docs))
    text = F.when(F.col("text").isNotNull(), pii.redact(F.col("text"), F.concat("base", "added")))
    out = found.withColumn("text", text).drop(*names)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(docs.schema["n_chars"].dataType), F.col("n_chars")))
    return out.withColumnsRenamed({v: k for k, v in names.items()}).select(*docs.columns)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number and a digest of what they decode to; null and empty texts have none."""
    out = bpe.bpe_encode(docs.select("doc_id", "lang", "source", "text"), TOKENIZER, want=("ids", "decoded_sha256"), keep_text=False, cache_bytes=ENCODER_BYTES, take=ENCODER_TAKE)
    return out.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("language", language_stage),
    ("near_dup", near_dup_stage),
    ("decontamination", decontamination_stage),
    ("pii", pii_stage),
    ("bpe", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written as Parquet and read again."""
    scratch = Scratch(spark, "pipeline-run")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.save(stage(spark, docs, sf_dir), name)
    return docs
