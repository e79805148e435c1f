"""The pipeline's stages against plain versions, and the registered queries."""

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C

from .helpers import AWKWARD, SF, counted, near_groups, sha
from .test_text_ops import plain_decontamination, plain_pii


@pytest.fixture(scope="module")
def steps(spark):
    """Input and output rows of every stage over the smallest tables."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in C.STAGES:
        made = stage(spark, docs, SF)
        if name != "bpe":
            assert made.columns == docs.columns
        out.append(made.collect())
        docs = spark.createDataFrame(out[-1], made.schema)
    return out


def test_language_keeps_clean_documents(steps):
    kept = {r.doc_id for r in steps[1]}
    assert kept == {r.doc_id for r in steps[0] if r.text and re.search(r"[^\W\d_]", r.text)}


def test_near_dup_keeps_the_least(steps):
    groups = near_groups([(r.doc_id, r.text) for r in steps[1]], 5)
    assert {r.doc_id for r in steps[2]} == {top for _, top in groups.values()}


def test_decontamination_drops_what_leaks(steps, spark):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    judged = plain_decontamination([(r.doc_id, r.text) for r in steps[2]], items)
    assert {r.doc_id for r in steps[3]} == {r[0] for r in judged if not r[5]}
    assert len(steps[3]) < len(steps[2])


def test_pii_is_redacted(steps):
    before = {r.doc_id: r for r in steps[3]}
    assert {r.doc_id for r in steps[4]} == set(before)
    for r in steps[4]:
        if not plain_pii(before[r.doc_id].text) and not re.search("[0-9]", before[r.doc_id].text):
            assert r == before[r.doc_id]
        assert not plain_pii(r.text)
        assert r.n_chars == len(r.text)


def test_bpe_ids_and_decoding(steps):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    by = {r.doc_id: r for r in steps[5]}
    for r in steps[4]:
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert (by[r.doc_id].ids, by[r.doc_id].n_tokens) == (ids, len(ids))
        assert by[r.doc_id].decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))


def test_stages_take_awkward_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, hits string, base string"
    rows = [(i, t, None if i == 5 else "aa", None, None, "s", "h", "b") for i, t in AWKWARD]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in C.STAGES:
        made, none = stage(spark, docs, SF), stage(spark, docs.limit(0), SF)
        assert none.collect() == []
        got = made.collect()
        if name == "near_dup":
            ids = [r.doc_id for r in got]
            assert ids.count(13) == 1 and ids.count(None) == 1 and not {6, 7, 15} & set(ids) and {1, 2, 3, 5, 14} <= set(ids)
        elif name == "language":
            assert not {1, 2, 3, 11} & {r.doc_id for r in got}
        elif name != "decontamination":
            assert len(got) == len(rows)


def test_queries_are_registered():
    names = E.queries()
    assert [n for n in range(1, 11) if not any(re.match(rf"op{n}_", x) for x in names)] == []
    assert names["pipeline"] is C.run


def test_run_equals_its_stages(spark, steps):
    assert counted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in C.run(spark, SF).collect()) == counted((r.doc_id, r.n_tokens, r.decoded_sha256) for r in steps[5])
