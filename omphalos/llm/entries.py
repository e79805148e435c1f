"""Registered queries of the corpus operators, and DuckDB SQL where SQL can say the same."""

from __future__ import annotations

import public_tokenizers

from omphalos.llm import bpe, chat_format, decontam, divergence, language, merkle, near_dup, pii, quality, secret_scan, suffix_dedup, token_counts, url_filter
from omphalos.llm.common import table

#: The tokenizer of the production queries.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def op1_quality_rules(spark, sf_dir):
    return quality.op1_quality_rules(table(spark, sf_dir, "documents"))


def op2_token_counts(spark, sf_dir):
    return token_counts.op2_token_counts(table(spark, sf_dir, "documents"), TOKENIZER)


def op3_secret_scans(spark, sf_dir):
    return secret_scan.op3_secret_scans(table(spark, sf_dir, "documents"))


def op4_language_id(spark, sf_dir):
    return language.op4_language_id(table(spark, sf_dir, "documents"))


def op5_benchmark_decontamination(spark, sf_dir):
    return decontam.op5_benchmark_decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_pii(spark, sf_dir):
    return pii.op6_pii(table(spark, sf_dir, "documents"))


def op7_minhash_near_dedup(spark, sf_dir):
    return near_dup.op7_minhash_near_dedup(table(spark, sf_dir, "documents"))


def op8_url_filters(spark, sf_dir):
    return url_filter.op8_url_filters(table(spark, sf_dir, "pages"))


def op9_suffix_dedup(spark, sf_dir):
    return suffix_dedup.op9_suffix_dedup(table(spark, sf_dir, "documents"))


def op10_bpe_encode(spark, sf_dir):
    return bpe.op10_bpe_encode(table(spark, sf_dir, "documents"), TOKENIZER)


def op11_source_divergence(spark, sf_dir):
    return divergence.op11_source_divergence(table(spark, sf_dir, "documents"))


def op12_chat_formatting(spark, sf_dir):
    return chat_format.op12_chat_formatting(table(spark, sf_dir, "conversations"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle.op13_merkle_manifest(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (op1_quality_rules, op2_token_counts, op3_secret_scans, op4_language_id, op5_benchmark_decontamination, op6_pii, op7_minhash_near_dedup, op8_url_filters, op9_suffix_dedup, op10_bpe_encode, op11_source_divergence, op12_chat_formatting, op13_merkle_manifest)
}


def _op1_sql() -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(quality.STOP_WORDS.split())))
    rules = ", ".join(
        f"CASE WHEN n_words >= {r.from_words} AND NOT ({r.feature} BETWEEN {r.low} AND {r.high}) THEN '{r.name}' END" for r in quality.RULES
    )
    return f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(regexp_split_to_array(t, '[ \\t-\\r]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS ls,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols FROM d),
g AS (SELECT rid, i, array_to_string(list_slice(ws, i, i + 4), ' ') AS gram
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
r AS (SELECT rid, i, i - lag(i) OVER (PARTITION BY rid ORDER BY i) AS gap
      FROM (SELECT *, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT rid, sum(least(5, coalesce(gap, 5))) AS n_repeat_words FROM r GROUP BY rid),
f AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
             CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
             len(list_filter(ws, lambda x: lower(x) IN ({stop}))) AS n_stop
      FROM d JOIN w USING (rid) LEFT JOIN c USING (rid)),
q AS (SELECT *, coalesce(word_chars / nullif(n_words, 0), 0) AS mean_word_length,
             coalesce(n_symbols / nullif(n_words, 0), 0) AS symbol_ratio,
             coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_ratio,
             coalesce(n_stop / nullif(n_words, 0), 0) AS stop_word_ratio,
             n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM f),
b AS (SELECT *, list_filter([{rules}], lambda x: x IS NOT NULL) AS broken FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND len(broken) = 0 AS kept, array_to_string(broken, ',') AS broken FROM b"""


_OP5_SQL = """WITH tok AS (SELECT 0 AS kind, row_number() OVER () AS rid, doc_id AS id, text FROM documents
  UNION ALL SELECT 1, row_number() OVER (), item_id, text FROM benchmark),
w AS (SELECT kind, rid, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x{00}-\\x{2F}\\x{3A}-\\x{60}\\x{7B}-\\x{7F}]+') AS ws FROM tok),
m AS (SELECT DISTINCT least(10, len(ws)) AS m FROM w WHERE kind = 1 AND len(ws) > 0),
win AS (SELECT id, m, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS g
        FROM (SELECT id, ws, least(10, len(ws)) AS m, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
              FROM w WHERE kind = 1 AND len(ws) > 0)),
dw AS (SELECT rid, i, m, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS g
       FROM (SELECT rid, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, m WHERE kind = 0 AND len(ws) >= m)),
hit AS (SELECT DISTINCT rid, i, dw.m, win.id FROM dw JOIN win ON dw.m = win.m AND dw.g = win.g),
pos AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + m)) AS p FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS names
        FROM (SELECT DISTINCT rid, CAST(id AS VARCHAR) AS s FROM hit) GROUP BY rid)
SELECT id AS doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN pos USING (rid) LEFT JOIN its USING (rid) WHERE kind = 0"""


_OP7_SQL = """WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT DISTINCT rid, doc_id, array_to_string(list_slice(ws, i, i + least(4, len(ws)) - 1), ' ') AS s
      FROM (SELECT rid, doc_id, ws, unnest(range(1, len(ws) - least(4, len(ws)) + 2)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT rid, count(*) AS n FROM g GROUP BY rid),
both_ AS (SELECT a.rid AS ra, b.rid AS rb, a.doc_id AS a, b.doc_id AS b, count(*) AS c
          FROM g a JOIN g b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL),
links AS (SELECT a, b FROM both_ JOIN n x ON x.rid = ra JOIN n y ON y.rid = rb WHERE 100 * c >= 80 * (x.n + y.n - c)),
step AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, top) AS (SELECT DISTINCT doc_id, doc_id FROM documents UNION SELECT step.b, reach.top FROM reach JOIN step ON step.a = reach.node),
part AS (SELECT node, min(top) AS component_id FROM reach GROUP BY node)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (rid) JOIN part ON part.node = d.doc_id"""


def _op8_sql() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rest = lambda u: f"(CASE WHEN contains({u}, '://') THEN substr({u}, strpos({u}, '://') + 3) ELSE '' END)"
    host = lambda u: f"translate(regexp_extract({rest(u)}, '^([^/?#]*)', 1), '{upper}', '{upper.lower()}')"
    path = lambda u: f"regexp_extract({rest(u)}, '^[^/?#]*([^?#]*)', 1)"
    query = lambda u: f"regexp_extract({rest(u)}, '^[^?#]*(\\?[^#]*)', 1)"
    address = lambda u: f"CASE WHEN {host(u)} <> '' THEN {host(u)} || CASE WHEN {path(u)} = '' THEN '/' ELSE {path(u)} END || {query(u)} END"

    def rule(h: str, p: str, what: str) -> str:
        cases = [
            f"WHEN ({h} = '{r.host}' OR ends_with({h}, '.{r.host}')) AND starts_with({p}, '{r.path}') THEN '{r.host + r.path if what == 'rule' else r.verdict}'"
            for r in sorted(url_filter.RULES, key=lambda r: -len(r.host + r.path))
        ]
        return f"CASE {' '.join(cases)} END"

    patterns = ", ".join("regexp_extract(html, '" + p.replace("'", "''") + "', 1)" for p in (url_filter.REFRESH, url_filter.CANONICAL, url_filter.CANONICAL_LAST))
    full = f"CASE WHEN starts_with(t, '//') THEN 'http:' || t WHEN starts_with(t, '/') THEN 'http://' || {host('url')} || t ELSE t END"
    return f"""WITH RECURSIVE p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
named AS (SELECT DISTINCT url, unnest([{patterns}]) AS t FROM p),
full_ AS (SELECT url, {full} AS t FROM named WHERE t <> ''),
e AS (SELECT DISTINCT {address('url')} AS a, {address('t')} AS b FROM full_),
step AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach(node, top) AS (SELECT DISTINCT a, a FROM step UNION SELECT step.b, reach.top FROM reach JOIN step ON step.a = reach.node),
part AS (SELECT node, min(top) AS top, {host("'x://' || node")} AS h, {path("'x://' || node")} AS q FROM reach GROUP BY node),
own AS (SELECT node, top, {rule('h', 'q', 'verdict')} AS own FROM part),
bad AS (SELECT top FROM own GROUP BY top HAVING bool_or(coalesce(own = 'block', false)) AND NOT bool_or(coalesce(own = 'allow', false))),
x AS (SELECT page_id, {host('url')} AS host, {path('url')} AS path, {address('url')} AS node FROM p)
SELECT page_id, host, path, {rule('host', 'path', 'rule')} AS rule,
       coalesce({rule('host', 'path', 'verdict')}, CASE WHEN top IN (SELECT top FROM bad) THEN 'block' END, 'allow') AS verdict
FROM x LEFT JOIN own USING (node)"""


_OP9_SQL = """WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS t FROM documents),
w AS (SELECT rid, doc_id, i, substr(t, 2 * i + 1, 100) AS s FROM (SELECT rid, doc_id, t, unnest(range(0, strlen(t) // 2 - 49)) AS i FROM d WHERE strlen(t) >= 100)),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING count(*) > 1),
hit AS (SELECT rid, i FROM w JOIN f USING (s) WHERE doc_id > least),
mark AS (SELECT rid, i, CASE WHEN i - lag(i) OVER (PARTITION BY rid ORDER BY i) <= 50 THEN 0 ELSE 1 END AS fresh FROM hit),
run_ AS (SELECT rid, i, sum(fresh) OVER (PARTITION BY rid ORDER BY i) AS k FROM mark),
runs AS (SELECT rid, k, min(i) AS a, max(i) + 50 AS b FROM run_ GROUP BY rid, k),
gaps AS (SELECT rid, k, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY k), 0) AS x, a AS y FROM runs
         UNION ALL SELECT rid, max(k) + 1, max(b), NULL FROM runs GROUP BY rid),
kept AS (SELECT rid, string_agg(substr(t, 2 * x + 1, 2 * (coalesce(y, strlen(t) // 2) - x)), '' ORDER BY k) AS h
         FROM gaps JOIN d USING (rid) GROUP BY rid),
total AS (SELECT rid, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY rid)
SELECT doc_id, CAST(strlen(t) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(h, t))) AS kept_sha256
FROM d LEFT JOIN total USING (rid) LEFT JOIN kept USING (rid)"""


_OP11_SQL = f"""WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x{{00}}-\\x{{40}}\\x{{5B}}-\\x{{60}}\\x{{7B}}-\\x{{7F}}]+') AS ts FROM documents),
w AS (SELECT rid, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= {divergence.LEAST_DOCS}),
own AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
gn AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM g LEFT JOIN own USING (lang, source) GROUP BY ALL),
ln AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
p AS (SELECT g.lang, g.source, k.term, coalesce(own.n, 0) AS n,
             1 + ({divergence.UNIT}::HUGEINT * (coalesce(own.n, 0) + {divergence.PRIOR})) // (gn.total + {divergence.PRIOR} * ln.v) AS p,
             1 + ({divergence.UNIT}::HUGEINT * (k.n + {divergence.PRIOR})) // (ln.total + {divergence.PRIOR} * ln.v) AS q
      FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN own ON own.lang = g.lang AND own.source = g.source AND own.term = k.term
      JOIN gn ON gn.lang = g.lang AND gn.source = g.source JOIN ln ON ln.lang = g.lang),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pr AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(far.value, 0) AS value
       FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN far ON far.lang = a.lang AND far.source = a.source AND far.item = b.source),
tr AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM (SELECT * FROM pr UNION ALL SELECT * FROM tr))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM r WHERE part = 'pair' OR rank <= {divergence.LISTED}"""


_OP12_SQL = rf"""WITH r AS (SELECT conv_id, turn, role, text FROM conversations
  UNION ALL SELECT {chat_format.PROBE_ID}, 0, 'user', '{chat_format.PROBE_TEXT}' UNION ALL SELECT {chat_format.PROBE_ID}, 1, 'assistant', '{chat_format.PROBE_TEXT}'),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS k,
             coalesce(role, '') AS role, coalesce(text, '') AS text FROM r),
e AS (SELECT *, regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS shown,
             replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|nl|>') AS head FROM t)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>') + length(head) + 1 + length(shown) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


ORACLE_SQL = {
    "op1_quality_rules": _op1_sql(),
    "op5_benchmark_decontamination": _OP5_SQL,
    "op7_minhash_near_dedup": _OP7_SQL,
    "op8_url_filters": _op8_sql(),
    "op9_suffix_dedup": _OP9_SQL,
    "op11_source_divergence": _OP11_SQL,
    "op12_chat_formatting": _OP12_SQL,
}
