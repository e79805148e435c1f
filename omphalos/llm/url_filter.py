"""URL filters: explicit rules, and block decisions that spread over redirects and canonical links.

SQL functions only. Pages are nodes by their address (host, path and query);
an edge joins a page to the address that its HTML names as its refresh target
or canonical link. Within a connected component a block reaches the pages that
no rule fits, unless the component also holds an explicitly allowed page.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omphalos.llm.common import Scratch, hot_lookup, let, union_all
from omphalos.llm.components import connected_components


class UrlRule(NamedTuple):
    """Fits ``host`` and its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str


#: The production rules.
RULES = (
    UrlRule("org", "/", "allow"),
    UrlRule("example.org", "/es/", "block"),
    UrlRule("example.org", "/en/1", "block"),
    UrlRule("com", "/fr/", "allow"),
    UrlRule("com", "/de/", "block"),
)

#: Whole tags that can name an address (a refresh that leads on, or the canonical form), and the attributes of a tag.
TAG = r"""(?i)<(?:meta|link)\b(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+"""
ATTRIBUTE = r"""[^\s"'<>/=]++\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
#: The common forms only, in one pattern each, as the registered SQL states them.
REFRESH = r"""(?i)<meta\b[^>]{0,200}\bhttp-equiv\s*=\s*["']?refresh["']?[^>]{0,200}\burl\s*=\s*["']?([^"'>\x00-\x20]+)"""
CANONICAL = r"""(?i)<link\b[^>]{0,200}\brel\s*=\s*["']?canonical["']?[^>]{0,200}\bhref\s*=\s*["']?([^"'>\x00-\x20]+)"""
CANONICAL_LAST = r"""(?i)<link\b[^>]{0,200}\bhref\s*=\s*["']?([^"'>\x00-\x20]+)["']?[^>]{0,200}\brel\s*=\s*["']?canonical\b"""
#: What comes before the target in the content of a refresh.
DELAY = r"""(?i)\A\s*+(?:[0-9.]++\s*+(?:[;,]\s*+|(?<=\s))(?:url\s*+=\s*+)?|url\s*+=\s*+)"""


def _after_scheme(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.regexp_replace(url, r"(?s)\A.*?://", "")).otherwise(F.lit(""))


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    host = F.regexp_extract(_after_scheme(url), r"(?s)\A([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, upper, upper.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)\A[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> tuple[Column, Column]:
    """Name (``host`` + ``path``) and verdict of the longest rule that fits; of two as long, the first listed."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: len(r.host + r.path)):  # the longest is asked first, so it comes last here
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, F.lit(r.host + r.path)).otherwise(name)
        verdict = F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return name, verdict


def _address(url: Column, path: Column | None = None) -> Column:
    """Node of an absolute address: host, path (``path`` if given) and query; null for others."""
    query = F.regexp_extract(_after_scheme(url), r"(?s)\A[^?#]*(\?[^#]*)", 1)
    path = url_path(url) if path is None else path
    return F.when(url_host(url) != "", F.concat(url_host(url), F.when(path == "", F.lit("/")).otherwise(path), query))


def _without_dots(path: Column) -> Column:
    """``path`` with ``.`` and ``..`` segments resolved."""
    start = F.array().cast("array<string>")
    kept = lambda out, s: F.when(s == ".", out).when(s == "..", F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(1)))).otherwise(F.concat(out, F.array(s)))
    whole = F.aggregate(F.split(F.regexp_replace(path, r"/\.{1,2}\z", "$0/"), "/", -1), start, kept)
    return F.when(path.rlike(r"/\.{1,2}(?:/|\z)"), F.array_join(whole, "/")).otherwise(path)


def resolved(target: Column, url: Column) -> Column:
    """The absolute form of ``target`` on the page ``url``; a page without a host resolves absolute targets only."""
    home, path = F.concat(F.lit("http://"), url_host(url)), F.when(url_path(url) == "", F.lit("/")).otherwise(url_path(url))
    query = F.regexp_extract(_after_scheme(url), r"(?s)\A[^?#]*(\?[^#]*)", 1)
    return (
        F.when(target.rlike(r"\A[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(F.lit("http:"), target))
        .when(url_host(url) == "", F.lit(None))
        .when(target.startswith("/"), F.concat(home, target))
        .when(target.startswith("?"), F.concat(home, path, target))
        .when(target.startswith("#"), F.concat(home, path, query, target))
        .otherwise(F.concat(home, F.regexp_extract(path, r"(?s)\A.*/", 0), target))
    )


def _named(tag: Column) -> Column:
    """The address that a tag names, as it is written there; null for none. Attributes come in any order and length."""

    def read(attributes: Column) -> Column:
        def value(name: str) -> Column:
            first = F.get(F.filter(attributes, lambda x: x.rlike(rf"(?i)\A{name}\s*=")), F.lit(0))
            return F.regexp_extract(first, r"""(?s)\A[^=]*=\s*(["']?)(.*?)\1\z""", 2)

        after = F.when(value("content").rlike(DELAY), F.regexp_replace(value("content"), DELAY, ""))
        target = F.coalesce(*[F.nullif(F.regexp_extract(after, p, 1), F.lit("")) for p in (r"""(?s)\A"([^"\x00-\x20]+)""", r"""(?s)\A'([^'\x00-\x20]+)""", r"""\A([^"'\x00-\x20][^\x00-\x20]*)""")])
        refresh = F.when(F.lower(F.trim(value("http-equiv"))) == "refresh", target)
        canonical = F.when(value("rel").rlike(r"(?i)(?:\A|\s)canonical(?:\s|\z)"), F.regexp_extract(value("href"), r"\A\s*([^\x00-\x20]+)", 1))
        return F.when(tag.rlike(r"(?i)\A<meta"), refresh).otherwise(canonical)

    return F.regexp_replace(let(F.regexp_extract_all(tag, F.lit(ATTRIBUTE), F.lit(0)), read), r"(?i)&(?:amp|#0*38|#x0*26);", "&")


def url_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``(here, there)`` addresses of every redirect and canonical link; relative targets are resolved against the page's url.

    ``&amp;`` is read as ``&``, other entities as they stand; a ``base`` tag isn't read.
    """
    body = F.col(html)
    tags = F.filter(F.regexp_extract_all(body, F.lit(TAG), F.lit(0)), lambda x: x.rlike("(?i)canonical|http-equiv"))
    marked = F.when(body.rlike("(?i)canonical|http-equiv"), tags)  # a quick look before the patterns
    links = pages.where(F.col(url).isNotNull()).select(F.col(url).alias("url"), F.explode(marked).alias("tag"))
    full = links.select("url", _named(F.col("tag")).alias("to")).where("to <> ''").select("url", resolved(F.col("to"), F.col("url")).alias("full"))
    there = _address(F.col("full"), _without_dots(url_path(F.col("full"))))
    return full.select(_address(F.col("url")).alias("here"), there.alias("there")).where("here <> there").distinct()


def filter_urls(pages: DataFrame, url: str = "url", html: str = "html", rules: tuple[UrlRule, ...] = RULES) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict`` (allow or block).

    The page's own rule decides. Else the verdict is block where a component
    of redirects and canonical links holds a blocked page and no explicitly
    allowed one, and allow otherwise. Null urls and those without ``://`` have
    empty host and path, fit no rule and are allowed; null or empty HTML names no
    address. Columns of those names are replaced, all others kept; repeated rows stay.
    Pages that a rule decides or that have no address take no part in the join
    with the blocked components, and an address of very many pages isn't
    gathered in a task.
    """
    scratch = Scratch(pages.sparkSession, "url-filter")
    plain = pages.drop("host", "path", "rule", "verdict")
    hosted = plain.select("*", url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = hosted.select("*", rule.alias("rule"), verdict.alias("verdict"))
    edges = scratch.save(url_edges(pages, url, html), "edges")
    if edges.isEmpty():
        return ruled.withColumn("verdict", F.coalesce("verdict", F.lit("allow")))
    both = edges.select(F.col("here").alias("address")).unionByName(edges.select(F.col("there").alias("address"))).distinct()
    links = edges.select(F.col("here").alias("a"), F.col("there").alias("b"))
    parts = connected_components(scratch, links).withColumnRenamed("node", "address")
    _, verdict_here = rule_of(url_host(F.concat(F.lit("x://"), F.col("address"))), url_path(F.concat(F.lit("x://"), F.col("address"))), rules)
    judged = both.select("address", verdict_here.alias("own")).join(parts, "address")
    has = lambda v: F.bool_or(F.coalesce(F.col("own") == v, F.lit(False)))
    spread = judged.groupBy("component").agg(has("allow").alias("allowed"), has("block").alias("blocked"), F.count("*").alias("n"))
    spread = scratch.save(spread.where("blocked AND NOT allowed").select("component", "n"), "spread")
    address, count, hit = _free(ruled.columns, "address", "count", "hit")
    tainted = scratch.save(hot_lookup(parts, spread, "component", "n").select(F.col("address").alias(address), F.lit(True).alias(hit)), "tainted")
    rows = ruled.withColumn(address, F.when(F.col("verdict").isNull(), _address(F.col(url))))
    decided = rows.where(F.col(address).isNull())
    asked = rows.where(F.col(address).isNotNull())
    # addresses with more than a thousandth of the rows are at most a thousand
    counts = scratch.save(asked.groupBy(address).agg(F.count("*").alias(count)), "counts")
    total = counts.agg(F.sum(count)).first()[0] or 0
    hot = scratch.save(counts.where(F.col(count) > max(5_000, total // 1000)).select(address).join(tainted, address, "left"), "hot")
    dealt = [asked.join(tainted, address, "left")]
    if not hot.isEmpty():
        dealt = [asked.join(F.broadcast(hot.select(address)), address, "left_anti").join(tainted, address, "left"), asked.join(F.broadcast(hot), address)]
    found = union_all([decided.withColumn(hit, F.lit(None).cast("boolean")), *dealt])
    by_links = F.when(F.col(hit), F.lit("block")).otherwise(F.lit("allow"))
    return found.withColumn("verdict", F.coalesce("verdict", by_links)).select(*[F.col(_quoted(c)) for c in ruled.columns])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _free(taken: list[str], *names: str) -> list[str]:
    """Each name, with as many underscores in front as no column of ``taken`` has."""
    used, out = {c.lower() for c in taken}, []
    for name in names:
        while name in used:
            name = "_" + name
        out.append(name)
    return out


def op8_url_filters(pages: DataFrame) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` and ``verdict`` of every page."""
    return filter_urls(pages.select("page_id", "url", "html")).select("page_id", "host", "path", "rule", "verdict")
