"""Personal data: fixed patterns, and candidate spans judged by gradient-boosted trees.

SQL functions only. Strict and loose generators propose overlapping spans;
boosted trees over yes/no features of format and context score the loose ones,
and those above a calibrated threshold that touch no fixed span are added.
"""

from __future__ import annotations

from math import exp, log
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from omphalos.llm.common import let

KINDS = ("email", "ip", "card", "phone")
OTHER = "other"

#: The fixed patterns, written so that each text is scanned once: quantifiers
#: are possessive where nothing that follows could use what they give back, and
#: matches start where a run of their characters starts. A card pattern takes
#: whole chains of 13 to 19 digits only, as chains of other lengths fail anyway.
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
STRICT = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"[0-9](?<![0-9]{2})[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?<![0-9]{2})(?<![0-9][\x20-][0-9])(?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Loose generators: chains of digit groups, and addresses with a spelt-out sign.
LOOSE = {
    "number": r"[0-9](?<![0-9]{2})(?:[\x20()./-]{0,2}[0-9]){6,24}+(?![0-9])",
    "address": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]{1,64}+\x20?[\[(](?:at|AT|@)[\])]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z0-9-]++){1,8}+",
}
#: A text without these characters can't match, and isn't scanned for the pattern.
NEEDS = {"email": "@", "phone": "+"}

#: Signs of a spelt-out address that e-mails are rewritten with for training, and what looks as little
#: like one: two words and the begin of the next sentence, or a word and a number with a dot.
SPELT = ((" [at] ", " [dot] "), ("(at)", "."), (" (at) ", " (dot) "), ("[at]", "[dot]"), (" [at] ", "."))
NO_ADDRESS = r"(?<![A-Za-z0-9._%+-])[A-Za-z]++\x20[A-Za-z0-9]++\.\x20?[A-Z0-9][A-Za-z0-9]*+"

#: Documents of the training sample, boosting rounds, learning rate, precision asked of the threshold.
SAMPLE, ROUNDS, SHRINK, PRECISION = 20_000, 24, 0.3, 0.95
#: Code points of context before and behind a candidate.
BEFORE, BEHIND = 24, 2


def _empty() -> Column:
    return F.array().cast("array<struct<a:int,b:int,s:string>>")


def match_spans(text: Column, pattern: str, needs: str | None = None) -> Column:
    """``array<struct<a, b, s>>``: start, end (code points, exclusive) and string of every match, left to right.

    The gaps come from splitting by the pattern; starts are running sums of gap
    and match lengths, taken in blocks of about the square root of their number.
    """
    total = lambda xs: F.aggregate(xs, F.lit(0), lambda n, x: n + x)

    def placed(x: Column) -> Column:
        found, gaps = x["m"], x["g"]
        count = F.size(found)
        width = F.ceil(F.sqrt(count)).cast("int")
        sizes = F.transform(found, lambda s, i: F.length(s) + F.length(F.get(gaps, i)))

        def with_sizes(z: Column) -> Column:
            blocks = F.transform(F.sequence(F.lit(0), F.floor((count - 1) / width).cast("int")), lambda k: total(F.slice(z, k * width + 1, width)))

            def with_blocks(y: Column) -> Column:
                before = F.transform(y, lambda _, k: total(F.slice(y, F.lit(1), k)))

                def starts(p: Column) -> Column:
                    def one(s: Column, i: Column) -> Column:
                        k = F.floor(i / width).cast("int")
                        a = F.get(p, k) + total(F.slice(z, k * width + 1, i - k * width)) + F.length(F.get(gaps, i))
                        return F.struct(a.alias("a"), (a + F.length(s)).alias("b"), s.alias("s"))

                    return F.transform(found, one)

                return let(before, starts)

            return let(blocks, with_blocks)

        return F.when(count > 0, let(sizes, with_sizes)).otherwise(_empty())

    asked = text.rlike(pattern) if needs is None else (F.instr(text, needs) > 0)
    both = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))
    return F.when(asked, let(both, placed)).otherwise(_empty())


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits has a right check digit."""
    n = F.length(digits)

    def weight(total: Column, i: Column) -> Column:
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 0, doubled).otherwise(d)

    return F.when(n > 0, F.aggregate(F.sequence(F.lit(1), n), F.lit(0), weight) % 10 == 0).otherwise(F.lit(False))


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return s.rlike(rf"\A{_OCTET}(?:\.{_OCTET}){{3}}\z")
    if kind == "card":
        return let(digits_of(s), luhn)
    if kind == "phone":
        return F.length(digits_of(s)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """``array<struct<kind, a, b>>`` of the fixed patterns, by kind and start; failing matches are dropped."""
    each = []
    for kind in KINDS:
        good = F.filter(match_spans(text, STRICT[kind], NEEDS.get(kind)), lambda x: _valid(kind, x["s"]))
        each.append(F.transform(good, lambda x: F.struct(F.lit(kind).alias("kind"), x["a"].alias("a"), x["b"].alias("b"))))
    return F.concat(*each)


def _candidate(text: Column, kind: str, x: Column, s: Column) -> Column:
    """The candidate ``s`` in the place and the context of the span ``x``."""
    return F.struct(
        F.lit(kind).alias("kind"), x["a"].alias("a"), x["b"].alias("b"), s.alias("s"),
        F.lower(F.substring(text, F.greatest(x["a"] - BEFORE, F.lit(0)) + 1, F.least(x["a"], F.lit(BEFORE)))).alias("before"),
        F.substring(text, x["b"] + 1, F.lit(BEHIND)).alias("behind"),
    )


def spelt_out(text: Column, mark: Column) -> tuple[Column, Column]:
    """Candidates of the address generator with known labels: e-mails of the fixed pattern, and what is none, both rewritten.

    ``mark`` chooses the signs, so they don't tell which is which.
    """
    n = F.pmod(mark, F.lit(len(SPELT))).cast("int") + 1
    at, dot = (F.element_at(F.array(*[F.lit(x[k]) for x in SPELT]), n) for k in (0, 1))
    fits = lambda c: c["s"].rlike(rf"\A{LOOSE['address']}\z")

    def rewritten(x: Column) -> Column:
        return F.concat(F.substring_index(x["s"], "@", 1), at, F.replace(F.substring_index(x["s"], "@", -1), F.lit("."), dot))

    def joined(x: Column) -> Column:
        host = F.regexp_replace(F.regexp_extract(x["s"], r"\x20(.*)", 1), r"\x20", "")
        return F.concat(F.substring_index(x["s"], " ", 1), at, F.replace(host, F.lit("."), dot))

    yes = F.transform(match_spans(text, STRICT["email"], NEEDS["email"]), lambda x: _candidate(text, "address", x, rewritten(x)))
    no = F.transform(match_spans(text, NO_ADDRESS), lambda x: _candidate(text, "address", x, joined(x)))
    return F.filter(yes, fits), F.filter(no, fits)


def loose_candidates(text: Column) -> Column:
    """``array<struct<kind, a, b, s, before, behind>>`` of the loose generators."""
    each = []
    for kind, pattern in LOOSE.items():
        found = match_spans(text, pattern)
        each.append(
            F.transform(
                found,
                lambda x: _candidate(text, kind, x, x["s"]),
            )
        )
    return F.concat(*each)


def features(c: Column) -> list[Column]:
    """Yes/no features of a candidate's format and context, in a fixed order.

    Whether a number carries a plus is left out on purpose: the fixed phone
    pattern decides by it, and the trees should know the rest of the format.
    """
    s, before, behind = c["s"], c["before"], c["behind"]
    digits = digits_of(s)
    n = F.length(digits)
    dots = F.length(F.regexp_replace(s, "[^.]", ""))
    marks = F.length(F.regexp_replace(s, r"[^\x20()./-]", ""))
    return [
        c["kind"] == "address",
        n >= 9,
        n >= 11,
        n >= 13,
        n >= 16,
        s.contains("("),
        s.contains("."),
        s.contains("-"),
        s.contains(" "),
        s.contains("/"),
        marks >= 3,
        (dots == 3) & (marks == 3),
        s.rlike(r"\A[0-9]{1,3}[\x20]?\(?[0-9]{3}\)[\x20-]?[0-9]{3}-[0-9]{4}\z"),
        (n >= 13) & luhn(digits),
        before.rlike(r"(?:tel|phone|call|fax|mobil|cell|appel|llam|ruf)[a-zéáó]*[.:]?\x20*[+(]?\z"),
        before.rlike(r"(?:card|visa|karte|carte|tarjeta|konto|account|iban)[a-z]*[.:]?\x20*\z"),
        before.rlike(r"[a-z0-9_=\"'./-]\z"),
        behind.rlike(r"\A[A-Za-z0-9_\"'=/-]"),
        s.rlike(r"(?:[.\x20\])])[a-z]{2,24}\z"),
    ]


class Tree(NamedTuple):
    """A tree of two levels: ``root`` asks a feature, ``yes`` and ``no`` hold (feature, value if yes, value if no)."""

    root: int
    yes: tuple[int, float, float]
    no: tuple[int, float, float]

    def value(self, mask: int) -> float:
        f, a, b = self.yes if mask >> self.root & 1 else self.no
        return a if mask >> f & 1 else b


class Model(NamedTuple):
    bias: float
    trees: tuple[Tree, ...]
    threshold: float
    #: The model of spelt-out addresses, whose labels come from elsewhere and whose threshold is its own.
    address: Model | None = None

    def score(self, mask: int) -> float:
        return self.bias + sum(t.value(mask) for t in self.trees)


#: Adds nothing; what an empty or one-sided sample gives.
NO_MODEL = Model(0.0, (), float("inf"))


def boost(table: list[tuple[int, int, int, int]], n_features: int, rounds: int = ROUNDS) -> Model:
    """Boosted trees from rows ``(mask, fold, label, count)``.

    Folds other than 0 are fitted by Newton steps on the logistic loss; the
    threshold is the least score from which on fold 0 has PRECISION (with one
    miss added, so that few rows prove little).
    """
    rows: dict[int, list[float]] = {}
    for mask, fold, label, n in table:
        if fold:
            rows.setdefault(mask, [0, 0])[label] += n
    neg, pos = (sum(r[k] for r in rows.values()) for k in (0, 1))
    if not neg or not pos:
        return NO_MODEL
    bias, trees = log(pos / neg), []
    scores = dict.fromkeys(rows, bias)

    def side(stats: dict[int, tuple[float, float]], f: int) -> tuple[float, float, float]:
        """Gain and both leaf values of asking ``f``."""
        gain, values = 0.0, []
        for bit in (1, 0):
            g = sum(x[0] for m, x in stats.items() if m >> f & 1 == bit)
            h = sum(x[1] for m, x in stats.items() if m >> f & 1 == bit) + 1.0
            gain += g * g / h
            values.append(SHRINK * g / h)
        return gain, values[0], values[1]

    def best(stats: dict[int, tuple[float, float]]) -> tuple[float, tuple[int, float, float]]:
        gain, f = max((side(stats, f)[0], -f) for f in range(n_features))
        return gain, (-f, *side(stats, -f)[1:])

    for _ in range(rounds):
        stats = {}
        for m, (n0, n1) in rows.items():
            p = 1 / (1 + exp(-scores[m]))
            stats[m] = (n1 - p * (n0 + n1), p * (1 - p) * (n0 + n1))
        options = []
        for f in range(n_features):
            yes = best({m: x for m, x in stats.items() if m >> f & 1})
            no = best({m: x for m, x in stats.items() if not m >> f & 1})
            options.append((yes[0] + no[0], -f, yes[1], no[1]))
        _, root, yes, no = max(options)
        trees.append(Tree(-root, yes, no))
        for m in rows:
            scores[m] += trees[-1].value(m)
    model = Model(bias, tuple(trees), float("inf"))
    held: dict[float, list[float]] = {}
    for mask, fold, label, n in table:
        if not fold:
            held.setdefault(round(model.score(mask), 9), [0, 0])[label] += n
    good = bad = 0
    threshold = float("inf")
    for score in sorted(held, reverse=True):
        bad, good = bad + held[score][0], good + held[score][1]
        if good >= PRECISION * (good + bad + 1):
            threshold = score - 1e-9
    return model._replace(threshold=threshold)


def model_score(model: Model, asked: Column) -> Column:
    """The model as one expression over an array of yes/no features."""
    is_ = lambda f: F.get(asked, F.lit(f))
    leaf = lambda t: F.when(is_(t[0]), F.lit(t[1])).otherwise(F.lit(t[2]))
    total = F.lit(model.bias)
    for t in model.trees:
        total = total + F.when(is_(t.root), leaf(t.yes)).otherwise(leaf(t.no))
    return total


def _touches(c: Column, spans: Column) -> Column:
    return F.exists(spans, lambda x: (x["a"] < c["b"]) & (c["a"] < x["b"]))


def train_model(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> Model:
    """Trees fitted to the loose candidates of about ``sample`` documents, chosen by the hash of their id.

    A number is positive where it touches a valid span of a fixed pattern. A
    spelt-out address never does, so addresses have a model of their own, from
    e-mails and other text rewritten to the spelt-out form; those that the
    documents hold have no label and aren't trained on.
    What comes to the driver are counts by feature mask, fold and label.
    """
    total = docs.count()
    if not total:
        return NO_MODEL
    rate = int(min(1.0, sample / total) * (1 << 20))
    mark = F.xxhash64(F.col(doc_id).cast("string"), F.lit("pii"))
    body = F.coalesce(F.col(text), F.lit(""))
    chosen = docs.where(F.pmod(mark, F.lit(1 << 20)) < rate).select(mark.alias("mark"), body.alias("text"))
    yes, no = spelt_out(F.col("text"), F.col("mark"))
    label = lambda cs, of: F.transform(cs, lambda c: F.struct(c.alias("c"), of(c).cast("int").alias("label")))
    numbers = F.filter(loose_candidates(F.col("text")), lambda c: c["kind"] != "address")
    with_base = chosen.select("mark", "text", base_spans(F.col("text")).alias("base"))
    each = F.concat(label(numbers, lambda c: _touches(c, F.col("base"))), label(yes, lambda c: F.lit(1)), label(no, lambda c: F.lit(0)))
    found = with_base.select("mark", F.explode(each).alias("x")).select("mark", "x.c", "x.label")
    asked = features(F.col("c"))
    bits = sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(asked)), F.lit(0))
    fold = (F.pmod(F.shiftright("mark", 20), F.lit(4)) > 0).cast("int")
    table = found.select(bits.alias("mask"), fold.alias("fold"), "label").groupBy("mask", "fold", "label").count()
    rows = [tuple(r) for r in table.orderBy(F.desc("count"), "mask", "fold", "label").limit(100_000).collect()]
    model, address = (boost([r for r in rows if r[0] & 1 == k], len(asked)) for k in (0, 1))  # feature 0 is the kind
    return model._replace(address=address)


def find_pii(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``base`` and ``added``: ``array<struct<kind, a, b>>`` of the whole text.

    Offsets are code points, the end exclusive. Null and empty texts have no
    spans. Columns of those names are replaced.
    """
    plain = docs.drop("base", "added")
    body = F.coalesce(F.col(text), F.lit(""))
    first = plain.select("*", base_spans(body).alias("base"))
    models = [m for m in (model, model.address) if m is not None and m.threshold < float("inf")]
    if not models:
        return first.withColumn("added", F.array().cast("array<struct<kind:string,a:int,b:int>>"))
    second = first.select("*", F.filter(loose_candidates(body), lambda c: ~_touches(c, F.col("base"))).alias("__loose"))
    passes = lambda m, asked: model_score(m, asked) >= F.lit(m.threshold) if m in models else F.lit(False)
    good = F.filter("__loose", lambda c: let(F.array(*features(c)), lambda asked: F.when(F.get(asked, F.lit(0)), passes(model.address, asked)).otherwise(passes(model, asked))))
    named = F.transform(F.sort_array(F.transform(good, lambda c: F.struct(c["a"].alias("a"), c["b"].alias("b")))), lambda c: F.struct(F.lit(OTHER).alias("kind"), c["a"].alias("a"), c["b"].alias("b")))
    return second.select(*plain.columns, "base", named.alias("added"))


def redact(text: Column, spans: Column) -> Column:
    """``text`` with every span, overlapping ones as one, replaced by its first kind in brackets."""
    order = F.sort_array(F.transform(spans, lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b"), x["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        gap = F.substring(text, acc["at"] + 1, F.greatest(x["a"] - acc["at"], F.lit(0)))
        more = F.when(x["a"] >= acc["at"], F.array(gap, F.concat(F.lit("["), F.upper(x["kind"]), F.lit("]")))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(acc["at"], x["b"]).alias("at"), F.concat(acc["out"], more).alias("out"))

    rest = lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(order, start, step, rest)).otherwise(text)


def written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["a"].cast("string"), x["b"].cast("string"))), ",")


def op6_pii(docs: DataFrame) -> DataFrame:
    """Counts of the fixed spans, their digest and all spans, for every document."""
    found = find_pii(docs.select("doc_id", "text"), train_model(docs))
    counts = [F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base")), 256).alias("base_sha256"), written(F.concat("base", "added")).alias("spans"))
