"""Secret scan through a trigram inverted index.

Each rule is a regular expression and a least length of its secret part. ``trigram_query`` derives the
Boolean query from the expression itself: walking its parse, it keeps the strings a part can match exactly while
they are few, else those it can begin and end with, and collects the trigrams that any match must hold as
OR-of-AND clauses (lower-cased, so a superset for either case). Only trigrams that some clause needs are indexed:

1. postings (trigram, doc_id) of all documents, one scan;
2. per clause the postings are intersected by counting distinct trigrams per document
   (the count is of at most a few rows a document, so no key is hot);
3. documents that satisfy a clause are candidates of its rule and are verified with the
   expression; a rule without mandatory trigrams scans every document fully.

Offsets are code points, found without leaving the JVM: the matches of ``regexp_extract_all`` and
the gaps of ``split`` by the same expression alternate, so running lengths give the starts.

Defined cases: null text is empty; a null doc_id is verified by every rule (it cannot be looked up
in the postings); repeated rows each keep their spans; very long texts are searched whole; empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

from re import _parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, rows, text_or_empty

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: kind, expression, group that must be long enough, its least length
RULES = [
    ("assign", ASSIGN, 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
]
BASE = ("assign", "access", "hex")
FEW = 64  # strings, or clauses, that are kept apart; beyond, a weaker query that still holds for every match


class Part(NamedTuple):
    """What a part of an expression can match: all its strings if few (exact), what it begins and ends with, its clauses."""
    exact: frozenset | None
    begin: frozenset
    end: frozenset
    clauses: frozenset


TRUE = frozenset([frozenset()])
EMPTY = Part(frozenset([""]), frozenset([""]), frozenset([""]), TRUE)
ANY = Part(None, frozenset([""]), frozenset([""]), TRUE)


def _least(clauses) -> frozenset:
    """Clauses without those that another one is part of."""
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _and(a: frozenset, b: frozenset) -> frozenset:
    both = _least({x | y for x in a for y in b})
    return both if len(both) <= FEW else min(a, b, key=len)


def _grams(strings) -> frozenset:
    """One clause per string, of its trigrams; TRUE where some string has none."""
    return _least({frozenset(x[i:i + 3] for i in range(len(x) - 2)) for x in strings})


def _open(p: Part) -> Part:
    """The part without its exact strings, what they tell kept in its clauses and ends."""
    if p.exact is None:
        return p
    return Part(None, frozenset(x[:3] for x in p.exact), frozenset(x[-2:] for x in p.exact), _and(p.clauses, _grams(p.exact)))


def _then(a: Part, b: Part) -> Part:
    if a.exact is not None and b.exact is not None and len(a.exact) * len(b.exact) <= FEW:
        exact = frozenset(x + y for x in a.exact for y in b.exact)
        return Part(exact, exact, exact, _and(a.clauses, b.clauses))
    over = frozenset(x + y for x in (a.exact or a.end) for y in (b.exact or b.begin))
    clauses = _and(_and(_open(a).clauses, _open(b).clauses), _grams(over) if len(over) <= FEW else TRUE)
    begin = frozenset((x + y)[:3] for x in a.exact for y in (b.exact or b.begin)) if a.exact is not None else a.begin
    end = frozenset((x + y)[-2:] for x in (a.exact or a.end) for y in b.exact) if b.exact is not None else b.end
    return Part(None, begin, end, clauses)


def _either(parts: list[Part]) -> Part:
    if all(p.exact is not None for p in parts) and len(exact := frozenset().union(*(p.exact for p in parts))) <= FEW:
        return Part(exact, exact, exact, _least(frozenset().union(*(p.clauses for p in parts))))
    parts = [_open(p) for p in parts]
    clauses = _least(frozenset().union(*(p.clauses for p in parts)))
    return Part(None, *(frozenset().union(*(p[i] for p in parts)) for i in (1, 2)), clauses if len(clauses) <= FEW else TRUE)


def _walk(parsed) -> Part:
    """The part that a parsed expression stands for; what the walk does not know may match anything."""
    out = EMPTY
    for op, value in parsed:
        kind = str(op)
        if kind == "LITERAL":
            one = frozenset([chr(value).lower()])
            part = Part(one, one, one, TRUE)
        elif kind == "IN":
            chars: set[str] | None = set()
            for what, x in value:
                span = range(x, x + 1) if str(what) == "LITERAL" else range(x[0], x[1] + 1) if str(what) == "RANGE" else None
                chars = None if chars is None or span is None or len(span) > FEW else chars | {chr(c).lower() for c in span}
            few = frozenset(chars) if chars is not None and len(chars) <= 8 else None
            part = Part(few, few, few, TRUE) if few else ANY
        elif kind == "BRANCH":
            part = _either([_walk(x) for x in value[1]])
        elif kind == "SUBPATTERN":
            part = _walk(value[-1])
        elif kind in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            low, high, inner = value
            one = _walk(inner)
            part = EMPTY
            for _ in range(min(low, 3)):
                part = _then(part, one)
            if (low, high) == (0, 1):
                part = _either([EMPTY, one])
            elif high > min(low, 3):
                part = _then(part, ANY) if low else ANY
        elif kind in ("AT", "ASSERT", "ASSERT_NOT"):
            part = EMPTY
        elif kind == "ATOMIC_GROUP":
            part = _walk(value)
        else:
            part = ANY
        out = _then(out, part)
    return out


def trigram_query(pattern: str) -> list[list[str]]:
    """OR of ANDs of lower-cased trigrams that every match holds; empty where a match need not hold any."""
    clauses = _open(_walk(_parser.parse(pattern))).clauses
    return [] if frozenset() in clauses else sorted(sorted(c) for c in clauses)


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, doc_id) for the indexed trigrams that occur in a document, each pair once per row."""
    low = docs.where("doc_id is not null").select("doc_id", ascii_lower(text_or_empty("text")).alias("low"))
    hit = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(g)), F.lit(g)) for g in grams]))
    # the outer form: the planner would add a filter on the array's size below, and search every text twice
    return low.select("doc_id", F.explode_outer(hit).alias("gram")).where("gram is not null")


def candidates(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, kinds): the rules whose trigram query a document satisfies."""
    spark = docs.sparkSession
    need, size = [], []
    for kind, pattern, _, _ in rules:
        for i, clause in enumerate(trigram_query(pattern)):
            size.append((f"{kind}/{i}", kind, len(clause)))
            need += [(g, f"{kind}/{i}") for g in clause]
    grams = sorted({g for g, _ in need})
    if not grams:
        return rows(spark, [], "doc_id long, kinds array<string>")
    need_df = F.broadcast(rows(spark, need, "gram string, clause string"))     # rule text: a few dozen rows
    size_df = F.broadcast(rows(spark, size, "clause string, kind string, n int"))
    met = postings(docs, grams).join(need_df, "gram").groupBy("doc_id", "clause").agg(F.count_distinct("gram").alias("m"))
    return met.join(size_df, "clause").where("m = n").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def match_spans(text: Column, kind: str, pattern: str, group: int, least: int, order: int) -> Column:
    """array<struct<start, ord, kind, end>> of the leftmost non-overlapping matches with a long enough group."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    gaps = F.split(text, pattern, -1)
    pieces = F.arrays_zip(F.transform(whole, F.length).alias("m"), F.transform(part, F.length).alias("g"),
                          F.transform(gaps, F.length).alias("x"))
    typ = "array<struct<start:int,ord:int,kind:string,end:int>>"
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(typ).alias("spans"))

    def step(acc, p):
        s = acc["at"] + p["x"]
        span = F.struct(s.alias("start"), F.lit(order).alias("ord"), F.lit(kind).alias("kind"), (s + p["m"]).alias("end"))
        return F.struct((s + F.coalesce(p["m"], F.lit(0))).alias("at"),
                        F.when(p["g"] >= least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    # no match of the wanted length at all is by far the usual case: one rlike decides it
    return F.when(F.size(F.filter(part, lambda x: F.length(x) >= least)) > 0,
                  F.aggregate(pieces, zero, step, lambda acc: acc["spans"])).otherwise(F.array().cast(typ))


def scan_secrets(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, spans): every row of ``docs`` with array<struct<start, ord, kind, end>> by start, then rule order."""
    d = docs.select("doc_id", text_or_empty("text").alias("text"))
    c = candidates(docs, rules)
    d = d.join(c, "doc_id", "left")
    typ = "array<struct<start:int,ord:int,kind:string,end:int>>"
    parts = []
    for order, (kind, pattern, group, least) in enumerate(rules):
        full = not trigram_query(pattern)
        if full and least > 1:
            pattern = at_least(pattern, least)
        spans = match_spans(F.col("text"), kind, pattern, group, least, order)
        if not full:
            wanted = F.col("doc_id").isNull() | F.coalesce(F.array_contains("kinds", kind), F.lit(False))
            spans = F.when(wanted, spans).otherwise(F.array().cast(typ))
        else:
            spans = F.when(F.col("text").rlike(pattern), spans).otherwise(F.array().cast(typ))
        parts.append(spans)
    return d.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def at_least(pattern: str, least: int) -> str:
    """For one repeated class (``[...]+``), whose matches are whole runs: the same runs, short ones passed over."""
    return pattern[:-1] + "{%d,}" % least if pattern.startswith("[") and pattern.endswith("]+") else pattern


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
