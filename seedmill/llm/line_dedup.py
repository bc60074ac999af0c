"""Line dedup by an exact set-similarity join over line tokens.

A line is the set of its lower-cased words. A line goes when an earlier line (by doc_id, then line
number) has a Jaccard similarity of at least ``percent`` / 100 with it, whether or not that line stays itself; so of a
chain of lines that change step by step only the first stays. Every line with a word takes
part, however short; a line of a script without spaces is one word, so of those the exact repeats go.

1. Words are counted in ``BUCKETS`` counters; a byte per counter (its logarithm) gives the rarity
   class. That table has a fixed size (1 MB) and goes into the plan as a literal.
2. Lines with equal texts are one entry (first occurrence, 128-bit hash), with their tokens ordered
   by rarity class and hash, of which the prefix n - ceil(t n) + 1 is kept. Lines of so few words that a similar
   one must be equal as a set keep one key of the whole set.
3. Entries meet by prefix token, dealt once, and class of size: length and positional filters, then the parities of
   128 classes of tokens, in as many of which the sets differ at least (64 classes tell lines of over 100 words too seldom apart, and what they
   leave is shuffled once a shared token), and the number of prefix tokens that similar sets share at least. What is left is verified on its words.
4. A token of more than ``HOT`` entries makes no pairs of all of them: the first entry is compared with the
   rest, and only entries that no such first one removed are compared with all others of the token. No match is missed, and near
   copies of one line are not expanded into all pairs.

Defined cases: null text is no line and stays null; empty and blank lines are kept; very long texts and lines are read whole;
a null doc_id comes last in the order; rows repeated as a whole count as one document and get the same result; rows that
share a doc_id are ordered by a hash of their text; extra columns, whatever their names, are ignored and kept; empty tables are fine.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import saved
from .url_filter import bloom_filter, possible_hits

BUCKETS, MIN_TOKENS, PERCENT, BLOCKS, HOT = 1 << 20, 1, 80, 1 << 16, 1000
LAST = (1 << 63) - 1


@contextmanager
def partitioned_by_part_of_keys(spark: SparkSession) -> Iterator[None]:
    """Joins in this block keep sides that are already dealt by some of the join's keys, instead of shuffling them again."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc, th, line_no, line) of every line; doc: doc_id, or the largest long for null."""
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("th"), "text").where("text is not null")
    # the outer form: the planner would add a filter on the array's size below, and split the text twice
    return d.select("doc", "th", F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))


def words_of(line: Column) -> Column:
    """The words of a line, empty strings between them included (one plain separator: no regex engine)."""
    return F.split(F.translate(F.lower(line), "\t\r", "  "), " ")


def rarity(docs: DataFrame) -> bytes:
    """A byte per counter: 0 for counters without words, else more for more frequent words."""
    words = docs.select(F.explode(F.split(F.translate(F.lower("text"), "\t\r\n", "   "), " ")).alias("w"))
    keyed = words.select(F.pmod(F.xxhash64("w"), F.lit(BUCKETS)).cast("int").alias("b"), F.when(F.col("w") != "", 1).otherwise(0).alias("k"))
    found = keyed.groupBy("b").agg(F.sum("k").alias("n")).where("n > 0").toArrow()  # one row per counter at most
    table = np.zeros(BUCKETS, np.uint8)
    table[found.column("b").to_numpy()] = np.minimum(126, 1 + (3 * np.log2(found.column("n").to_numpy())).astype(np.int64))
    return table.tobytes()


def tiny(percent: int) -> int:
    """The largest size whose similar sets must be equal: one token more or less is already too much."""
    n = 1
    while 100 * n < percent * (n + 1):
        n += 1
    return n - 1


def entries(docs: DataFrame, table: bytes, min_tokens: int, percent: int) -> DataFrame:
    """One row per distinct line text: h1, h2, first place (at), occurrences, size n, signature, prefix keys (32 bits of the prefix tokens)."""
    lit = F.lit(table)
    low = line_rows(docs).select(F.struct("doc", "th", "line_no").alias("at"), F.xxhash64("line").alias("h1"),
                                 F.xxhash64("line", F.lit(1)).alias("h2"), words_of(F.col("line")).alias("w"), F.length("line").alias("chars")) \
        .where(F.col("chars") >= 2 * min_tokens - 1)  # a shorter line cannot hold so many words

    def token(w):
        h = F.xxhash64(w)
        cls = F.ascii(F.substring(lit, F.pmod(h, F.lit(BUCKETS)).cast("int") + 1, F.lit(1)).cast("string"))
        return F.when(w != "", F.shiftleft(cls.cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8)))

    rows = low.select("at", "h1", "h2", F.array_sort(F.array_distinct(F.array_compact(F.transform("w", token)))).alias("t"))
    n = F.size("t")
    one = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x.bitwiseAND(63).cast("int"))

    # parities of 128 classes: the first 64 and the others
    flip = lambda half: lambda a, x: F.when(x.bitwiseAND(64) == half, a.bitwiseXOR(one(x))).otherwise(a)
    odd = lambda half: F.aggregate("t", F.lit(0).cast("long"), flip(half))
    head = F.transform(F.slice("t", 1, n - F.ceil(n * percent / 100).cast("int") + 1), lambda x: x.bitwiseAND(0x7FFFFFFF).cast("int"))
    whole = F.xxhash64("t").bitwiseAND(0x7FFFFFFF).cast("int")
    head = F.when(n <= tiny(percent), F.array(whole)).otherwise(head)
    rows = rows.select("at", "h1", "h2", n.alias("n"), odd(0).alias("odd"), odd(64).alias("odd2"), head.alias("head"))
    found = rows.groupBy("h1", "h2").agg(F.min("at").alias("at"), F.count(F.lit(1)).alias("times"), F.first("n").alias("n"), F.first("odd").alias("odd"), F.first("odd2").alias("odd2"), F.first("head").alias("head"))
    return found.where(F.col("n") >= min_tokens)  # after the aggregate, so that the tokens are not built twice for it


def possible(percent: int) -> Column:
    """Length, positional and parity filters over the columns of ``_sides``: whether two entries with one prefix key can still be similar enough.

    The parities count tokens in 128 classes modulo 2; the sets differ in at least as many tokens as the parities do.
    """
    a, b, t = F.col("na"), F.col("nb"), percent
    most = F.least("pa", "pb") + 1 + F.least(a - F.col("pa") - 1, b - F.col("pb") - 1)
    differ = F.bit_count(F.col("oa").bitwiseXOR(F.col("ob"))) + F.bit_count(F.col("ea").bitwiseXOR(F.col("eb")))
    return (100 * F.least(a, b) >= t * F.greatest(a, b)) & ((100 + t) * differ <= (100 - t) * (a + b)) & ((100 + t) * most >= t * (a + b))


def similar(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b) of the pairs of entries (by h1) whose word sets reach the threshold."""
    ends = saved(pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct(), "ends")
    lines = line_rows(docs).select(F.xxhash64("line").alias("key"), F.xxhash64("line", F.lit(1)).alias("h2"), "line")
    # the filter alone decides which lines travel: the planner would push a semi-join below it and shuffle every line.
    # Lines travel as they are, since an array of words is three times as wide
    blocks = max(BLOCKS, min(4 * BLOCKS, ends.count() // 16))
    lines = possible_hits(lines, bloom_filter(ends, blocks), blocks).groupBy("key", "h2").agg(F.first("line").alias("line"))
    lines = saved(lines.select("key", "line"), "lines-met")
    both = pairs.join(lines.select(F.col("key").alias("a"), F.col("line").alias("la")), "a").join(lines.select(F.col("key").alias("b"), F.col("line").alias("lb")), "b")
    words = lambda c: F.array_remove(F.array_distinct(words_of(F.col(c))), "")
    # rows of their own (outer explode of one array), so that the sets are made once
    both = both.select("a", "b", F.explode_outer(F.array(F.struct(words("la").alias("wa"), words("lb").alias("wb")))).alias("w"))
    common = F.size(F.array_intersect("w.wa", "w.wb"))
    return both.where(100 * common >= percent * (F.size("w.wa") + F.size("w.wb") - common)).select("a", "b")


def losers(lines: DataFrame, found: DataFrame) -> DataFrame:
    """(h1) of the later entry of every found pair."""
    place = lines.select("h1", "at")
    f = found.join(place.select(F.col("h1").alias("a"), F.col("at").alias("at_a")), "a").join(place.select(F.col("h1").alias("b"), F.col("at").alias("at_b")), "b")
    return f.select(F.when(F.col("at_a") > F.col("at_b"), F.col("a")).otherwise(F.col("b")).alias("h1")).distinct()


def _sides(x: DataFrame, y: DataFrame, keys: list) -> DataFrame:
    def side(df, end):
        return df.select(*keys, F.col("h1").alias(f"h{end}"), F.col("n").alias(f"n{end}"), F.col("pos").alias(f"p{end}"),
                         F.col("odd").alias(f"o{end}"), F.col("odd2").alias(f"e{end}"))
    return side(x, "a").join(side(y, "b"), keys)


def _met(pairs: DataFrame, order: Column, percent: int) -> DataFrame:
    """Distinct (a, b), the smaller h1 first, of the joined postings that can be similar."""
    met = pairs.where(order).where(possible(percent))
    return met.select(F.least("ha", "hb").alias("a"), F.greatest("ha", "hb").alias("b")).distinct()


def shared_least(percent: int, na: Column, nb: Column) -> Column:
    """How many prefix tokens two similar sets share at least.

    With an overlap of o, the k-th common token stands at most n - o places further back than k in a set, so common tokens
    up to the (prefix length - (n - o))-th are in both prefixes.
    """
    o = F.ceil((na + nb) * percent / (100 + percent))
    return o + 1 - F.ceil(F.greatest(na, nb) * percent / 100)


def _cold_pairs(cold: DataFrame, percent: int, counted: bool) -> DataFrame:
    """Possible pairs (a, b) of entries that share a token, the larger set as a; with ``counted``, that share as many as similar sets must.

    Sizes fall into classes a factor of 1 / threshold wide, so a similar smaller set is in the same class or the one below:
    it comes once for either. The classes are made behind the exchange by token, which the join keeps.
    """
    width = math.log(100 / percent) * (1 + 1e-9) if percent < 100 else 1e-9
    size_class = F.floor(F.log(F.col("n").cast("double")) / width).cast("int")
    x = cold.withColumn("class", size_class)
    y = cold.withColumn("class", F.explode(F.array(size_class, size_class + 1)))
    larger = (F.col("na") > F.col("nb")) | ((F.col("na") == F.col("nb")) & (F.col("ha") > F.col("hb")))
    met = _sides(x, y, ["token", "class"]).where(larger).where(possible(percent))
    pairs = met.groupBy(F.col("ha").alias("a"), F.col("hb").alias("b"), "na", "nb").agg(F.count(F.lit(1)).alias("shared"))
    return pairs.where(F.col("shared") >= shared_least(percent, F.col("na"), F.col("nb")) if counted else F.lit(True)).select("a", "b")


def later_matches(docs: DataFrame, lines: DataFrame, percent: int) -> DataFrame:
    """(h1) of the entries that have an earlier similar entry. lines: the saved entries."""
    post = lines.select(F.posexplode("head").alias("pos", "token"), "h1", "n", "odd", "odd2").where("n is not null")
    often = lines.select(F.explode("head").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("_size")).where(F.col("_size") > HOT)
    often = saved(often.select("token"), "hot-tokens")
    none = often.isEmpty()
    sized = post.repartition("token").withColumn("_size", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("_size > 1")
    with partitioned_by_part_of_keys(docs.sparkSession):
        # where some tokens are dealt with apart, pairs share tokens that are not counted here
        pairs = saved(_cold_pairs(sized.where(F.col("_size") <= HOT).drop("_size"), percent, none), "pairs")
    if not none:
        hot = saved(post.join(often, "token"), "hot")
        other = F.col("ha") != F.col("hb")
        place = lines.select("h1", F.col("at.doc").alias("_doc"))
        first = hot.join(place, "h1").groupBy("token").agg(F.min(F.struct("_doc", "h1", "n", "pos", "odd", "odd2")).alias("p")).select("token", "p.*").drop("_doc")
        met = saved(_met(_sides(hot, first, ["token"]), other, percent), "hot-first")
        gone = saved(losers(lines, similar(docs, met, percent)), "hot-gone")
        rest = hot.join(gone, "h1", "left_anti")
        # a pair of two entries that are both left over is met from both sides; one of them, from one
        pairs = saved(pairs.unionByName(_met(_sides(rest, hot, ["token"]), other, percent)).distinct(), "pairs")
        return losers(lines, similar(docs, pairs, percent)).unionByName(gone).distinct()
    return losers(lines, similar(docs, pairs, percent))


def removed_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS, percent: int = PERCENT) -> DataFrame:
    """(doc, th, removed): the numbers of the lines that go, per document text that loses any."""
    docs = docs.select("doc_id", "text")
    lines = saved(entries(docs, rarity(docs), min_tokens, percent), "lines")
    gone = saved(later_matches(docs, lines, percent), "gone")
    # only entries that go or that occur again decide about a line; a fixed-size filter keeps the others' lines in place
    first = lines.select("h1", "h2", "at", "times").join(gone.withColumn("gone", F.lit(True)), "h1", "left")
    first = saved(first.where("times > 1 OR gone").select(F.col("h1").alias("key"), "h2", "at", F.coalesce("gone", F.lit(False)).alias("gone")), "decided")
    rows = line_rows(docs).select("doc", "th", "line_no", F.xxhash64("line").alias("key"), F.xxhash64("line", F.lit(1)).alias("h2"))
    rows = possible_hits(rows, bloom_filter(first.select("key"), BLOCKS), BLOCKS)
    out = rows.join(first, ["key", "h2"]).where(F.col("gone") | (F.struct("doc", "th", "line_no") != F.col("at")))
    return out.groupBy("doc", "th").agg(F.array_sort(F.collect_set("line_no")).alias("removed"))


def dedup_lines(docs: DataFrame, min_tokens: int = MIN_TOKENS, percent: int = PERCENT, clean: str = "clean", removed: str = "removed") -> DataFrame:
    """The rows of docs (any columns) with ``clean`` (text without the lines that go) and ``removed`` (their numbers).

    The two names are the caller's; a column of docs that has one of them is an error.
    """
    clash = {clean, removed} & set(docs.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are what the operator adds; name them otherwise")
    given = docs.select(*[docs[c].alias(f"c{i}") for i, c in enumerate(docs.columns)])
    at = {c: F.col(f"c{i}") for i, c in enumerate(docs.columns)}
    gone = removed_lines(docs, min_tokens, percent).select(F.col("doc").alias("_doc"), F.col("th").alias("_th"), F.col("removed").alias("_gone"))
    on = (F.coalesce(at["doc_id"].cast("long"), F.lit(LAST)) == F.col("_doc")) & (F.xxhash64(at["text"]) == F.col("_th"))
    kept = F.array_join(F.filter(F.split(at["text"], "\n"), lambda s, i: ~F.array_contains(F.col("_gone"), i)), "\n")
    out = given.join(gone, on, "left").select(*at.values(), F.when(F.col("_gone").isNull(), at["text"]).otherwise(kept).alias("x0"),
                                              F.coalesce("_gone", F.array().cast("array<int>")).alias("x1"))
    return out.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)], F.col("x0").alias(clean), F.col("x1").alias(removed))
