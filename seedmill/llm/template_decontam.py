r"""Benchmark decontamination by template canonicalisation.

A text becomes a sequence of template tokens: numbers, names (capitalised words inside a sentence,
adjacent ones together) and units after a number turn into the typed placeholders ``<num>``,
``<name>``, ``<unit>``; other words are lower-cased, punctuation goes. A re-parameterised question
so has the template of its original.

1. Windows of ``WINDOW`` template tokens of all documents are hashed and joined with those of the
   benchmark, and so are windows of plain lower-cased words, since names are only seen in the
   item's own case: a literal copy matches in any case and spacing. The benchmark's side is broadcast when its counted size is small; beyond that a
   blocked Bloom filter of fixed size thins the documents' windows before a shuffled join.
2. Per document and item the distinct windows of the item that were found are counted; at
   ``percent`` or more of them the pair is a candidate, with its commonest offset.
3. Slot consistency: along that offset, names must map the item's to the document's one to one
   (the same name may not stand for two); numbers and units are independent slots. Without that a
   match of templates is an accident and is reported as inconsistent.

Items of fewer than ``WINDOW`` tokens have one window, the whole item; the documents' windows of
those few lengths are joined too.

Defined cases: null and empty texts have no windows and match nothing; repeated documents each
match; a null doc_id is matched like any other; repeated items match each on its own, rows with
equal item_id and text count once; extra columns are ignored; empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .url_filter import bloom_filter, possible_hits

WINDOW, PERCENT, BLOCKS = 5, 80, 1 << 16
SMALL_ROWS = 200_000  # benchmark windows that are broadcast: 40 bytes each, 8 MB
#: Units that a number may carry.
UNITS = ["%", "c", "cm", "cents", "days", "degrees", "dollars", "euros", "f", "feet", "ft", "g", "gallons", "grams", "hours", "hz", "inches", "kg", "kilograms",
         "kilometers", "kilometres", "km", "kph", "l", "lb", "lbs", "liters", "litres", "m", "meters", "metres", "mg", "miles", "min", "minutes", "ml", "mm",
         "months", "mph", "oz", "percent", "pounds", "s", "seconds", "weeks", "yards", "years"]
_NAME, _JOIN, _UNIT = "\x01", "\x02", "\x04"


# Looks for what is to change alone: runs, and single marks and white space other than a space.
_GAPS = "[\t\n\x0B\f\r\x01-\x04][\\s\x01-\x04]*| [\\s\x01-\x04]+"


def _split(t: Column) -> Column:
    """The words of a text whose white space is spaces."""
    return F.array_remove(F.split(t, " "), "")


def marked_words(text: Column) -> Column:
    """Words in order; names start with a name mark (adjacent ones joined), units with a unit mark."""
    t = F.regexp_replace(text, _GAPS, " ")
    # the letter is looked for first: few places go on to look back
    t = F.regexp_replace(t, r"(?=\p{Lu})(?<=[\p{Ll}\p{N},;:] )(\p{Lu})", f"{_NAME}$1")
    t = F.regexp_replace(t, f"({_NAME}[^\\s.!?;:,]+) (?={_NAME})", f"$1{_JOIN}")
    t = F.regexp_replace(t, r"(?i)(\p{N})( ?)(" + "|".join(sorted(UNITS, key=len, reverse=True)) + r")(?![\p{L}\p{N}])", f"$1 {_UNIT}$3")
    return _split(F.regexp_replace(t, r"[^a-z\sA-Z0-9\p{L}\p{N}\x01-\x04%]+", ""))


def plain_words(text: Column) -> Column:
    """Lower-cased words in order, without punctuation."""
    t = F.regexp_replace(F.lower(text), _GAPS, " ")
    return _split(F.regexp_replace(t, r"[^a-z\s0-9\p{L}\p{N}%]+", ""))


def _head(w: Column) -> Column:
    return F.ascii(w)


def template(w: Column) -> Column:
    """Template token of a marked word."""
    c = _head(w)
    return F.when(c == 1, F.lit("<name>")).when(c == 4, F.lit("<unit>")).when(c.between(48, 57), F.lit("<num>")).otherwise(F.lower(w))


def is_slot(w: Column) -> Column:
    c = _head(w)
    return (c == 1) | (c == 4) | c.between(48, 57)


def windows(words: DataFrame, keep: list[str], size: int, kind: int) -> DataFrame:
    """(keep..., pos, wh) of all windows of ``size`` tokens: of the templates of ``words`` (kind 0) or of ``plain`` (kind 1)."""
    h = words.select(*keep, (F.transform("plain", lambda w: F.xxhash64(w)) if kind else F.transform("words", lambda w: F.xxhash64(template(w)))).alias("h"))
    w = h.select(*keep, F.when(F.size("h") >= size, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("h") - size, F.lit(0))),
        lambda i: F.xxhash64(*[F.get("h", i + j) for j in range(size)], F.lit(size), F.lit(kind)))).alias("w"))
    # the outer form: the planner would add a filter on the array's size below, and compute the array twice
    return w.select(*keep, F.posexplode_outer("w").alias("pos", "wh")).where("pos is not null")


def find_leaks(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, percent: int = PERCENT) -> DataFrame:
    """(doc_id, text_hash, item_id, matched, windows, at, slots, consistent, literal) per document and benchmark item at or over the share.

    at: word place in the document where the item starts; slots: placeholders compared there; consistent: the template
    matches and its names map one to one; literal: the plain words match. Where the template does not, matched, windows
    and at are those of the plain words, without slots.
    """
    d = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    both = [marked_words(F.coalesce("text", F.lit(""))).alias("words"), plain_words(F.coalesce("text", F.lit(""))).alias("plain")]
    words = d.select("doc_id", "text_hash", *both)
    items = benchmark.select("item_id", "text").where("text is not null").distinct() \
        .select("item_id", F.xxhash64("text").alias("item_hash"), *both).where("size(words) > 0")
    items = saved(items, "items")
    given, have = [], []
    for kind, column in enumerate(("words", "plain")):
        short = [r["n"] for r in items.where(F.size(column) < window).select(F.size(column).alias("n")).distinct().collect()]
        for n in [window, *short]:
            own = items if n == window else items.where(F.size(column) == n)
            given.append(windows(own, ["item_id", "item_hash"], n, kind).withColumn("kind", F.lit(kind)))
            # only one row per document and window hash reaches the join side that counts
            have.append(windows(words, ["doc_id", "text_hash"], n, kind))
    given = saved(reduce(DataFrame.unionByName, given).withColumnRenamed("pos", "item_pos"), "item_windows")
    total = given.groupBy("item_id", "item_hash", "kind").agg(F.count("*").alias("windows"))
    have = reduce(DataFrame.unionByName, have)
    keys = given.select(F.col("wh").alias("key")).distinct()
    if given.count() <= SMALL_ROWS:
        hits = have.join(F.broadcast(given), "wh")
    else:
        thin = possible_hits(have.withColumnRenamed("wh", "key"), bloom_filter(keys, BLOCKS), BLOCKS)
        hits = thin.withColumnRenamed("key", "wh").join(given, "wh")
    pair = ["doc_id", "text_hash", "item_id", "item_hash"]
    along = hits.groupBy(*pair, "kind", (F.col("pos") - F.col("item_pos")).alias("at")) \
        .agg(F.collect_set("item_pos").alias("found"), F.count("*").alias("n"))
    per = along.groupBy(*pair, "kind").agg(F.size(F.array_distinct(F.flatten(F.collect_list("found")))).alias("matched"),
                                   F.max(F.struct("n", (-F.col("at")).alias("back"))).alias("best"))
    cand = per.join(total, ["item_id", "item_hash", "kind"]).where(100 * F.col("matched") >= percent * F.col("windows")) \
        .groupBy(*pair).agg(F.min(F.struct("kind", "matched", "windows", (-F.col("best.back")).cast("int").alias("at"))).alias("c"), (F.max("kind") == 1).alias("literal"))
    cand = saved(cand.select(*pair, "c.*", "literal"), "candidates")
    # the words of the candidates' documents alone: a Bloom filter picks their rows before the join
    want = cand.select(F.col("text_hash").alias("key")).distinct()
    rows = possible_hits(d.select("doc_id", F.col("text_hash").alias("key"), "text"), bloom_filter(want, BLOCKS), BLOCKS)
    rows = rows.join(want, "key", "left_semi").select(F.col("key").alias("text_hash"), "text").groupBy("text_hash").agg(F.first("text").alias("text"))
    rows = rows.select("text_hash", marked_words(F.col("text")).alias("dw"))
    full = cand.join(rows, "text_hash").join(items.select("item_id", "item_hash", F.col("words").alias("iw")), ["item_id", "item_hash"])
    steps = F.filter(F.sequence(F.lit(0), F.size("iw") - 1), lambda k: is_slot(F.get("iw", k)))
    pairs = F.transform(steps, lambda k: F.struct(F.lower(F.get("iw", k)).alias("i"), F.lower(F.get("dw", k + F.col("at"))).alias("d"),
                                                  (_head(F.get("iw", k)) == 1).alias("name"), (template(F.get("iw", k)) == template(F.get("dw", k + F.col("at")))).alias("ok")))
    full = full.withColumn("p", F.when(F.col("kind") == 0, F.filter(pairs, lambda p: p["ok"])).otherwise(F.filter(pairs, lambda p: F.lit(False))))
    full = full.withColumn("names", F.filter("p", lambda p: p["name"]))
    maps = F.size(F.array_distinct(F.transform("names", lambda p: F.struct(p["i"].alias("i"), p["d"].alias("d")))))
    one_to_one = (maps == F.size(F.array_distinct(F.transform("names", lambda p: p["i"])))) & (maps == F.size(F.array_distinct(F.transform("names", lambda p: p["d"]))))
    return full.select("doc_id", "text_hash", "item_id", "matched", F.col("windows").cast("int").alias("windows"), "at",
                       F.size("p").alias("slots"), ((F.col("kind") == 0) & one_to_one).alias("consistent"), "literal")
