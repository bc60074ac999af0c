"""Filter interaction audit: what each of k filters removes, in every order of them, per part of the corpus.

Method: forward-backward path counting on the subset lattice. A state is the set of filters already
applied, an edge applies one more. A document takes part through its failure mask alone (one bit a
filter), so one pass over the corpus leaves at most 2^k counted cells a part, and each of the k*2^(k-1)
edges is a sum over those cells. Counting the orders that reach a state and those that leave it
weighs the edges: removed * reaching * leaving, summed over a filter's edges, is that filter's total
over all k! orders (its Shapley value times k!). A step of one order is read from the same edges.

Defined results: a null text is an empty one; a null part is the empty string; an empty table gives no
row; rows that repeat a doc_id count as rows of their own; a null doc_id is not smaller than any other,
and no other is smaller than it, so such a row is never a copy and has no label; of several labels of a
document any 1 counts. Texts of any length are read whole. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import rows, text_or_empty

MAX_FILTERS = 7  # 7! orders of 7 steps are rows of a result a person can still read
SPACE = "\x20\x09-\x0D"


def quality_filters() -> dict[str, Column]:
    """Failure conditions on a text in column ``_text``, in the letters of their filters; E (copies) is added by ``audit``."""
    words = F.filter(F.split("_text", f"[{SPACE}]+"), lambda w: w != "")
    n, chars = F.col("_words"), F.length("_text")
    return {
        "_words": F.size(words), "_distinct": F.size(F.array_distinct(words)),
        "A": n < 200,
        "B": 100 * F.col("_distinct") < 50 * n,
        "C": 100 * (chars - F.length(F.translate("_text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))) > 3 * chars,
        "D": F.col("_text").rlike(r"[#$%&*|]"),
    }


def lattice(k: int) -> list[tuple[int, int, int, int]]:
    """Edges (state before, filter, orders reaching the state, orders leaving the state after), counted along the edges."""
    full = (1 << k) - 1
    reach, leave = {0: 1}, {full: 1}
    for s in range(1, full + 1):
        reach[s] = sum(reach[s ^ (1 << f)] for f in range(k) if s >> f & 1)
    for s in range(full - 1, -1, -1):
        leave[s] = sum(leave[s | 1 << f] for f in range(k) if not s >> f & 1)
    return [(s, f, reach[s], leave[s | 1 << f]) for s in range(full) for f in range(k) if not s >> f & 1]


def cells(docs: DataFrame, labels: DataFrame, part: str = "lang", letters: str = "ABCDE", copies: str = "E") -> DataFrame:
    """(part, mask, n, good, toxic): documents by part and failure mask, with those labelled good or toxic.

    Filters but ``copies`` depend on the text alone. A text's copies share its digest: they are counted by
    (digest, part) before the shuffle, with the smallest doc_id beside the counts, so a text of a third of all
    rows is one row a task. The least doc_id of a digest over its parts then tells the one document that stays.
    """
    tests = quality_filters()
    bit = {c: 1 << i for i, c in enumerate(letters)}
    read = docs.select(F.col("doc_id").cast("long").alias("_id"), text_or_empty(docs["text"]).alias("_text"),
                       F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"))
    read = read.select("*", tests["_words"].alias("_words"), tests["_distinct"].alias("_distinct"))
    mask = reduce(lambda a, b: a + b, [F.when(tests[c], bit[c]).otherwise(0) for c in letters if c != copies])
    seen = read.select("_id", "part", F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_text_key"), mask.alias("mask"))
    flags = labels.select(F.col("doc_id").cast("long").alias("_label"), "quality", "toxic").where("_label is not null")
    flags = flags.groupBy("_label").agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("int")).alias("good"),
                                        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("int")).alias("toxic"))
    told = seen.join(flags, seen["_id"] == flags["_label"], "left")
    told = told.select("_id", "part", "_text_key", "mask", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])

    # rows of one (digest, part): totals, totals of rows without an id, and the rows of the least id (2 bits of flags)
    nameless = F.col("_id").isNull()
    count = lambda c, when=None: F.sum(F.when(when, c).otherwise(0) if when is not None else c)
    texts = told.groupBy("_text_key", "part", "mask", "_id").agg(F.count("*").alias("n"), F.max("good").alias("good"), F.max("toxic").alias("toxic"))
    texts = texts.groupBy("_text_key", "part", "mask").agg(
        count(F.col("n")).alias("n"), count(F.col("n") * F.col("good")).alias("good"), count(F.col("n") * F.col("toxic")).alias("toxic"),
        count(F.col("n"), nameless).alias("free"), F.min("_id").alias("low"),
        F.min_by(F.col("n") * 4 + F.col("good") * 2 + F.col("toxic"), "_id").alias("low_row"))
    least = F.min("low").over(Window.partitionBy("_text_key"))
    texts = texts.select("*", (F.col("low") == least).alias("first"))
    low_n = F.when(F.col("first"), F.shiftright("low_row", 2)).otherwise(0)
    low_good = F.when(F.col("first"), low_n * F.shiftright("low_row", 1).bitwiseAND(1)).otherwise(0)
    low_toxic = F.when(F.col("first"), low_n * F.col("low_row").bitwiseAND(1)).otherwise(0)
    kept = [(F.col("free") + F.coalesce(low_n, F.lit(0))), F.coalesce(low_good, F.lit(0)), F.coalesce(low_toxic, F.lit(0))]
    both = F.array(F.struct(F.col("mask"), kept[0].alias("n"), kept[1].alias("good"), kept[2].alias("toxic")),
                   F.struct((F.col("mask") + bit[copies]).alias("mask"), (F.col("n") - kept[0]).alias("n"),
                            (F.col("good") - kept[1]).alias("good"), (F.col("toxic") - kept[2]).alias("toxic")))
    split = texts.select("part", F.explode(both).alias("c")).select("part", "c.*").where("n > 0")
    return split.groupBy("part", "mask").agg(*[F.sum(c).cast("long").alias(c) for c in ("n", "good", "toxic")])


def edge_counts(counted: DataFrame, letters: str) -> DataFrame:
    """Per part and lattice edge: kept, removed, redundant, unique_fails, good_lost, toxic_lost, and the filter's shapley.

    ``counted`` holds at most 2^k cells a part; each meets the k*2^(k-1) edges through its mask (a hash join
    with a table whose size depends on k alone).
    """
    k = len(letters)
    edges = lattice(k)
    met = [(m, s, f, reach * leave, int(m & (s | 1 << f) == 0), int(m & s == 0 and m >> f & 1), int(m & s != 0 and m >> f & 1), int(m == 1 << f))
           for m in range(1 << k) for s, f, reach, leave in edges]
    spark = counted.sparkSession
    table = rows(spark, met, "mask int, state int, filter int, orders long, stays int, goes int, again int, alone int")
    total = lambda flag, c, name: F.sum(F.col(flag) * F.col(c)).alias(name)
    by_edge = counted.join(F.broadcast(table), "mask").groupBy("part", "state", "filter", "orders").agg(
        total("stays", "n", "kept"), total("goes", "n", "removed"), total("again", "n", "redundant"), total("alone", "n", "unique_fails"),
        total("goes", "good", "good_lost"), total("goes", "toxic", "toxic_lost"))
    weighed = F.sum(F.col("orders") * F.col("removed")).over(Window.partitionBy("part", "filter"))
    return by_edge.withColumn("shapley", weighed)


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang", letters: str = "ABCDE") -> DataFrame:
    """One row per part, order of the filters and step; the step's figures are those of its edge."""
    if len(letters) > MAX_FILTERS:
        raise ValueError(f"{len(letters)} filters have {len(letters)}! orders; {MAX_FILTERS} are allowed")
    steps = [("".join(letters[f] for f in order), i + 1, sum(1 << f for f in order[:i]), f)
             for order in permutations(range(len(letters))) for i, f in enumerate(order)]
    table = rows(docs.sparkSession, steps, "filter_order string, step int, state int, filter int")
    edges = edge_counts(cells(docs, labels, part, letters), letters)
    return edges.join(F.broadcast(table), ["state", "filter"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
