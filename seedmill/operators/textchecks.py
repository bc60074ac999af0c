"""Contracts of free-text answers (V32-V37), one row each, JVM string and array functions only.

Each check adds ``violations`` (codes in a fixed order); a null answer reads as the empty text.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedmill.functions.text import py_strip


def _text(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(""))


def _codes(df: DataFrame, checks: list[tuple[str, Column]]) -> DataFrame:
    return df.withColumn("violations", F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(True)), F.lit(code)) for code, c in checks])))


def _fold(c: Column) -> Column:
    return F.lower(F.regexp_replace(py_strip(c), r"\s+", " "))


# V32 ---------------------------------------------------------------------------
def parse_qa_pairs(df: DataFrame, text: str, least: int = 2, most: int = 4) -> DataFrame:
    """Adds ``pairs`` (array<struct<n, question, answer>>) and ``violations``.

    Codes: preamble (text before ``Q1:``), pair_count, bad_numbering (not 1..n, or a question without the answer
    of its number), empty_part, repeated_question, label_inside (a label within a line of a part).
    """
    t = F.concat(F.lit("\n"), F.regexp_replace(_text(text), "\r\n", "\n"))
    parts = F.split(t, r"\n(?=[QA]\d+:)")
    marked = F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda x: F.struct(
        F.substring(x, 1, 1).alias("kind"), F.regexp_extract(x, r"^[QA](\d+):", 1).try_cast("int").alias("n"),
        py_strip(F.regexp_replace(x, r"^[QA]\d+:", "")).alias("body")))
    d = df.withColumn("_pre", py_strip(parts[0])).withColumn("_m", marked)
    q, a = F.filter("_m", lambda m: m["kind"] == "Q"), F.filter("_m", lambda m: m["kind"] == "A")
    d = d.withColumn("_q", q).withColumn("_a", a)
    d = d.withColumn("pairs", F.filter(F.zip_with("_q", "_a", lambda x, y: F.struct(x["n"].alias("n"), x["body"].alias("question"), y["body"].alias("answer"))),
                                       lambda p: p["question"].isNotNull() & p["answer"].isNotNull()))
    order = F.transform("_m", lambda m, i: (m["kind"] == F.when(i % 2 == 0, F.lit("Q")).otherwise(F.lit("A"))) & (m["n"] == F.floor(i / 2) + 1))
    folded = F.transform("_q", lambda m: _fold(m["body"]))
    d = _codes(d, [("preamble", F.col("_pre") != ""), ("pair_count", ~F.size("_q").between(least, most)),
                   ("bad_numbering", (F.size("_q") != F.size("_a")) | F.exists(order, lambda x: ~F.coalesce(x, F.lit(False)))),
                   ("empty_part", F.exists("_m", lambda m: m["body"] == "")), ("repeated_question", F.size(F.array_distinct(folded)) < F.size(folded)),
                   ("label_inside", F.exists("_m", lambda m: m["body"].rlike(r"\b[QA]\d+:")))])
    return d.drop("_pre", "_m", "_q", "_a")


# V33 ---------------------------------------------------------------------------
def check_cot_sets(df: DataFrame, text: str, label: str = r"Question \d+:", least: int = 2, most: int = 3) -> DataFrame:
    """Adds ``sets`` and ``violations``. The request's format is a parameter: ``label`` is the pattern that opens a set.

    Codes: preamble, set_count, empty_set (nothing after its first line), repeated_question (equal first lines).
    """
    t = F.concat(F.lit("\n"), F.regexp_replace(_text(text), "\r\n", "\n"))
    parts = F.split(t, rf"\n(?={label})")
    bodies = F.transform(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), lambda x: py_strip(F.regexp_replace(x, f"^{label}", "")))
    d = df.withColumn("sets", bodies).withColumn("_pre", py_strip(parts[0]))
    first = F.transform("sets", lambda x: _fold(F.substring_index(x, "\n", 1)))
    rest = F.transform("sets", lambda x: F.when(F.contains(x, F.lit("\n")), py_strip(F.regexp_extract(x, r"(?s)^[^\n]*\n(.*)$", 1))).otherwise(F.lit("")))
    d = _codes(d, [("preamble", F.col("_pre") != ""), ("set_count", ~F.size("sets").between(least, most)),
                   ("empty_set", F.exists(rest, lambda x: x == "")), ("repeated_question", F.size(F.array_distinct(first)) < F.size(first))])
    return d.drop("_pre")


# V34 ---------------------------------------------------------------------------
def check_content_block(df: DataFrame, text: str) -> DataFrame:
    """Adds ``content`` and ``violations``: no_block, many_blocks, outside_text, empty_block."""
    t = _text(text)
    opens, closes = F.size(F.split(t, "<CONTENT>")) - 1, F.size(F.split(t, "</CONTENT>")) - 1
    inside = F.regexp_extract(t, r"(?s)<CONTENT>(.*)</CONTENT>", 1)
    one = (opens >= 1) & (closes >= 1)
    around = py_strip(F.regexp_replace(t, r"(?s)<CONTENT>.*</CONTENT>", ""))
    d = df.withColumn("content", F.when(one, py_strip(inside)))
    return _codes(d, [("no_block", ~one), ("many_blocks", (opens > 1) | (closes > 1)), ("outside_text", one & (around != "")),
                      ("empty_block", one & (py_strip(inside) == ""))])


# V35 ---------------------------------------------------------------------------
def outline_flags(df: DataFrame, text: str) -> DataFrame:
    """Adds ``units``, ``ok_units``, ``flagged_units``, ``unresolved`` (numbers of flagged units) and ``violations``.

    Units are parted by empty lines. A unit is marked with ``[OK]`` or with ``^^^``. Codes: no_units, unmarked_unit, both_marks, unresolved.
    """
    t = F.regexp_replace(_text(text), "\r\n", "\n")
    units = F.filter(F.transform(F.split(t, r"\n[ \t]*\n"), lambda u: py_strip(u)), lambda u: u != "")
    d = df.withColumn("_u", units)
    ok, flag = lambda u: F.contains(u, F.lit("[OK]")), lambda u: F.contains(u, F.lit("^^^"))
    numbers = F.array_compact(F.transform("_u", lambda u, i: F.when(flag(u), i + 1)))
    d = d.withColumn("units", F.size("_u")).withColumn("ok_units", F.size(F.filter("_u", ok))).withColumn("unresolved", numbers) \
        .withColumn("flagged_units", F.size("unresolved"))
    return _codes(d, [("no_units", F.col("units") == 0), ("unmarked_unit", F.exists("_u", lambda u: ~ok(u) & ~flag(u))),
                      ("both_marks", F.exists("_u", lambda u: ok(u) & flag(u))), ("unresolved", F.col("flagged_units") > 0)]).drop("_u")


# V36 ---------------------------------------------------------------------------
def style_phrases(df: DataFrame, key: str, text: str, phrases: DataFrame) -> DataFrame:
    """(key, found): the caller's phrases (phrase, place, kind) that an answer uses, as sorted ``kind:phrase``.

    place: ``opening`` (the answer starts with it) or ``anywhere`` (as whole words). The phrase table is a parameter of a few dozen
    rows; it becomes one array literal, so that the answers are neither joined nor shuffled.
    """
    rows = phrases.select("phrase", "place", "kind").where("phrase is not null and phrase <> ''").distinct().orderBy("kind", "phrase").collect()
    # the text is lowered once and its words are parted once; an opening is looked for at the start alone
    t, words = F.col("_low"), F.col("_words")
    d = df.select(key, F.lower(py_strip(_text(text))).alias("_low"))
    if any(r["place"] != "opening" for r in rows):
        d = d.withColumn("_words", F.concat(F.lit(" "), F.regexp_replace(t, r"[^\p{L}\p{N}']+", " "), F.lit(" ")))
    hits = []
    for r in rows:
        p = r["phrase"].lower().split()
        if r["place"] == "opening":
            hit = t.rlike("^" + r"\s+".join(re.escape(x) for x in p) + r"(?![\p{L}\p{N}])")
        else:
            hit = words.contains(" " + _plain(" ".join(p)) + " ")
        hits.append(F.when(hit, F.lit(f"{r['kind']}:{r['phrase']}")))
    found = F.array_compact(F.array(*hits)) if hits else F.array().cast("array<string>")
    return d.select(key, found.alias("found"))


def _plain(p: str) -> str:
    return " ".join(re.sub(r"[^\w']+", " ", p).split())


# V37 ---------------------------------------------------------------------------
def check_question_form(df: DataFrame, text: str, question: bool = True) -> DataFrame:
    """Adds ``first_sentence`` and ``violations``: empty, not_a_question (question asked for), is_question (a claim asked for), no_answer, labelled."""
    t = py_strip(_text(text))
    d = df.withColumn("first_sentence", py_strip(F.regexp_extract(t, r"(?s)^(.*?[.!?]+[\"”')\]]*)(?:\s|$)", 1)))
    first = F.when(F.col("first_sentence") == "", t).otherwise(F.col("first_sentence"))
    ends = first.rlike(r"\?+[\"”')\]]*$")
    return _codes(d.withColumn("first_sentence", first), [
        ("empty", t == ""), ("not_a_question", (t != "") & ~ends & F.lit(question)), ("is_question", ends & F.lit(not question)),
        ("no_answer", (t != "") & (py_strip(F.substr(t, F.length(first) + 1)) == "")),
        ("labelled", t.rlike(r"(?im)^(Q|A|Question|Answer|Misconception|Correction)\d*:"))])
