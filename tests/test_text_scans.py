from pyspark.sql import functions as F

from seedmill.operators import household as hh
from seedmill.operators import sections as se
from seedmill.operators import textchecks as tx


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_codes_are_found_without_a_lambda(spark):
    df = spark.createDataFrame([("A: x\nB: y\nB: z",), ("B: y\nA: x",), ("A: x",)], "t string")
    out = se.check_sections(df, "t", ["A", "B"])
    assert "lambda" not in plan(out)
    assert [r["violations"] for r in out.collect()] == [["duplicate:B"], ["out_of_order"], ["missing:B"]]


def test_section_bodies_end_at_the_next_label(spark):
    texts = ["Step 0 — Immediate Action: a\nb\n\nLikely Cause:\nDIY Response: c\n", "x\nLikely Cause: one\nLikely Cause: two", "none", ""]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    got = [tuple(r) for r in df.select(*[hh.body(F.col("t"), "h2", x) for x in hh.LABELS["h2"][:3]]).collect()]
    assert got == [("a\nb", "", "c"), ("", "one", ""), ("", "", ""), ("", "", "")]
    assert "regexp_extract" not in plan(df.select(hh.body(F.col("t"), "h2", "Likely Cause")))


def test_phrases_part_the_words_once(spark):
    p = spark.createDataFrame([("Think of it as", "opening", "o"), ("a.b", "opening", "o"), ("and the", "anywhere", "r"), ("so, then", "anywhere", "r")], "phrase string, place string, kind string")
    texts = ["  Think of\n it as x", "think of it assumed", "a.b c and, the", "axb", "so then", None, ""]
    out = tx.style_phrases(spark.createDataFrame(list(enumerate(texts)), "k int, t string"), "k", "t", p)
    assert [sorted(r["found"]) for r in out.orderBy("k").collect()] == [["o:Think of it as"], [], ["o:a.b", "r:and the"], [], ["r:so, then"], [], []]
    assert plan(out).count("regexp_replace") == 1
