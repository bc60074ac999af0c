from seedmill.llm import template_decontam as D
from seedmill.llm.common import rows
from tests.conftest import SF0001

ITEM = "At the fair, Alice bought 3 apples for 12 dollars and then Alice gave 2 kg of pears to Bob Stone before noon. How much did Alice pay?"
SAME = ITEM.replace("Alice", "Maria Lopez").replace("Bob Stone", "Ken").replace("3", "7").replace("12", "40").replace("2 kg", "5 miles")
MIXED = ITEM.replace("then Alice", "then Ken").replace("Bob Stone", "Ken").replace("did Alice", "did Zoe")


def test_reparameterised_questions(spark):
    pad = "some words stand before it and more words follow. "
    docs = [(1, pad + ITEM + " " + pad), (2, pad + SAME), (3, pad + MIXED), (4, pad * 5), (5, None), (6, ""), (7, ITEM.upper()), (8, pad * 3000 + ITEM), (None, ITEM),
            (1, pad + ITEM + " " + pad), (9, "What is it?")]
    df = rows(spark, [(*d, 0) for d in docs], "doc_id long, text string, item_id int")
    bench = rows(spark, [(10, ITEM), (10, ITEM), (11, None), (12, ""), (13, "What is it?"), (14, "nowhere to be found at all in any text")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in D.find_leaks(df, bench).collect()}
    assert {k for k, r in got.items() if r["consistent"]} == {(1, 10), (2, 10), (8, 10), (None, 10), (9, 13)}
    assert not got[(3, 10)]["consistent"]
    assert got[(2, 10)]["slots"] >= 8 and got[(1, 10)]["matched"] == got[(1, 10)]["windows"]
    for d, b in ((df.limit(0), bench), (df, bench.limit(0))):
        assert D.find_leaks(d, b).count() == 0


def test_both_join_ways_agree(spark, monkeypatch):
    df = spark.read.parquet(f"{SF0001}/documents.parquet")
    bench = spark.read.parquet(f"{SF0001}/benchmark.parquet")
    key = lambda r: (r["doc_id"], r["item_id"], r["matched"], r["windows"], r["consistent"])
    small = sorted(map(key, D.find_leaks(df, bench).collect()))
    monkeypatch.setattr(D, "SMALL_ROWS", 0)
    assert sorted(map(key, D.find_leaks(df, bench).collect())) == small
    # brute force on plain words: whole items inside texts
    flat = lambda t: "".join(c.lower() for c in t if c.isalnum() or c.isspace()).split()
    texts = {r["doc_id"]: " " + " ".join(flat(r["text"] or "")) + " " for r in df.collect()}
    want = {(d, r["item_id"]) for r in bench.collect() for d, t in texts.items() if " " + " ".join(flat(r["text"])) + " " in t}
    assert want <= {k[:2] for k in small if k[4]}


def test_literal_copies_in_any_case_and_spacing(spark):
    wrapped = ITEM.replace(" Alice", "\n  Alice").replace("Bob Stone", "Bob\n Stone")
    docs = [(1, ITEM.lower()), (2, "Words before. " + ITEM.upper()), (3, wrapped), (4, wrapped.lower().replace(" ", "  ")), (5, MIXED), (6, "Alice paid 3 dollars.")]
    got = {r["doc_id"]: r for r in D.find_leaks(rows(spark, docs, "doc_id long, text string"), rows(spark, [(10, ITEM)], "item_id long, text string")).collect()}
    assert {k for k, r in got.items() if r["literal"]} == {1, 2, 3, 4} and not got[5]["consistent"]
    assert got[3]["consistent"] and got[2]["at"] == 2


def test_numbers_are_independent_slots(spark):
    item = "In the shop Alice took 3 apples and 3 pears and 5 plums from the shelf and went home to Bob before noon today."
    docs = [(1, item.replace("3 apples", "4 apples").replace("3 pears", "7 pears")), (2, item.replace("5 plums", "3 plums").replace("Bob", "Ken")),
            (3, item.replace("5 plums", "3 plums").replace("Bob", "Alice"))]
    got = {r["doc_id"]: r["consistent"] for r in D.find_leaks(rows(spark, docs, "doc_id long, text string"), rows(spark, [(10, item)], "item_id long, text string")).collect()}
    assert got == {1: True, 2: True, 3: False}


def test_words_of_odd_spacing_and_only_gaps_are_replaced(spark):
    import re
    from pyspark.sql import functions as F
    assert not re.search(D._GAPS, "one two three") and re.sub(D._GAPS, " ", "a  b\t\tc \x01d\ne") == "a b c d e"
    texts = [("", [], []), (" \t\n", [], []), ("He met  Bob\nStone, -- Al", ["He", "met", "\x01Bob\x02\x01Stone", "Al"], ["he", "met", "bob", "stone", "al"]),
             (" a\x01b \x02\x03 5% 3kg", ["a", "b", "5", "\x04%", "3", "\x04kg"], ["a", "b", "5%", "3kg"]), ("x -\x0b- y.\U0001d400", ["x", "y\U0001d400"], ["x", "y\U0001d400"])]
    df = rows(spark, [(i, t) for i, (t, _, _) in enumerate(texts)], "i int, t string")
    got = {r["i"]: (r["m"], r["p"]) for r in df.select("i", D.marked_words(F.col("t")).alias("m"), D.plain_words(F.col("t")).alias("p")).collect()}
    for i, (t, m, p) in enumerate(texts):
        assert got[i] == (m, p), (t, got[i])
