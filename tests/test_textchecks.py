from pyspark.sql import functions as F

from seedmill.operators import household as hh
from seedmill.operators import textchecks as tx


def _run(spark, fn, texts, *args, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, answer string")
    return [list(r["violations"]) for r in fn(df, "answer", *args, **kw).orderBy("i").collect()]


def test_qa_pairs(spark):
    good = "Q1:\nWhat?\n\nA1:\nThis.\n\nQ2:\nWhy?\n\nA2:\nThat."
    df = spark.createDataFrame([(0, good)], "i int, answer string")
    pairs = tx.parse_qa_pairs(df, "answer").first()["pairs"]
    assert [(p["n"], p["question"], p["answer"]) for p in pairs] == [(1, "What?", "This."), (2, "Why?", "That.")]
    got = _run(spark, tx.parse_qa_pairs, [good, "Hi.\n" + good, "Q1:\nWhat?\n\nA1:\nThis.", good.replace("Q2", "Q3"), good.replace("That.", ""),
                                          good.replace("Why?", "what?"), good.replace("That.", "That, see Q1: above"), None])
    assert got == [[], ["preamble"], ["pair_count"], ["bad_numbering"], ["empty_part"], ["repeated_question"], ["label_inside"], ["pair_count"]]


def test_cot_sets_and_content(spark):
    good = "Question 1: A?\nStep.\nQuestion 2: B?\nStep."
    assert _run(spark, tx.check_cot_sets, [good, "x\n" + good, "Question 1: A?\nStep.", good.replace("B?", "a?"), good[:-6], None]) == \
        [[], ["preamble"], ["set_count"], ["repeated_question"], ["empty_set"], ["set_count"]]
    assert _run(spark, tx.check_cot_sets, ["<s>A\nb\n<s>B\nc"], label="<s>") == [[]]
    assert _run(spark, tx.check_content_block, ["<CONTENT>\na\n</CONTENT>\n", "a", "<CONTENT>a</CONTENT> b", "<CONTENT> </CONTENT>",
                                                "<CONTENT>a</CONTENT><CONTENT>b</CONTENT>", None]) == \
        [[], ["no_block"], ["outside_text"], ["empty_block"], ["many_blocks"], ["no_block"]]


def test_outline_question_and_phrases(spark):
    assert _run(spark, tx.outline_flags, ["a [OK]\n\nb [OK]", "a [OK]\n\n^^^ b", "a\n\nb [OK]", "a [OK] ^^^", "", None]) == \
        [[], ["unresolved"], ["unmarked_unit"], ["both_marks", "unresolved"], ["no_units"], ["no_units"]]
    assert _run(spark, tx.check_question_form, ["Why is it so? Because.", "It is so. Because.", "Why?", "Q: Why? Because.", None]) == \
        [[], ["not_a_question"], ["no_answer"], ["labelled"], ["empty"]]
    assert _run(spark, tx.check_question_form, ["Salt melts ice. In fact.", "Does salt melt ice? Yes."], question=False) == [[], ["is_question"]]
    p = spark.createDataFrame([("great question", "opening", "opener"), ("as mentioned", "anywhere", "reference")], "phrase string, place string, kind string")
    df = spark.createDataFrame([(0, "Great  question! Well"), (1, "A great question, as\nmentioned."), (2, "as mentionedly"), (3, None)], "i int, t string")
    assert [list(r["found"]) for r in tx.style_phrases(df, "i", "t", p).orderBy("i").collect()] == [["opener:great question"], ["reference:as mentioned"], [], []]


def _answer(task, **own):
    return "\n".join(f"{x}:{own.get(x, ' words')}" for x in hh.LABELS[task])


def test_household_labels(spark):
    for task in hh.LABELS:
        good = _answer(task)
        swapped = good.split("\n")
        swapped[-1], swapped[-2] = swapped[-2], swapped[-1]
        got = _run(spark, hh.check_household, [good, "\n".join(swapped), good + "\n" + good.split("\n")[-1], "", None], task)
        labels = hh.LABELS[task]
        assert not any(c.startswith(("missing:", "duplicate:", "out_of")) for c in got[0]), (task, got[0])
        assert "out_of_order" in got[1] and f"duplicate:{labels[-1]}" in got[2]
        assert got[3] == got[4] and {f"missing:{x}" for x in labels} <= set(got[3])


def test_household_rules(spark):
    def codes(task, **own):
        return _run(spark, hh.check_household, [_answer(task, **own)], task)[0]

    assert codes("h17", **{"Materials Required": " wire Rs 120, tape ₹ 79.5"}) == []
    assert codes("h17", **{"Materials Required": " wire Rs 120, tape Rs. 80"}) == ["over_budget"]
    assert codes("h18", **{"Age Group": " Level 1 (5-12)"}) == [] and codes("h18", **{"Age Group": " Level 4 (40+)"}) == []
    assert codes("h18", **{"Age Group": " Level 1 (13-19)"}) == ["age_mismatch"] and codes("h18", **{"Age Group": " Level 9"}) == ["bad_level"]
    assert codes("h20", **{"Final Assessment": " Partial: yes"}) == [] and codes("h20", **{"Final Assessment": " Perhaps"}) == ["bad_final"]
    three = "".join(f"\n{i}. check — Cost of Inaction: rot" for i in (1, 2, 3))
    assert codes("h16", **{"Maintenance Checklist": three}) == [] and codes("h16", **{"Maintenance Checklist": three + "\n4. more"}) == ["item_count", "missing_inaction"]
    numbers = {"Emergency Numbers": " PESO: 1906 | Fire: 101 | Medical: 108"}
    assert codes("h7", **numbers, **{"Prevention Checklist": "\n- a\n- b\n- c", "Phase 3 — Recovery": "\n- Call: 101\n- Do not re-enter until: x"}) == []
    assert codes("h7", **numbers, **{"Prevention Checklist": "\n- a"}) == ["prevention_count"]
    assert codes("h6", **{x: "\n- a: 1" for x in hh.LABELS["h6"][:3]}, **{"Maintenance Reserve": " 1.5% a year"}) == []
    assert codes("h12", **{"Pre-Monsoon Checklist": "\n1. a — Low cost\n2. b"}) == ["uncosted_item"]
    assert codes("h14", **{"DO NOT (Indian myths — dangerous)": "\n1. a\n2. b\n3. c"}) == []


def test_dialogues(spark):
    good = "Learner: It is safe.\nExpert: No.\nLearner: I see, switch it off."
    assert _run(spark, hh.check_dialogue, [good, good + "\nExpert: Bye.", good.replace("Expert", "Friend"), "Expert: a\n" + good, None], "h10") == \
        [[], ["bad_closing"], ["unknown_speaker"], ["bad_opening"], ["no_turns", "bad_opening", "bad_closing"]]
    two = "Home Owner: a\nHandyman: Safety principle: off.\nHome Owner: b\nHandyman: Safety principle: dry.\nHome Owner: both"
    assert _run(spark, hh.check_dialogue, [two, two.replace("Safety principle: dry", "Dry")], "h19") == [[], ["principles"]]
