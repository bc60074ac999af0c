import corpus_pipeline as C
from seedmill.llm.common import rows, saved, table
from tests.conftest import SF0001


def test_stages_keep_columns_and_run(spark, monkeypatch):
    docs = table(spark, SF0001, "documents")
    seen = docs.count()
    for name, stage in C.STAGES[:-1]:
        out = saved(stage(spark, docs, SF0001), name)
        assert out.schema.simpleString() == docs.schema.simpleString()
        n = out.count()
        assert 0 < n <= seen
        docs, seen = out, n
    packed = C.STAGES[-1][1](spark, docs, SF0001)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {r["doc_id"] for r in docs.select("doc_id").collect()}
    # run() chains the stages over the table: here the two cheapest
    monkeypatch.setattr(C, "STAGES", C.STAGES[3:])
    clean = C.drop_contaminated(spark, table(spark, SF0001, "documents"), SF0001)
    assert {r["doc_id"] for r in C.run(spark, SF0001).select("doc_id").collect()} == {r["doc_id"] for r in clean.select("doc_id").collect()}


def test_planted_cases(spark):
    words = [f"term{i}" for i in range(4000)]
    text = lambda a, n=90: " ".join(words[a:a + n])
    passage = text(3000, 60)
    bench = table(spark, SF0001, "benchmark").first()["text"]
    near = text(1000).replace("term1005", "other")
    docs = rows(spark, [(1, text(0), "en", "s", 1), (2, text(0), "en", "s", 1), (3, text(1000, 45) + "\n" + text(1045, 45), "en", "s", 1),
                        (4, near, "en", "s", 1), (5, text(500) + "\n" + passage, "en", "s", 1), (6, text(700) + "\n" + passage, "en", "s", 1),
                        (7, text(2000) + " " + bench, "en", "s", 1), (8, None, None, None, None), (9, "", "en", "s", 0)],
                "doc_id long, text string, lang string, source string, n_chars long")
    out = C.drop_repeated_lines(spark, docs, SF0001)
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert 2 not in got and got[1] == text(0) and got[5].endswith(passage) and got[6] == text(700) and got[8] is None and got[9] == ""
    left = {r["doc_id"] for r in C.drop_near_duplicates(spark, docs, SF0001).collect()}
    assert 1 in left and 2 not in left and not {3, 4} <= left and {5, 6, 7, 8, 9} <= left
    left = {r["doc_id"] for r in C.drop_contaminated(spark, docs, SF0001).collect()}
    assert left == {1, 2, 3, 4, 5, 6, 8, 9}


def test_short_unique_lines_stay_without_the_shared_one(spark):
    shared = " ".join(f"s{i}" for i in range(30))
    poem = "\n".join(f"verse {i}" for i in range(12))
    docs = rows(spark, [(1, shared, "en", "s", 1), (2, poem + "\n" + shared, "en", "s", 1), (3, shared + "\n \n", "en", "s", 1), (4, " ", "en", "s", 1)],
                "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in C.drop_repeated_lines(spark, docs, SF0001).collect()}
    assert got == {1: (shared, 1), 2: (poem, len(poem)), 4: (" ", 1)}


EXTRA = ("removed", "clean", "_clean", "_doc", "_hash", "_tag", "c0", "x0", "node", "first", "score", "key", "at", "n", "tag", "row", "links", "words")


def test_stages_take_clashing_columns_nulls_repeats_and_empty_tables(spark):
    t = " ".join(f"w{i}" for i in range(40))
    base = [(1, t, "en", "s", 1), (1, t, "en", "s", 1), (2, t + " x", None, None, None), (None, None, None, None, None), (None, "", "en", "s", 0), (3, "long " * 100_000, "en", "s", 9),
            (4, "x\ny\n\nx", "en", "s", 7), (5, None, "en", "s", None)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = rows(spark, base, schema).selectExpr("*", *[f"'{c}' AS `{c}`" for c in EXTRA])
    docs = saved(docs, "docs")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF0001)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert all(r[c] == c for r in got for c in EXTRA), name
        left = [(r["doc_id"], r["text"]) for r in got]
        assert (None, None) in left and (None, "") in left and (5, None) in left, name
        assert len(got) == {"ngram_jaccard": 6}.get(name, len(got)), name
        if name in ("toxicity", "decontamination"):
            assert sorted(map(str, left)) == sorted(str(r[:2]) for r in base), name
        assert stage(spark, docs.limit(0), SF0001).count() == 0, name
    packed = C.STAGES[-1][1](spark, docs, SF0001)
    assert {r["doc_id"] for r in packed.select("doc_id").collect()} == {1, 2, 3, 4, 5, None}
    assert C.STAGES[-1][1](spark, docs.limit(0), SF0001).count() == 0
