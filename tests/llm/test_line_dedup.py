import random

import pytest
from pyspark.sql import functions as F

from seedmill.llm import line_dedup as L
from seedmill.llm.common import rows, saved
from tests.conftest import SF0001


def brute(docs, least=L.MIN_TOKENS, percent=L.PERCENT):
    """Removed line numbers per row, each line against all earlier lines."""
    lines = []
    for d, t in docs:
        for i, s in enumerate(t.split("\n") if t is not None else []):
            w = {x for x in s.lower().replace("\t", " ").replace("\r", " ").split(" ") if x}
            lines.append(((d, i), w))
    lines.sort(key=lambda x: x[0])
    gone = set()
    for a, (place, w) in enumerate(lines):
        if len(w) >= least:
            for _, v in lines[:a]:
                o = len(w & v)
                if len(v) >= least and 100 * o >= percent * (len(w) + len(v) - o):
                    gone.add(place)
                    break
    return {d: sorted(i for e, i in gone if e == d) for d, _ in docs}


def made(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]
    bases = [rng.choices(vocabulary, k=rng.randrange(4, 60)) for _ in range(25)]
    docs = []
    for d in range(60):
        lines = []
        for _ in range(rng.randrange(1, 7)):
            w = list(rng.choice(bases))
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            if rng.random() < .3:
                bases.append(w)
            lines.append(" ".join(w).title() if rng.random() < .3 else " ".join(w))
        docs.append((d, "\n".join(lines)))
    return docs


def test_equals_all_pairs(spark):
    docs = made() + [(100, None), (101, ""), (102, "\n\n"), (103, "one two three four five\r\nONE  two three\tfour five"), (104, "w " * 50_000),
                     (105, "short line\nshort line")]
    df = rows(spark, [(*d, "c") for d in docs], "doc_id long, text string, clean string").drop("clean").selectExpr("*", "1 as h1")
    out = {r["doc_id"]: r for r in L.dedup_lines(df).collect()}
    want = brute(docs)
    for d, t in docs:
        assert list(out[d]["removed"]) == want[d], (d, t)
        assert out[d]["clean"] == (None if t is None else "\n".join(s for i, s in enumerate(t.split("\n")) if i not in want[d]))


def test_on_given_documents(spark):
    df = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    out = {r["doc_id"]: list(r["removed"]) for r in L.dedup_lines(df).collect()}
    assert out == brute(docs)


def test_repeated_rows_and_null_ids(spark):
    t = "alpha beta gamma delta epsilon zeta"
    df = rows(spark, [(None, t), (4, t), (4, t), (4, t + "\nanother line of five words")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), r["clean"]) for r in L.dedup_lines(df).collect())
    assert sum(c.startswith(t) for _, c in got) in (1, 2) and ("None", "") in got
    assert L.dedup_lines(df.limit(0)).count() == 0


def test_short_lines_unspaced_lines_and_changed_passages(spark):
    words = [f"p{i}" for i in range(50)]
    passage = " ".join(words)
    changed = " ".join([*words[:10], "x", *words[11:20], "y", *words[21:30], "z", *words[31:]])  # Jaccard 47 / 53
    unspaced = "\u6587\u5b57" * 40
    docs = [(1, f"Read more\n{passage}\n{unspaced}\nMenu\n\n \t"), (2, f"read  more\n{changed}\n{unspaced}\nOwn\n\n \t"), (3, "Menu\nRead less\nMenu")]
    out = {r["doc_id"]: (list(r["removed"]), r["clean"]) for r in L.dedup_lines(rows(spark, docs, "doc_id long, text string")).collect()}
    assert out == {1: ([], docs[0][1]), 2: ([0, 1, 2], "Own\n\n \t"), 3: ([0, 2], "Read less")}


def test_hot_tokens_lose_no_match(spark, monkeypatch):
    """Every token that more than two entries share takes the way of the frequent ones."""
    monkeypatch.setattr(L, "HOT", 2)
    docs = made(9) + [(100 + i, f"one common line of words that many documents share, number {i} of them all") for i in range(60)]
    out = {r["doc_id"]: list(r["removed"]) for r in L.dedup_lines(rows(spark, docs, "doc_id long, text string")).collect()}
    assert out == brute(docs)


def test_extra_columns_with_the_operators_names(spark):
    docs = [(1, "a b c d e f g\nx"), (2, "A b c d e f g\ny"), (None, None)]
    df = rows(spark, docs, "doc_id long, text string").selectExpr("*", "1 AS removed", "2 AS clean", "3 AS _doc", "4 AS h1", "5 AS c0", "6 AS _gone", "7 AS at")
    out = L.dedup_lines(df, clean="kept_text", removed="lines")
    assert out.columns == [*df.columns, "kept_text", "lines"]
    assert {r["doc_id"]: (r["kept_text"], r["lines"], r["removed"], r["clean"], r["_doc"]) for r in out.collect()} == {
        1: ("a b c d e f g\nx", [], 1, 2, 3), 2: ("y", [0], 1, 2, 3), None: (None, [], 1, 2, 3)}


def test_sizes_that_need_equality():
    assert L.tiny(80) == 3 and L.tiny(50) == 0 and L.tiny(90) == 8
    for percent in (50, 80, 85, 90):
        n = L.tiny(percent)
        assert all(100 * a < percent * (a + 1) for a in range(1, n + 1)) and 100 * (n + 1) >= percent * (n + 2)


def test_only_lines_of_pairs_travel(spark):
    """With no broadcast by size, the verification's own lines still pass the filter before any exchange of texts."""
    docs = rows(spark, [(i, "\n".join(f"{w}{i} {w} of line {i}" for w in "abcdef")) for i in range(40)], "doc_id long, text string")
    first = L.line_rows(docs).where("doc < 2 and line_no = 0").selectExpr("xxhash64(line) as key").collect()
    pairs = rows(spark, [(first[0]["key"], first[1]["key"])], "a long, b long")
    before, kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(L, "saved", lambda df, tag: kept.append((tag, df)) or saved(df, tag))
            L.similar(docs, pairs, 80).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = next(df for tag, df in kept if "line" in df.columns)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" not in plan and next(df for tag, df in kept if "line" in df.columns).count() == 2


def test_parities_of_128_classes_tell_long_lines_apart(spark):
    docs = rows(spark, [(d, " ".join(f"w{d}x{i}" for i in range(160)) + " shared") for d in range(6)], "doc_id long, text string")
    table = L.rarity(docs)
    e = L.entries(docs, table, 1, 80).select("h1", "n", "odd", "odd2", F.lit(0).alias("pos"), F.lit(1).alias("token"))
    met = L._sides(e, e, ["token"]).where("ha < hb")
    assert met.count() == 15 and met.where(L.possible(80)).count() == 0
